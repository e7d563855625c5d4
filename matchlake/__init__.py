"""matchlake: medallion analytics on Spark, written as lazy DataFrame operators."""
