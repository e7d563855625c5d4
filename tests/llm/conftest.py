import pytest
from pyspark.sql import types as T

#: Names that the operators use themselves, as extra columns of the input.
EXTRA = ["doc", "size", "kept", "target", "spans", "row", "grp", "text_", "score"]
DOCS = T.StructType(
    [T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
     T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType())]
    + [T.StructField(c, T.StringType()) for c in EXTRA]
)


@pytest.fixture(scope="session")
def frame(spark):
    """Builds documents from (doc_id, text, lang, source)."""
    def build(rows):
        return spark.createDataFrame([(*r, len(r[1] or ""), *["x"] * len(EXTRA)) for r in rows], DOCS).repartition(3)
    return build


@pytest.fixture(scope="session")
def odd():
    """Nulls, empty and very long texts, ties, repeated rows."""
    prose = "one fine day the quick brown fox met a lazy dog near the old river bank and slept"
    return [
        (1, None, "en", "a"), (2, "", "en", "a"), (3, " \t\n", None, "b"), (4, prose, None, None), (4, prose, None, None),
        (None, prose + " again", "en", None), (6, "long words here " * 30_000, "en", "a"), (7, "é ß 😀 x", "fr", "b"), (8, prose, "en", "b"),
        (None, None, None, None),
    ]
