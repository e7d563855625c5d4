"""Remembered hashes as a base and small deltas, by scope and bucket of the key.

A run reads the entries of its own scopes (seasons) only, and adds the changed rows as a delta of the
buckets they fall in; nothing else is written. An entry is folded into a new base once its deltas hold
more than ``fold_at`` of the base's rows, so reading costs at most that much more than a table that is
rewritten by every run, and writing follows the number of changes.

Which files make up an entry is said by commits: each is one small file, so a run is visible as a
whole or not at all, and folders that no commit names are never read. A commit is numbered; the number
that exists already is refused, so of two runs that start from one state the second has to begin anew.

Cases: a deleted key is a row without a hash until its entry is folded; a key that has moved to another
scope is new there, and gone from the old one when a complete snapshot of that one says so; an empty
change set commits nothing; a null scope is the scope "none".
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from matchlake.operators import cdc
from matchlake.plans.publish import Conflict, _missing

ROW = "business_key string, record_hash string"
PART = "scope string, bucket int, number bigint"
COMMIT = "scope string, bucket int, rows bigint, base boolean"
NO_SCOPE = "none"


class HashState:
    def __init__(self, spark: SparkSession, root: str, buckets: int = 64, fold_at: float = 0.25):
        self.spark, self.root, self.buckets, self.fold_at = spark, root.rstrip("/"), buckets, fold_at

    def _opened(self, schema: str, path: str) -> DataFrame:
        try:
            return self.spark.read.schema(schema).parquet(path)
        except AnalysisException as error:
            if not _missing(error):
                raise
            return self.spark.createDataFrame([], schema)

    def commits(self) -> DataFrame:
        """(scope, bucket, rows, base, number) of everything that was ever committed."""
        return self._opened(f"{COMMIT}, number bigint", f"{self.root}/_commits")

    def entries(self, scopes: list[str] | None = None) -> DataFrame:
        """What is current: for each (scope, bucket) the newest base and the deltas after it."""
        known = self.commits() if scopes is None else self.commits().where(F.col("scope").isin(scopes))
        newest = known.groupBy("scope", "bucket").agg(F.max(F.when(F.col("base"), F.col("number"))).alias("from"))
        return known.join(newest, ["scope", "bucket"]).where(F.col("from").isNull() | (F.col("number") >= F.col("from"))).drop("from")

    def _rows(self, chosen: DataFrame) -> DataFrame:
        """The rows of chosen entries with their number. The choice becomes a filter on folders; it has
        a few rows for each bucket, which a parameter bounds."""
        by_number: dict[int, dict[str, list[int]]] = {}
        for r in chosen.select("number", "scope", "bucket").collect():
            by_number.setdefault(r.number, {}).setdefault(r.scope, []).append(r.bucket)
        rows, wanted = self._opened(f"{ROW}, {PART}", f"{self.root}/rows"), F.lit(False)
        for number, scopes in by_number.items():
            for scope, buckets in scopes.items():
                wanted = wanted | ((F.col("number") == number) & (F.col("scope") == scope) & F.col("bucket").isin(buckets))
        return rows.where(wanted)

    def _current(self, chosen: DataFrame) -> DataFrame:
        last = self._rows(chosen).groupBy("scope", "bucket", "business_key").agg(F.max(F.struct("number", "record_hash")).alias("last"))
        return last.select("scope", "bucket", "business_key", "last.record_hash").where("record_hash is not null")

    def read(self, scopes: list[str] | None = None) -> DataFrame:
        """(scope, business_key, record_hash) of the given scopes, by default all."""
        return self._current(self.entries(scopes)).drop("bucket")

    def _placed(self, rows: DataFrame) -> DataFrame:
        scope = F.coalesce(F.col("scope").cast("string"), F.lit(NO_SCOPE))
        return rows.select("business_key", "record_hash", scope.alias("scope"), F.pmod(F.xxhash64("business_key"), F.lit(self.buckets)).cast("int").alias("bucket"))

    def _write(self, rows: DataFrame, base: bool, parent: int) -> bool:
        """Rows as the next number: data first, then the commit that makes them visible."""
        number = parent + 1
        path = f"{self.root}/rows/number={number}"
        rows.hint("rebalance", "scope", "bucket").write.partitionBy("scope", "bucket").mode("overwrite").option(
            "partitionOverwriteMode", "static").parquet(path)
        found = self._opened(f"{ROW}, scope string, bucket int", path).groupBy("scope", "bucket").agg(F.count("*").alias("rows"))
        if found.isEmpty():
            return False
        try:
            found.withColumn("base", F.lit(base)).coalesce(1).write.mode("errorifexists").parquet(f"{self.root}/_commits/number={number}")
        except AnalysisException as error:
            if "ALREADY_EXISTS" not in (error.getCondition() or ""):
                raise
            raise Conflict(f"another run has committed {number} meanwhile") from error
        return True

    def head(self) -> int:
        return self.commits().agg(F.coalesce(F.max("number"), F.lit(0)).alias("n")).first()["n"]

    def apply(self, changes: DataFrame, parent: int | None = None) -> None:
        """Remember changes (scope, business_key, operation, new_hash), then fold what is due.
        ``parent`` is the head from which the changes were found."""
        parent = self.head() if parent is None else parent
        new = F.when(F.col("operation") != cdc.DELETE, F.col("new_hash")).alias("record_hash")
        if self._write(self._placed(changes.where(F.col("operation") != cdc.SKIP).select("scope", "business_key", new)), False, parent):
            self.fold()

    def due(self) -> DataFrame:
        """The entries whose deltas have outgrown their base."""
        sizes = self.entries().groupBy("scope", "bucket").agg(
            F.sum(F.when(F.col("base"), F.col("rows")).otherwise(0)).alias("base_rows"), F.sum(F.when(~F.col("base"), F.col("rows")).otherwise(0)).alias("delta_rows"))
        return sizes.where(F.col("delta_rows") > self.fold_at * F.col("base_rows")).select("scope", "bucket")

    def fold(self) -> None:
        """Write the due entries as new bases. An entry that has lost all its rows keeps its deltas."""
        parent = self.head()
        chosen = self.entries().join(self.due(), ["scope", "bucket"])
        self._write(self._current(chosen).select("business_key", "record_hash", "scope", "bucket"), True, parent)

    def changes(self, staged: DataFrame, scopes: list[str], complete: bool = False) -> DataFrame:
        """(scope, business_key, operation, old_hash, new_hash) of staged (scope, business_key,
        record_hash) against the state of ``scopes``, the only entries that are opened."""
        key = lambda df: df.select(F.struct(F.coalesce("scope", F.lit(NO_SCOPE)).alias("scope"), "business_key").alias("business_key"), "record_hash")
        known = key(self.read(scopes))
        found = cdc.classify(key(staged), known, known.select("business_key"), complete)
        return found.select("business_key.scope", "business_key.business_key", "operation", "old_hash", "new_hash")
