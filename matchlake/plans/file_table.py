"""A season-partitioned table whose files are named by a log.

Rows lie in ``<root>/data/write=<id>/season=<season>``; nothing there is ever written over. A commit is
one numbered folder of ``<root>/_files`` that names the files it adds and those it takes away, each with
its season, bytes and rows, as the write counted them from the Parquet footers. A reader opens the files
that are current at one number, so it keeps seeing them while a later commit replaces them; they are
deleted only when the last kept number no longer names them.

Compaction, expiry and the search for orphans compare tables of the log. No folder of the table is
listed for them. Every write notes its id before it starts, so what a lost one left behind is known too.

A commit is refused when another one has changed one of its seasons since the number it started from;
changes of other seasons do not hinder it.
"""

from __future__ import annotations

import uuid

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from matchlake.operators.maintenance import KEPT_VERSIONS, RETENTION_DAYS, delete_paths, expiry_plan
from matchlake.plans.publish import Conflict, _missing
from matchlake.schemas import LAKEHOUSE
from matchlake.session import written
from matchlake.sources.lakehouse import ROWS_PER_FILE, TARGET_FILE_BYTES

ENTRY = "file string, season string, bytes bigint, rows bigint, write string, added boolean, action string, committed_at timestamp"
WRITES = "write string, started_at timestamp"
DELETED = "file string"
#: A file below this share of the target size is worth packing.
SMALL = 0.75


def compaction_bins(files: DataFrame, target_bytes: int = TARGET_FILE_BYTES) -> DataFrame:
    """The small files that share a new file: (season, bin, file, bytes, rows, id), ids counted from 0.

    Files are laid end to end by size within a season and cut at multiples of the target size, so a new
    file has less than twice the target. Large files and small ones left alone in their bin are not named.
    """
    by_size = Window.partitionBy("season").orderBy("bytes", "file")
    before = F.sum("bytes").over(by_size) - F.col("bytes")
    small = files.where(F.col("bytes") < int(target_bytes * SMALL)).withColumn("bin", F.floor(before / target_bytes))
    shared = small.withColumn("members", F.count("*").over(Window.partitionBy("season", "bin"))).where("members > 1")
    place = F.dense_rank().over(Window.partitionBy("season").orderBy("bin"))
    placed = shared.withColumn("place", place)
    totals = placed.groupBy("season").agg(F.max("place").alias("bins"))  # a row per season
    first = totals.select("season", (F.sum("bins").over(Window.orderBy("season")) - F.col("bins")).alias("first"))
    identity = (F.col("first") + F.col("place") - 1).cast("int").alias("id")
    return placed.join(first, "season").select("season", "bin", "file", "bytes", "rows", identity)


class FileTable:
    def __init__(self, spark: SparkSession, root: str, schema: str = LAKEHOUSE):
        self.spark, self.root = spark, root.rstrip("/")
        self.schema = StructType.fromDDL(schema)

    # the log

    def _table(self, name: str, schema: str) -> DataFrame:
        try:
            return self.spark.read.schema(schema).parquet(f"{self.root}/{name}")
        except AnalysisException as error:
            if not _missing(error):
                raise
            return self.spark.createDataFrame([], schema)

    def log(self) -> DataFrame:
        """One row per file that a commit added or took away."""
        return self._table("_files", f"{ENTRY}, number bigint")

    def head(self) -> int:
        return self.log().agg(F.coalesce(F.max("number"), F.lit(0)).alias("head")).first()["head"]

    def files(self, number: int | None = None) -> DataFrame:
        """The files current at a number, by default the newest: (file, season, bytes, rows, write)."""
        known = self.log() if number is None else self.log().where(F.col("number") <= number)
        last = known.groupBy("file").agg(F.max_by(F.struct("season", "bytes", "rows", "write", "added"), "number").alias("last"))
        return last.where("last.added").select("file", "last.season", "last.bytes", "last.rows", "last.write")

    def snapshots(self) -> DataFrame:
        """(number, action, committed_at) of each commit."""
        return self.log().groupBy("number").agg(F.min("action").alias("action"), F.min("committed_at").alias("committed_at"))

    def _commit(self, changes: DataFrame, action: str, parent: int) -> int:
        """Publish added and removed files under the next free number: a renamed folder, all or nothing."""
        spark, jvm = self.spark, self.spark.sparkContext._jvm
        columns = ["file", "season", "bytes", "rows", "write", "added"]
        pending = f"{self.root}/_pending/{uuid.uuid4().hex}"
        entry = changes.select(*columns, F.lit(action).alias("action"), F.current_timestamp().alias("committed_at"))
        entry.write.parquet(pending)
        seasons = spark.read.schema(ENTRY).parquet(pending).select("season").distinct()
        log = jvm.org.apache.hadoop.fs.Path(f"{self.root}/_files")
        log.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).mkdirs(log)
        while True:
            head = self.head()
            since = self.log().where(F.col("number") > parent)
            touched = [row["season"] for row in since.join(seasons, "season", "left_semi").select("season").distinct().collect()]
            if touched:
                delete_paths(spark, [pending])
                raise Conflict(f"seasons {sorted(touched)} were changed after commit {parent}, from which this {action} started")
            if self._rename(pending, f"{self.root}/_files/number={head + 1}"):
                return head + 1

    def _rename(self, pending: str, target: str) -> bool:
        """Whether the folder could take its name: without overwriting, only one writer gets a number."""
        jvm, conf = self.spark.sparkContext._jvm, self.spark.sparkContext._jsc.hadoopConfiguration()
        path, fs = jvm.org.apache.hadoop.fs.Path, jvm.org.apache.hadoop.fs
        options = self.spark.sparkContext._gateway.new_array(getattr(fs, "Options$Rename"), 1)
        options[0] = getattr(fs, "Options$Rename").NONE
        try:
            fs.FileContext.getFileContext(path(self.root).toUri(), conf).rename(path(pending), path(target), options)
        except Py4JJavaError as error:
            if "FileAlreadyExists" not in str(error.java_exception):
                raise
            return False
        return True

    # rows

    def read(self, number: int | None = None, seasons: list[str] | None = None) -> DataFrame:
        """The rows at a number. Names of files pass through the driver, as in any read of a folder: one
        per file of about the target size, and only those of ``seasons`` where these are given."""
        files = self.files(number)
        if seasons is not None:
            files = files.where(F.col("season").isin(seasons))
        return self._open([row["file"] for row in files.select("file").collect()])

    def _open(self, files: list[str]) -> DataFrame:
        if not files:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).option("basePath", f"{self.root}/data").parquet(*files).select(*self.schema.names)

    def stage(self, rows: DataFrame, rows_per_file: int = ROWS_PER_FILE, places: int | None = None) -> DataFrame:
        """Write rows under an id of their own; the new files, counted from their footers. Nobody reads them
        until a commit names them."""
        write = uuid.uuid4().hex
        noted = self.spark.range(1).select(F.lit(write).alias("write"), F.current_timestamp().alias("started_at"))
        noted.coalesce(1).write.mode("append").parquet(f"{self.root}/_writes")
        typed = rows.select(*[F.col(f.name).cast(f.dataType) for f in self.schema.fields], *[c for c in rows.columns if places and c == PLACE])
        folder = f"{self.root}/data/write={write}"
        placed = typed.repartitionById(places, PLACE).drop(PLACE) if places else typed.hint("rebalance", "season")
        placed.write.partitionBy("season").option("compression", "zstd").option("maxRecordsPerFile", rows_per_file).parquet(folder)
        made = self.spark.read.schema(self.schema).parquet(folder)  # of no rows, one file without a season
        counted = made.groupBy(_path().alias("file"), "season", F.col("_metadata.file_size").alias("bytes")).agg(F.count("*").alias("rows"))
        return written(counted.withColumns({"write": F.lit(write), "added": F.lit(True)}), "files")

    def replace(self, rows: DataFrame, rows_per_file: int = ROWS_PER_FILE) -> int:
        """Replace exactly the seasons present in ``rows``; the number of the commit."""
        parent = self.head()
        added = self.stage(rows, rows_per_file)
        gone = self.files(parent).join(added.select("season").distinct(), "season", "left_semi")
        return self._commit(added.unionByName(gone.withColumn("added", F.lit(False))), "replace", parent)

    def append(self, rows: DataFrame, rows_per_file: int = ROWS_PER_FILE) -> int:
        """Add rows to their seasons; the number of the commit."""
        parent = self.head()
        return self._commit(self.stage(rows, rows_per_file), "append", parent)

    # upkeep

    def health(self) -> dict[str, int]:
        """Rows and files as the log counts them, and the rows that the files really hold."""
        counted = self.files().agg(F.count("*").alias("files"), F.coalesce(F.sum("rows"), F.lit(0)).alias("rows")).first()
        return {"files": counted["files"], "rows": counted["rows"], "found": self.read().count()}

    def compact(self, target_bytes: int = TARGET_FILE_BYTES) -> dict[str, int]:
        """Pack small files into new ones of about the target size and publish them in place of the old.

        Every row of a small file is read, shuffled and written once, to the task of its new file; large
        files are not opened. Readers of an earlier number keep their files.
        """
        parent = self.head()
        bins = written(compaction_bins(self.files(parent), target_bytes), "bins")
        sizes = bins.agg(
            F.count("*").alias("files"), F.coalesce(F.sum("rows"), F.lit(0)).alias("rows"), F.coalesce(F.max("id") + 1, F.lit(0)).alias("bins"),
            F.count_distinct("season").alias("seasons"),
        ).first()
        done = {"compacted_seasons": sizes["seasons"], "files_before": sizes["files"], "files_after": 0, "rows": sizes["rows"]}
        if not sizes["bins"]:
            return done
        small = self._open([row["file"] for row in bins.select("file").collect()])
        dealt = small.withColumn("file", _path()).join(bins.select("file", F.col("id").alias(PLACE)), "file").drop("file")
        added = self.stage(dealt, rows_per_file=0, places=sizes["bins"])
        after = added.agg(F.count("*").alias("files"), F.coalesce(F.sum("rows"), F.lit(0)).alias("rows")).first()
        if after["rows"] != sizes["rows"]:
            raise RuntimeError(f"compaction would change {sizes['rows']} rows into {after['rows']}")
        gone = self.files(parent).join(bins.select("file"), "file", "left_semi").withColumn("added", F.lit(False))
        self._commit(added.unionByName(gone), "compact", parent)
        return done | {"files_after": after["files"]}

    def expired_files(self, now: str, days: int = RETENTION_DAYS, keep: int = KEPT_VERSIONS) -> DataFrame:
        """Files that no kept number names: taken away at or before the oldest number within ``days``
        or among the ``keep`` newest."""
        versions = self.snapshots().select(
            F.lit("table").alias("table"), F.col("number").alias("version"), F.col("committed_at").cast("timestamp_ntz").alias("created_at")
        )
        kept = versions.join(expiry_plan(versions, now, days, keep), "version", "left_anti").agg(F.min("version").alias("oldest"))
        last = self.log().groupBy("file").agg(F.max_by(F.struct("added", "number"), "number").alias("last"))
        gone = last.where("NOT last.added").join(kept, F.col("last.number") <= F.col("oldest"))
        return gone.select("file").join(self._table("_deleted", DELETED), "file", "left_anti")

    def orphaned_writes(self, now: str, days: int = RETENTION_DAYS) -> DataFrame:
        """Folders of writes older than ``days`` that no commit names."""
        aged = self._table("_writes", WRITES).where(F.col("started_at") < F.lit(now).cast("timestamp") - F.expr(f"INTERVAL {int(days)} DAYS"))
        lost = aged.join(self.log().select("write").distinct(), "write", "left_anti")
        folders = lost.select(F.concat(F.lit(f"{self.root}/data/write="), "write").alias("file"))
        return folders.join(self._table("_deleted", DELETED), "file", "left_anti")

    def delete(self, paths: DataFrame) -> int:
        """Delete the files or folders and note them; how many were named."""
        doomed = written(paths.select("file"), "deleted")
        names = [row["file"] for row in doomed.collect()]
        delete_paths(self.spark, names)
        if names:
            doomed.coalesce(1).write.mode("append").parquet(f"{self.root}/_deleted")
        return len(names)


PLACE = "_place"


def _path() -> Column:
    """The path of a row's file as file systems name it; Spark's metadata gives it encoded as a URI."""
    return F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B")))
