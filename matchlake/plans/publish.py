"""Publishing many tables at once.

Data of a run goes to its own folders, ``<table>/version=<run>/season=<season>``. Nothing refers to
them until the run appends one small file to the commit log that names the seasons it replaced.
Readers look up the newest commit of each season, so they see all tables of a run or none. A run
that fails leaves unreferenced folders and changes nothing; running it again overwrites them.
Seasons a run does not touch are not copied: they keep pointing at the version they were written in.

Commits are numbered. A run names the commit it started from and is refused when another run has
published since, so neither undoes the other. Logs (quarantine, changes, process events) are kept
apart from versions: each run adds its own folder, and they outlive deleted and expired versions.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from matchlake.session import shuffles_dropped

SHARED = "all"
PARALLEL_WRITES = 4
COMMITS = "version string, season string, removed boolean, committed_at timestamp, number bigint"
LOGS = "_logs"


class Conflict(RuntimeError):
    """Another run has published since this one began."""


def _missing(error: AnalysisException) -> bool:
    """Whether the folder is not there (yet); an unreadable one is an error like any other."""
    return (error.getCondition() or "").split(".")[0] in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA")


class Store:
    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")
        self._schemas: dict[str, T.StructType] = {}

    def commits(self) -> DataFrame:
        try:
            return self.spark.read.schema(COMMITS).parquet(f"{self.root}/_commits")
        except AnalysisException as error:
            if not _missing(error):
                raise
            return self.spark.createDataFrame([], COMMITS)

    def head(self) -> int:
        """The number of the newest commit, 0 before the first."""
        return self.commits().agg(F.coalesce(F.max("number"), F.lit(0)).alias("head")).first()["head"]

    def current(self) -> dict[str, str]:
        """Season -> version. One entry per season, so small enough for the driver."""
        newest = self.commits().groupBy("season").agg(
            F.max(F.struct("number", "version", "removed")).alias("last")
        )
        rows = newest.where("NOT last.removed").select("season", "last.version").collect()
        return {row["season"]: row["version"] for row in rows}

    def write(self, table: str, df: DataFrame, version: str, rebalance: bool = True) -> None:
        """Write a run's rows of a table. A table without a season is stored under one shared entry.

        Rows that come straight from a table stored by season are still together by season and need
        no ``rebalance``; rows out of an aggregation or join are gathered first, large seasons split.
        """
        if "season" not in df.columns:
            df = df.withColumn("season", F.lit(SHARED))
        # an empty result leaves no file to read the columns from
        self._schemas[table] = df.schema
        gathered = df.hint("rebalance", "season") if rebalance else df
        with shuffles_dropped(self.spark):
            (
                gathered.write.partitionBy("season")
                .mode("overwrite")
                .option("partitionOverwriteMode", "static")
                .option("compression", "zstd")
                .parquet(f"{self.root}/{table}/version={version}")
            )

    def write_all(self, tables: dict[str, DataFrame], version: str, together: tuple[str, ...] = ()) -> None:
        """Write independent tables as concurrent jobs, so that small ones do not wait for large ones.

        ``together`` names the tables whose rows are by season already.
        """
        with shuffles_dropped(self.spark), ThreadPoolExecutor(PARALLEL_WRITES) as pool:
            for done in [
                pool.submit(self.write, name, df, version, name not in together) for name, df in tables.items()
            ]:
                done.result()

    def read(self, table: str, entries: dict[str, str] | None = None) -> DataFrame | None:
        """The rows the given seasons point at (by default the published ones), None if there are none.

        The choice is a partition filter: folders of other versions and seasons are not read.
        """
        entries = self.current() if entries is None else entries
        chosen: Column = F.lit(False)
        for version in sorted(set(entries.values())):
            seasons = [s for s, v in entries.items() if v == version]
            chosen = chosen | ((F.col("version") == version) & F.col("season").isin(seasons))
        rows = self._open(table)
        return None if rows is None else rows.where(chosen).drop("version")

    def require(self, table: str, entries: dict[str, str]) -> DataFrame | None:
        """As ``read``, but entries that point at a table which is not there are an error: taking it
        for empty would publish a version without its rows."""
        rows = self.read(table, entries) if entries else None
        if entries and rows is None:
            raise RuntimeError(f"{self.root}/{table} is missing, but {sorted(set(entries.values()))} refer to it")
        return rows

    def read_version(self, table: str, version: str) -> DataFrame:
        """A table as one run wrote it, published or not."""
        return self._open(table).where(F.col("version") == version).drop("version")

    def _open(self, table: str) -> DataFrame | None:
        """All versions and seasons of a table; both partition columns stay text."""
        path = f"{self.root}/{table}"
        if table not in self._schemas:
            try:
                self._schemas[table] = self.spark.read.parquet(path).schema
            except AnalysisException as error:
                if not _missing(error):
                    raise
                return None
        columns = [f for f in self._schemas[table].fields if f.name not in ("season", "version")]
        keys = [T.StructField(name, T.StringType()) for name in ("season", "version")]
        try:
            return self.spark.read.schema(T.StructType(columns + keys)).parquet(path)
        except AnalysisException as error:
            if not _missing(error):
                raise
            return None

    def commit(self, version: str, seasons: list[str], removed: list[str] = (), parent: int | None = None) -> None:
        """Make a run's seasons the published ones and withdraw the ``removed`` ones: a single new
        file under the next number, so all or nothing. ``parent`` is the head the run started from."""
        head = self.head()
        if parent is not None and parent != head:
            raise Conflict(f"commit {head} was published after {parent}, from which {version} started")
        rows = [(version, season, False) for season in seasons] + [(version, season, True) for season in removed]
        entry = self.spark.createDataFrame(rows, "version string, season string, removed boolean").coalesce(1)
        entry = entry.withColumn("committed_at", F.current_timestamp())
        try:
            entry.write.mode("errorifexists").parquet(f"{self.root}/_commits/number={head + 1}")
        except AnalysisException as error:
            if "ALREADY_EXISTS" not in (error.getCondition() or ""):
                raise
            raise Conflict(f"another run has published commit {head + 1} meanwhile") from error

    def append_log(self, name: str, rows: DataFrame, run_id: str) -> None:
        """Add a run's rows to a log; trying the run again replaces its own rows only."""
        with shuffles_dropped(self.spark):
            rows.write.mode("overwrite").option("compression", "zstd").parquet(f"{self.root}/{LOGS}/{name}/run={run_id}")

    def read_log(self, name: str, run_id: str | None = None) -> DataFrame:
        """A log over all runs, with the column ``run``."""
        path = f"{self.root}/{LOGS}/{name}"
        schema = self.spark.read.parquet(path).schema
        typed = T.StructType([f for f in schema.fields if f.name != "run"] + [T.StructField("run", T.StringType())])
        rows = self.spark.read.schema(typed).parquet(path)
        return rows if run_id is None else rows.where(F.col("run") == run_id)

    def record_run(self, run: dict) -> None:
        """Append what a run did to the run log."""
        columns = "version string, mode string, seasons array<string>, status string, counts map<string, bigint>"
        entry = self.spark.createDataFrame([tuple(run[c.split()[0]] for c in columns.split(", ", 4))], columns)
        entry.coalesce(1).withColumn("finished_at", F.current_timestamp()).write.mode("append").parquet(f"{self.root}/_runs")

    def runs(self) -> DataFrame:
        """(version, mode, seasons, status, counts, finished_at) of all recorded runs."""
        return self.spark.read.parquet(f"{self.root}/_runs")
