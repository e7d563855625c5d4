"""Session construction and the shared working folder."""

from __future__ import annotations

import os
import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import SparkSession


def build_session(app: str = "matchlake", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the operators are tuned for; any of them can be overridden."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    defaults = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        # a join on a hot key is split even when the aggregation above it must then shuffle again
        "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
        "spark.sql.parquet.compression.codec": "zstd",
        "spark.sql.sources.partitionOverwriteMode": "dynamic",
        # plans name their whole filters, however long a session's column numbers have become
        "spark.sql.maxMetadataStringLength": "2000",
        # streaming state lives on local disk with changelogs in the checkpoint, not on the heap
        "spark.sql.streaming.stateStore.providerClass":
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
        "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    }
    defaults.update(conf)
    for key, value in defaults.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_root(spark: SparkSession) -> str:
    """The folder all executors can reach, named by ``spark.checkpoint.dir``.

    Only a local-mode session may fall back to a machine-local folder, because there every
    executor is this machine.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    root = os.environ.get("MATCHLAKE_LOCAL_ROOT") or tempfile.mkdtemp(prefix="matchlake-")
    spark.conf.set("spark.checkpoint.dir", root)
    return root


def scratch(spark: SparkSession, label: str) -> str:
    """A fresh folder path below the shared root."""
    return f"{shared_root(spark)}/matchlake/{label}-{uuid.uuid4().hex}"


def written(df, label: str):
    """``df`` as a table in the shared folder: computed once, and of a size Spark then knows, so that
    a join broadcasts it only if it really is small."""
    path = scratch(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: Drops the shuffle files of a query as soon as it has ended.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_dropped(spark: SparkSession):
    """Queries inside leave no shuffle files behind. Otherwise these stay until the driver happens to
    collect its garbage, so a run of many writes holds what all of them have shuffled."""
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(CLEANUP)
        else:
            spark.conf.set(CLEANUP, before)


class Workspace:
    """Tables that one computation needs for a while: written below one folder of the shared root and
    dropped together, on leaving the ``with`` block. What outlives it must not read them."""

    def __init__(self, spark: SparkSession, label: str):
        self.spark, self.root, self.count = spark, scratch(spark, label), 0

    def written(self, df, **options: str):
        """As ``written``, for as long as the workspace lasts."""
        self.count += 1
        path = f"{self.root}/{self.count}"
        df.write.options(**options).parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self) -> None:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(self.root)
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)

    def __enter__(self):
        return self

    def __exit__(self, *_):
        self.drop()


def reliable_checkpoint(df):
    """``df.checkpoint()`` into the shared folder, which survives the loss of executors."""
    spark = df.sparkSession
    context = spark.sparkContext
    if not context._jsc.sc().getCheckpointDir().isDefined():
        context.setCheckpointDir(shared_root(spark) + "/checkpoints")
    return df.checkpoint()
