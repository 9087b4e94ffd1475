"""Session settings and the shared folder for checkpoints and intermediate tables."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings the operators are planned for. AQE sizes partitions at run time, turns
# a sort-merge join into a broadcast join once a side is measured to be small, and
# splits skewed partitions; RocksDB keeps dedup state off the JVM heap.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def build_session(master: str | None = None, app: str = "ledgermill", **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


_scratch: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach: the one named in ``spark.checkpoint.dir``.

    Where the setting is absent, a local-mode session gets a scratch folder of its
    own; on a cluster that would be a machine-local folder, so it is refused.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    application = spark.sparkContext.applicationId
    if application not in _scratch:
        _scratch[application] = tempfile.mkdtemp(prefix="ledgermill-")
    return _scratch[application]


def fresh_path(spark: SparkSession, name: str) -> str:
    """A new, unused path below the shared folder."""
    return os.path.join(shared_dir(spark), "ledgermill", f"{name}-{uuid.uuid4().hex}")


def spread(df: DataFrame) -> DataFrame:
    """Spread a scan that has fewer splits than the cluster has cores.

    For work that is heavy per row, such as regular expressions over long texts. A table
    of many files already has enough splits and is returned as it is, without a shuffle. ``df`` must be a
    scan: counting the partitions of a plan with a shuffle would run it.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


# Shuffle files of a finished statement are deleted at once instead of when the driver happens to collect garbage.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Unlike a local checkpoint the files outlive executors. Used where one result
    feeds several later steps or a driver loop would otherwise grow the plan.
    """
    spark = df.sparkSession
    path, before = fresh_path(spark, "cut"), spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        if before is None:
            spark.conf.unset(_CLEANUP)
        else:
            spark.conf.set(_CLEANUP, before)
    table = spark.read.schema(df.schema).parquet(path)
    table.cut_path = path
    return table


def discard(*tables: DataFrame) -> None:
    """Delete tables that ``cut_lineage`` wrote and nothing reads any more."""
    for df in tables:
        conf = df.sparkSession._jsparkSession.sessionState().newHadoopConf()
        path = df.sparkSession._jvm.org.apache.hadoop.fs.Path(df.cut_path)
        path.getFileSystem(conf).delete(path, True)
