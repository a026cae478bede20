"""Session helpers: one place for the settings every job relies on.

Library functions never build a session themselves; they take the caller's
``SparkSession`` so that cluster settings (executor sizes, shuffle partitions,
checkpoint folder) stay in the caller's hands.  ``get_session`` is for tests,
the bench and local runs.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings a local run needs; on a cluster these come from spark-defaults.
LOCAL_CONF = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Parsers produce one value per input row; keep Arrow batches moderate so
    # a batch of large HTML pages does not blow the Python worker memory.
    "spark.sql.execution.arrow.maxRecordsPerBatch": "2048",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "quarry", extra: dict | None = None) -> SparkSession:
    """Return (or create) a session with the settings the jobs are tuned for."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(LOCAL_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """Shared folder for checkpoints and intermediate tables, as the session
    names it in ``spark.checkpoint.dir`` (or by ``setCheckpointDir``).  There is
    no fallback: a folder that only one machine sees would lose data."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return str(root).rstrip("/")


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Cut lineage by writing ``df`` as a Parquet table in a fresh folder of
    the shared checkpoint root and reading it back.  Columnar and compressed,
    it is cheaper to write and to read twice than a row checkpoint, and it
    survives the loss of any executor.  The folder goes when the application
    ends."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def scratch_path(spark: SparkSession, label: str) -> str:
    """A path, never used before, in a folder of the checkpoint root that is
    deleted when the application ends."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{checkpoint_root(spark)}/{label}-{uuid.uuid4().hex}")
    fs = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    fs.mkdirs(folder)
    fs.deleteOnExit(folder)
    return f"{folder.toString()}/data"
