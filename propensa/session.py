"""Session construction and the shared output folder."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "propensa", master: str | None = None,
                  shuffle_partitions: int | None = None) -> SparkSession:
    """Session for tests and the bench; on a cluster use the provided one."""
    master = master or os.environ.get("PROPENSA_MASTER", "local[8]")
    builder = (
        SparkSession.builder.master(master).appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        # delete a checkpoint's files once its DataFrame is garbage collected
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        # merge session windows inside each partition before the shuffle
        .config("spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition", "true")
        .config("spark.driver.memory", os.environ.get("PROPENSA_DRIVER_MEMORY", "8g"))
    )
    if shuffle_partitions is not None:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The one base folder for checkpoints, written tables and sinks.

    The context's checkpoint folder wins: Spark fills it from
    ``spark.checkpoint.dir`` and ``setCheckpointDir`` may replace it.  Without
    one the setting itself is used.  Where neither exists, a scratch folder is
    made for a local master (tests); on a cluster that is an error, because
    executors would write to disks that nobody else can read.
    """
    sc = spark.sparkContext
    path = sc.getCheckpointDir()
    if path is None:
        path = spark.conf.get("spark.checkpoint.dir", None)
        if not path:
            if not sc.master.split("[")[0] == "local":
                raise ValueError("set spark.checkpoint.dir to a folder that the driver "
                                 "and all executors share")
            import tempfile
            path = tempfile.mkdtemp(prefix="propensa-ckpt-")
        sc.setCheckpointDir(path)
        path = sc.getCheckpointDir()
    return path


def materialize(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and read it back.

    Used for small derived tables that several branches of a plan read: they
    are computed once, and a lost executor re-reads them instead of
    recomputing their lineage.
    """
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def shared_dir(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder under the shared checkpoint folder."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/propensa/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a Parquet table in the shared folder, read back: columnar,
    prunable, and kept when executors are lost."""
    path = shared_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
