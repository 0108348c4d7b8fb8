"""Session helpers: table access, durable cut points, size-checked broadcasts."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Largest row count of a side that is sent to every executor. Above it the
#: join is left to a shuffle, so nothing that grows with the data is broadcast.
BROADCAST_ROWS = 200_000


def session(app: str = "tidemark", cores: str = "*", partitions: int = 8) -> SparkSession:
    """A session with the settings the library relies on (UTC, AQE, Arrow)."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the parquet tables of a data directory."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder for checkpoints and written tables.

    It is the one the cluster names in ``spark.checkpoint.dir``. Only a local session
    without that setting gets a folder of its own.
    """
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        shared = spark.conf.get("spark.checkpoint.dir", None)
        if shared is None:
            if not sc.master.startswith("local[") and sc.master != "local":
                raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
            shared = tempfile.mkdtemp(prefix="tidemark-checkpoint-")
        sc.setCheckpointDir(shared)
    return sc.getCheckpointDir()


def durable(df: DataFrame) -> DataFrame:
    """Cut the lineage of ``df`` with a reliable checkpoint in the shared folder."""
    shared_folder(df.sparkSession)
    return df.checkpoint()


def drop_folder(spark: SparkSession, path: str) -> None:
    """Removes a written table and all that lies under ``path``."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def small(df: DataFrame, limit: int = BROADCAST_ROWS) -> DataFrame:
    """``df`` with a broadcast hint if it has at most ``limit`` rows, else as it is.

    The check reads at most ``limit + 1`` rows. It is meant for reference lists
    and other sides whose size is bounded by something else than the data.
    """
    return F.broadcast(df) if df.limit(limit + 1).count() <= limit else df
