"""Session builder and shared-storage helpers."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from functools import cache

from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "listforge", master: str | None = None, shuffle_partitions: int | None = None) -> SparkSession:
    """UTC session with AQE; master and shuffle partitions are left to the cluster unless given."""
    b = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.sources.partitionOverwriteMode", "dynamic")
        .config("spark.ui.enabled", "false")
    )
    if master:
        b = b.master(master)
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    return b.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share, ``spark.checkpoint.dir``.

    A cluster must name it. Where it is unset, only a session that runs inside one machine gets a temporary one, made at
    its first use and removed at the end of the process.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base:
        return base.rstrip("/")
    if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
        raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
    return _own_dir()


@cache
def _own_dir() -> str:
    path = tempfile.mkdtemp(prefix="listforge-")
    atexit.register(shutil.rmtree, path, ignore_errors=True)
    return "file://" + path


def new_path(spark: SparkSession, tag: str) -> str:
    return f"{shared_dir(spark)}/{tag}-{uuid.uuid4().hex}"


def durable(df: DataFrame, tag: str = "stage") -> DataFrame:
    """Write once to the shared folder and read back: cuts lineage, and a lost executor costs no recomputation."""
    spark = df.sparkSession
    path = new_path(spark, tag)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def drop_path(spark: SparkSession, path: str) -> None:
    """Delete a table of ours in the shared folder, through the file system that owns it."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)
