"""Session defaults and the shared work folder."""

from __future__ import annotations

import atexit
from functools import lru_cache
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

SESSION_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


def local_session(cores: int | str = 8, shuffle_partitions: int = 8) -> SparkSession:
    """A single-machine session for tests and the benchmark."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("pressmill")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    )
    for key, value in SESSION_DEFAULTS.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


@lru_cache(maxsize=1)
def _one_machine_root() -> str:
    root = tempfile.mkdtemp(prefix="pressmill-")
    atexit.register(shutil.rmtree, root, ignore_errors=True)  # it holds this run only
    return root


def shared_root(spark: SparkSession) -> str:
    """The folder all executors see, as the cluster names it.

    A machine-local folder is used only when none is named and the session
    itself runs on one machine.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if spark.sparkContext.master.startswith("local"):
        return _one_machine_root()
    raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")


def work_path(spark: SparkSession, name: str) -> str:
    """A new path below the shared folder."""
    return f"{shared_root(spark)}/pressmill/{uuid.uuid4().hex}/{name}"


def spread(scan: DataFrame) -> DataFrame:
    """A plain file scan over at least as many tasks as there are cores.

    Only a scan that comes in fewer splits than cores, so a small one, is
    redistributed; larger scans pass unchanged and without a shuffle.
    """
    cores = scan.sparkSession.sparkContext.defaultParallelism
    return scan.repartition(cores) if scan.rdd.getNumPartitions() < cores else scan


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    This cuts the lineage in a way that survives lost executors, and gives the
    planner real file sizes for the next step.
    """
    spark = df.sparkSession
    path = work_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
