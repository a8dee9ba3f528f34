"""Intermediate tables in the folder that every executor can reach."""

import math
import tempfile
import uuid
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

_own_folder = None


def shared_folder(spark: SparkSession) -> str:
    """The cluster's ``spark.checkpoint.dir``; a folder of our own only in local mode."""
    global _own_folder
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    if spark.sparkContext.master != "local" and not spark.sparkContext.master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
    if _own_folder is None:
        _own_folder = tempfile.mkdtemp(prefix="tillmart-")
    return _own_folder


def new_folder(spark: SparkSession, label: str) -> str:
    return f"{shared_folder(spark)}/tillmart/{label}-{uuid.uuid4().hex}"


def stage(df: DataFrame, label: str, within: str | None = None) -> DataFrame:
    """Write ``df`` once as Parquet and go on from the written table.

    Later steps then read columns they need instead of repeating the work above, and a
    lost executor costs a re-read, not a re-run.
    """
    spark = df.sparkSession
    folder = f"{within}/{label}" if within else new_folder(spark, label)
    df.write.parquet(folder)
    return spark.read.schema(df.schema).parquet(folder)


def together(spark: SparkSession, *works) -> list:
    """Do independent works at the same time: one's tasks take the cores that another's last tasks leave idle."""
    with ThreadPoolExecutor(len(works)) as pool:
        return [done.result() for done in [pool.submit(inheritable_thread_target(spark)(work)) for work in works]]


_BYTES_PER_SHUFFLE_PARTITION = 256 * 1024**2


@contextmanager
def shuffle_width(spark: SparkSession, input_bytes: int):
    """Enough shuffle partitions for an input of this size, never fewer than configured.

    Spark merges partitions at run time that turn out small, but does not add any.
    """
    name = "spark.sql.shuffle.partitions"
    configured = spark.conf.get(name)
    needed = math.ceil(input_bytes / _BYTES_PER_SHUFFLE_PARTITION)
    spark.conf.set(name, str(max(int(configured), needed)))
    try:
        yield
    finally:
        spark.conf.set(name, configured)
