"""Session helpers: reading the tables of a folder and cutting lineage."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """The parquet table ``name`` of a folder (a file or a directory of files)."""
    return spark.read.parquet(f"{folder}/{name}.parquet")


def spread(df: DataFrame) -> DataFrame:
    """df over all cores, if its scan has fewer parts than there are cores: a small file that costs much work per row. Large inputs are left as they are split."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def settled(df: DataFrame) -> DataFrame:
    """df with its columns computed before anything that follows: a one-element explode, across which the optimizer does not copy expressions into every later use."""
    return df.select(F.explode(F.array(F.struct(*df.columns))).alias("_row")).select("_row.*")


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The folder that all executors share, as spark.checkpoint.dir names it; one of our own only where it is unset and the session is local."""
    sc = spark.sparkContext
    have = sc.getCheckpointDir()
    if have:
        return have
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        if not sc.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        named = tempfile.mkdtemp(prefix="quern-checkpoint-")
    sc.setCheckpointDir(named)
    return sc.getCheckpointDir()


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder under the shared checkpoint folder, for files that a query writes and reads again."""
    return f"{ensure_checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}"


@contextmanager
def sized(spark: SparkSession, rows: int, each: int = 400_000) -> Iterator[None]:
    """Within it, shuffles have so many partitions that one holds about ``each`` of the rows; never fewer than the session has set.  For steps that are computed at once."""
    name = "spark.sql.shuffle.partitions"
    was = spark.conf.get(name)
    spark.conf.set(name, str(max(int(was), -(-rows // each))))
    try:
        yield
    finally:
        spark.conf.set(name, was)


def cut(df: DataFrame) -> DataFrame:
    """df written to the shared checkpoint folder, with its lineage cut."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
