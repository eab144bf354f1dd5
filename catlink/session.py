"""Session settings the operators rely on."""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

FOLDER = "spark.checkpoint.dir"

CLEAN = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"
BATCH_BYTES = 8 << 20

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
}


def builder(app: str = "catlink") -> SparkSession.Builder:
    b = SparkSession.builder.appName(app)
    for key, value in SETTINGS.items():
        b = b.config(key, value)
    return b


def checkpoint_folder(spark: SparkSession) -> str:
    """The shared folder that the session names."""
    folder = spark.conf.get(FOLDER, None)
    if not folder:
        raise ValueError(f"{FOLDER} names no folder: set it to one that the driver and all executors share")
    return folder


def bound_batches(spark: SparkSession) -> None:
    """Rows go to Python workers in batches of ``BATCH_BYTES`` at most, whatever their number; a lower bound of the session stays."""
    digits, unit = re.fullmatch(r"(\d+)([kmg]?)b?", spark.conf.get(BATCH).lower()).groups()
    if int(digits) << {"": 0, "k": 10, "m": 20, "g": 30}[unit] > BATCH_BYTES:
        spark.conf.set(BATCH, str(BATCH_BYTES))


def stored_path(spark: SparkSession, name: str) -> str:
    return f"{checkpoint_folder(spark).rstrip('/')}/catlink/{name}-{uuid.uuid4().hex}"


@contextmanager
def dropping_shuffles(spark: SparkSession) -> Iterator[None]:
    """Queries run inside give their shuffle files back when they end, not when the driver happens to collect its garbage."""
    before = spark.conf.get(CLEAN, None)
    spark.conf.set(CLEAN, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(CLEAN)
        else:
            spark.conf.set(CLEAN, before)


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write the rows as a table in the shared checkpoint folder and read them back.

    This is the library's form of a materialised view: the lineage ends at files that outlive
    any executor, and later readers get column pruning, filter pushdown and file sizes, by which
    Spark chooses its joins.
    """
    path = stored_path(df.sparkSession, name)
    with dropping_shuffles(df.sparkSession):
        df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
