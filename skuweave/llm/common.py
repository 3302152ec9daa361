"""Helpers shared by the training-data operators."""

from __future__ import annotations

import ctypes
import gc

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skuweave.sources.shared import new_path, remove


def written(df: DataFrame, name: str) -> DataFrame:
    """df as a table in the shared folder: cuts the lineage, survives lost executors, keeps column pruning."""
    return Scratch(df.sparkSession, name).table(df, "")


class Scratch:
    """The tables of one run in the shared folder, which cut the lineage and survive lost executors."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark, self.path = spark, new_path(spark, name)
        self.count = 0

    def table(self, df: DataFrame, name: str) -> DataFrame:
        """df, written and read again."""
        self.count += 1
        path = f"{self.path}/{self.count}{name}"
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def last(self, df: DataFrame, name: str) -> DataFrame:
        """df as a table that stays; all other tables of this run are deleted."""
        out = written(df, name)
        remove(self.spark, self.path)
        return out


def small_batches(spark: SparkSession, rows: int = 1000) -> None:
    """Lets Arrow batches have no more than so many rows from now on in this session: whole texts can be long."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    now = int(spark.conf.get(key, "10000"))
    if now <= 0 or now > rows:
        spark.conf.set(key, str(rows))


_held: list[dict] = []


def hold(memory: dict) -> None:
    """Says that this Python worker now fills `memory`; what another operator had filled before is emptied.

    Workers live on from stage to stage, so without this the operators' memories would add up.
    """
    if not (_held and _held[0] is memory):
        for other in _held:
            other.clear()
        if _held:
            release()
        _held[:] = [memory]


def release() -> None:
    """Gives freed memory of this Python worker back to the system, so that the JVM beside it has room."""
    import pyarrow

    gc.collect()
    pyarrow.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):
        pass  # not this C library


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def unit_hash(*cols) -> F.Column:
    """A uniform double in [0, 1) from md5 of the columns joined by ':'; the same in any SQL engine that has md5."""
    text = F.concat_ws(":", *cols)
    return F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("double") / F.lit(float(1 << 52))
