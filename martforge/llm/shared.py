"""Intermediate tables in the shared folder, and Arrow output helpers."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import work_dir


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet to a new folder below the shared one and read back.

    It cuts the lineage: a lost executor costs the tasks that ran on it, and
    later jobs read the files. An empty table keeps its columns.
    """
    spark, path = df.sparkSession, work_dir(df.sparkSession, "llm", name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def bound_batches(spark: SparkSession) -> None:
    """Small Arrow batches: a task's Python worker holds a batch of texts, whatever their length, and its arrays."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(4 << 20))


def arrow_map(df: DataFrame, fn: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    bound_batches(df.sparkSession)
    return df.mapInArrow(fn, schema)


def crc_mod(column: str, n: int):
    """crc32 of an id's decimal text, modulo n; null for a null id."""
    return F.crc32(F.col(column).cast("string").cast("binary")) % n


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value``, which is computed once per row however often the body uses it.

    The optimizer copies a column's expression to wherever it is used, inside
    lambdas too; the argument of a lambda is a value.
    """
    return F.get(F.transform(F.array(value), body), 0)


# A join of a large table with a few of its ids drops the other rows before its shuffle: Spark builds a
# Bloom filter of the ids (8 MB at most, however many there are) where the small side has a filter.
BLOOM = {
    "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
    "spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold": "0",
    "spark.sql.optimizer.runtime.bloomFilter.creationSideThreshold": "1t",
}


@contextmanager
def settings(spark: SparkSession, conf: dict[str, str]):
    """Session settings for the jobs that run inside; the caller's values come back afterwards."""
    before = {key: spark.conf.get(key, None) for key in conf}
    for key, value in conf.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


def join_few(large: DataFrame, few: DataFrame, on, how: str = "inner", name: str = "joined",
             then: Callable[[DataFrame], DataFrame] = lambda joined: joined) -> DataFrame:
    """``large`` joined with a table of a few of its keys, written; the other rows stay out of the shuffle.

    ``few`` is written first, with a column that its scan filters on: that is
    where Spark builds the Bloom filter. ``then`` makes what is written of
    the joined rows.
    """
    spark = large.sparkSession
    keys = written(few.withColumn("few_row", F.lit(1)), f"{name}_keys").filter("few_row > 0").drop("few_row")
    with settings(spark, BLOOM):
        return written(then(large.join(keys, on, how)), name)
