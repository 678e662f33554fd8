"""Trusted as it stood at a stamp, rebuilt from the raw history in one pass.

Snapshots may be gone (``TableSpec.keep_versions``); the raw history keeps every
batch. Which batches count, and in which order, is what the commit log says: a
batch counts if it was committed and its stamp is not after the asked one, at
the place of its last commit. Batches that were skipped (older than the
committed one, empty) were never committed and do not count.

* Full loads and snapshot merges: the last batch that counts is the table, so
  rows that it lacks are deleted; only its folder is read.
* Upserts: per key the row of the last batch that has the key, by one aggregate
  over the batches that count (combined before the shuffle, so a key with very
  many rows is no hot spot); no batch is replayed. Rows with a NULL key part
  match nothing: each batch adds its own.

A batch that was run again has the rows and the stamp of its last run, as in the
raw history. Upserts by modification date (``TableSpec.modified``) depend on the
table as it was at each load and are refused.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import LOAD_FULL, MERGE_UPSERT, TableSpec
from ..functions.casts import quarantine_split, typed_projection
from ..functions.dates import ntz_lit
from ..operators.dedup import latest_per_key
from ..sources import layers as L

_ORDER = ("partition_time", *[name for name, _ in L.FILE_COLUMNS])


def applied_batches(spark: SparkSession, layout: L.LakeLayout, spec: TableSpec, stamp: dt.datetime) -> DataFrame | None:
    """batch_id, nth (orders the batches) and batch_stamp of the batches that count; None before the first commit."""
    commits = L.commit_log(spark, layout.trusted(spec))
    if commits is None:
        return None
    place = F.struct("committed_at", "version")
    return commits.groupBy("batch_id").agg(
        F.max(place).alias("nth"), F.max_by("partition_time", place).alias("batch_stamp")).filter(
        F.col("batch_stamp") <= ntz_lit(stamp))


def trusted_as_of(spark: SparkSession, layout: L.LakeLayout, spec: TableSpec, stamp: dt.datetime,
                  quarantine: bool = False) -> DataFrame:
    """The trusted table after the loads up to ``stamp``; empty before the first one.

    ``quarantine``: leave out the values that do not cast, as loads with
    ``quarantine`` did, instead of failing.
    """
    if spec.modified and spec.load_mode != LOAD_FULL:
        raise ValueError(f"{spec.name}: loads by modification date cannot be rebuilt from the raw history")
    applied = applied_batches(spark, layout, spec, stamp)
    columns = [*spec.lake_columns, "partition_time"]

    def typed(rows: DataFrame, *extra: str) -> DataFrame:
        keep = (*_ORDER, *extra)
        return quarantine_split(rows, spec, keep)[0] if quarantine else typed_projection(rows, spec, keep)

    if spec.load_mode != LOAD_FULL and spec.merge_mode == MERGE_UPSERT:
        if applied is None:
            return L.read_trusted_version(spark, layout, spec, None)
        counted = applied.select("batch_id", F.col("nth").alias("__nth"), "batch_stamp")
        raw = L.read_raw(spark, layout, spec).filter(
            (F.col("partition_month") <= f"{stamp:%Y-%m}") & (F.col("partition_time") <= ntz_lit(stamp)))
        # of a batch the load takes the rows from its stamp on
        rows = raw.join(counted, "batch_id").filter(F.col("partition_time") >= F.col("batch_stamp"))
        rows = typed(rows, "batch_id", "__nth").withColumn(
            "__apart", F.when(~L._present(spec.keys), F.col("batch_id"))).drop("batch_id")
        return latest_per_key(rows, [*spec.keys, "__apart"], ["__nth", *_ORDER]).select(*columns)

    last = None if applied is None else applied.agg(F.max_by(F.struct("batch_id", "batch_stamp"), "nth").alias("last")).first()["last"]
    if last is None:
        return L.read_trusted_version(spark, layout, spec, None)
    full = spec.load_mode == LOAD_FULL
    rows = typed(L.raw_batch_rows(spark, layout, spec, last["batch_stamp"], exact=full, batch_id=last["batch_id"]))
    return (rows if full else latest_per_key(rows, spec.keys, _ORDER)).select(*columns)
