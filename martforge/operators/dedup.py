"""Latest row per key and duplicate-key reports.

The reference picks the latest row per key with ``ROW_NUMBER() OVER
(PARTITION BY pk ORDER BY partition_time DESC) = 1`` and then ``SELECT
DISTINCT *``. Here the same result is an aggregate: ``max`` over a struct
whose leading fields are the ordering columns. An aggregate combines map-side,
so a key holding a third of all rows is reduced to one row per input split
before the shuffle; a window would send all its rows to one task. Ties are
broken on the remaining columns, so a rerun returns the same row (D7).
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.dates import ntz_lit


def latest_per_key(
    df: DataFrame,
    keys: Sequence[str],
    order_by: Sequence[str],
    tie_break: Sequence[str] | None = None,
) -> DataFrame:
    """One row per key: the greatest ``order_by`` (then ``tie_break``) values.

    ``order_by`` and ``tie_break`` are compared in sequence, all descending,
    NULL lowest. By default every other column breaks ties, so the choice is
    total. NULL keys form one group, as ``PARTITION BY`` does.
    """
    keys, order_by = list(keys), list(order_by)
    rest = [c for c in df.columns if c not in keys and c not in order_by]
    ties = rest if tie_break is None else list(tie_break)
    fields = order_by + ties + [c for c in rest if c not in ties]
    latest = df.groupBy(*keys).agg(F.max(F.struct(*fields)).alias("__latest"))
    return latest.select(*keys, *[F.col(f"__latest.{c}").alias(c) for c in fields]).select(*df.columns)


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys present more than once, with their row count (``n_rows``)."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows")).filter(F.col("n_rows") > 1)


def assert_unique_keys(df: DataFrame, keys: Sequence[str], what: str = "batch") -> None:
    """Raise when any key has more than one row (a merge needs one source row per key).

    Runs one aggregate job and brings back at most one row.
    """
    dup = duplicate_keys(df, keys).limit(1).collect()
    if dup:
        raise ValueError(f"{what}: key {dict((k, dup[0][k]) for k in keys)} has {dup[0]['n_rows']} rows")


def changed_since(df: DataFrame, modified: str, watermark: dt.datetime | dt.date) -> DataFrame:
    """Rows modified on or after the last watermark, and rows without a date (incremental load, P9).

    ``>=``: a row changed later on the watermark's own day is not lost, and
    applying a row twice does no harm in an upsert. An undated row may be new.
    """
    c = F.col(modified)
    bound = ntz_lit(watermark) if dict(df.dtypes).get(modified) == "timestamp_ntz" else F.lit(watermark)
    return df.filter((c >= bound) | c.isNull())
