"""Change rows of a merge: what a batch inserts, changes, deletes and leaves as it is, with old and new values.

The classification of ``operators.merge`` follows the reference: every match is
an update. Here a hash of a row's values tells matches that change something
from those that do not; the rows themselves are compared where the hashes
agree by chance only, so once in 2^64. Values are equal as hashed: two NULLs
are, 0.0 and -0.0 are not. Columns that change with every load (the batch
stamp) are left out of the comparison and kept in the images.

Keys are compared with ``=``; rows with a NULL key part match nothing: they are
deletions (snapshot mode) and insertions, and stay out of the join.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import MERGE_SNAPSHOT
from .merge import DELETE, INSERT, UPDATE, _all_keys_present

SAME = "N"
STAMPS = ("partition_time",)


def row_hash(columns: Sequence[str]) -> Column:
    """A hash of the values and of which of them are NULL (a hash of values alone passes over NULLs)."""
    return F.xxhash64(*[F.col(c).isNull() for c in columns], *[F.col(c) for c in columns])


def change_rows(target: DataFrame, batch: DataFrame, keys: Sequence[str], mode: str = MERGE_SNAPSHOT,
                ignore: Sequence[str] = STAMPS) -> DataFrame:
    """keys, ``action`` (I, U, D or N for unchanged), ``old`` and ``new`` (structs of the other columns).

    Both sides have one row per key. In upsert mode the target's rows without
    a match stay as they are and are not returned.
    """
    keys = list(keys)
    values = [c for c in batch.columns if c not in keys]
    compared = [c for c in values if c not in ignore]
    present = _all_keys_present(keys)

    def side(rows: DataFrame, name: str) -> DataFrame:
        return rows.select(*keys, F.struct(*values).alias(name), row_hash(compared).alias(f"{name}_hash"))

    how = "full_outer" if mode == MERGE_SNAPSHOT else "right"
    both = side(target.filter(present), "old").join(side(batch.filter(present), "new"), keys, how)
    action = (F.when(F.col("old").isNull(), INSERT).when(F.col("new").isNull(), DELETE)
              .when(F.col("old_hash") == F.col("new_hash"), SAME).otherwise(UPDATE))
    out = both.select(*keys, action.alias("action"), "old", "new")
    kind = dict(out.dtypes)["old"]
    out = out.unionByName(side(batch.filter(~present), "new").select(
        *keys, F.lit(INSERT).alias("action"), F.lit(None).cast(kind).alias("old"), "new"))
    if mode == MERGE_SNAPSHOT:
        out = out.unionByName(side(target.filter(~present), "old").select(
            *keys, F.lit(DELETE).alias("action"), "old", F.lit(None).cast(kind).alias("new")))
    return out


def apply_changes(old: DataFrame, changes: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The snapshot after the changes: the old one without the keys that were changed or deleted, and the new images.

    Rows with a NULL key part are matched by all their values: a deletion takes
    out as many equal rows as it has.
    """
    keys, columns = list(keys), old.columns
    values = [c for c in columns if c not in keys]
    present = _all_keys_present(keys)
    gone = changes.filter(F.col("action").isin(UPDATE, DELETE) & present).select(*keys)
    kept = old.filter(present).join(gone, keys, "left_anti")
    dropped = changes.filter((F.col("action") == DELETE) & ~present).select(*keys, *[F.col(f"old.{c}").alias(c) for c in values])
    unkeyed = old.filter(~present).exceptAll(dropped.select(*columns))
    added = changes.filter(F.col("action").isin(INSERT, UPDATE)).select(*keys, *[F.col(f"new.{c}").alias(c) for c in values])
    return kept.select(*columns).union(unkeyed).union(added.select(*columns))
