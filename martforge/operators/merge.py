"""Merge of a de-duplicated batch into the current trusted snapshot.

The reference runs one MERGE per batch:

* matched            -> update every non-key column from the batch
* not matched by source -> delete (no condition)
* not matched by target -> insert

Because of the unconditional delete, the merged table equals the batch
itself; the join only classifies the changes. So the classification joins
key columns only (narrow shuffle), and the new snapshot is written straight
from the batch. ``upsert`` keeps target rows whose key is not in the batch
(a true delta file), an anti join on the keys.

Keys are compared with ``=``: a NULL key never matches (D10). Rows with a
NULL key part are set aside before the join, so they cannot pile up in the
one shuffle partition that NULL hashes to.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import MERGE_SNAPSHOT, MERGE_UPSERT

INSERT, UPDATE, DELETE = "I", "U", "D"


def _all_keys_present(keys: Sequence[str]):
    cond = F.lit(True)
    for k in keys:
        cond = cond & F.col(k).isNotNull()
    return cond


def classify_changes(target: DataFrame, batch: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Per key: ``action`` I (batch only), U (both) or D (target only)."""
    keys = list(keys)
    present = _all_keys_present(keys)
    t = target.select(*keys).withColumn("__in_target", F.lit(True))
    s = batch.select(*keys).withColumn("__in_batch", F.lit(True))
    joined = t.filter(present).join(s.filter(present), keys, "full_outer")
    matched = joined.select(
        *keys,
        F.when(F.col("__in_target") & F.col("__in_batch"), F.lit(UPDATE))
        .when(F.col("__in_batch"), F.lit(INSERT))
        .otherwise(F.lit(DELETE))
        .alias("action"),
        F.lit(False).alias("null_key"),
    )
    null_deletes = t.filter(~present).select(*keys, F.lit(DELETE).alias("action"), F.lit(True).alias("null_key"))
    null_inserts = s.filter(~present).select(*keys, F.lit(INSERT).alias("action"), F.lit(True).alias("null_key"))
    return matched.unionByName(null_deletes).unionByName(null_inserts)


def change_counts(target: DataFrame, batch: DataFrame, keys: Sequence[str], mode: str = MERGE_SNAPSHOT) -> DataFrame:
    """One row: ``rows_inserted``, ``rows_updated``, ``rows_deleted``, ``null_keys``.

    In ``upsert`` mode nothing is deleted. ``null_keys`` counts batch rows
    with a NULL key part (inserted, never matched).
    """
    actions = classify_changes(target, batch, keys)
    deleted = F.count(F.when(F.col("action") == DELETE, 1)) if mode == MERGE_SNAPSHOT else F.lit(0).cast("bigint")
    return actions.agg(
        F.count(F.when(F.col("action") == INSERT, 1)).alias("rows_inserted"),
        F.count(F.when(F.col("action") == UPDATE, 1)).alias("rows_updated"),
        deleted.alias("rows_deleted"),
        F.count(F.when(F.col("null_key") & (F.col("action") == INSERT), 1)).alias("null_keys"),
    )


def merge_in_place(target: DataFrame, batch: DataFrame, keys: Sequence[str], mode: str = MERGE_SNAPSHOT) -> DataFrame:
    """The merged rows, in the partitions of ``batch``: both sides are dealt by the keys, and no key part is NULL.

    An upsert is a full outer join that takes the batch's row where there is
    one; joined with a bucketed target, neither the join nor the bucketed
    write that follows moves a row of the target.
    """
    if mode == MERGE_SNAPSHOT:
        return batch
    keys, columns = list(keys), batch.columns
    rest = [c for c in columns if c not in keys]
    old = target.select(*keys, F.struct(*rest).alias("__old"))
    new = batch.select(*keys, F.struct(*rest).alias("__new"))
    both = old.join(new.hint("merge"), keys, "full_outer")
    kept = F.coalesce("__new", "__old")
    return both.select(*keys, kept.alias("__row")).select(*[c if c in keys else F.col(f"__row.{c}").alias(c) for c in columns])


def counts_as_rows(counts: DataFrame) -> DataFrame:
    """The one-row counts as three ``(action, n_rows)`` rows."""
    return counts.select(
        F.expr(
            "stack(3, 'I', rows_inserted, 'U', rows_updated, 'D', rows_deleted) AS (action, n_rows)"
        )
    )


def apply_merge(target: DataFrame, batch: DataFrame, keys: Sequence[str], mode: str = MERGE_SNAPSHOT) -> DataFrame:
    """The trusted table after the merge.

    ``snapshot`` (the reference): the batch, since unmatched target rows are
    deleted and matched ones take every value from the batch.
    ``upsert``: the batch plus target rows whose key is not in the batch.
    """
    if mode == MERGE_SNAPSHOT:
        return batch
    if mode != MERGE_UPSERT:
        raise ValueError(f"merge mode {mode!r}")
    keys = list(keys)
    # a NULL key matches nothing, so the anti join keeps the target's NULL-keyed rows; those of the
    # batch stay out of the join (a hot partition of the target, NULL keys or not, is split by AQE)
    kept = target.join(batch.select(*keys).filter(_all_keys_present(keys)), keys, "left_anti")
    return batch.unionByName(kept.select(*batch.columns))
