"""Grouped sums and counts kept current from the change rows of a merge, without reading the table again.

A change row takes its old image out of one group and puts its new image into
another (or the same). Per group that is a signed count and signed sums: one
aggregate over the changes, combined before the shuffle. They are added to the
mart by a second aggregate over the mart's own rows, which are one per group. The
count tells which groups are left: a group whose last row went is dropped.

Sums are decimals, which come out the same in any order; doubles would drift
with each load. NULL group values form one group, NULL measures count as 0, and
unchanged rows cancel out.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

COUNT = "n_rows"
SUM_TYPE = "decimal(38,4)"


def _sums(rows: DataFrame, by: Sequence[str], measures: Sequence[str]) -> DataFrame:
    return rows.groupBy(*by).agg(F.sum(COUNT).alias(COUNT), *[F.sum(m).cast(SUM_TYPE).alias(m) for m in measures])


def _measure(value: Column) -> Column:
    return F.coalesce(value.cast("decimal(28,4)"), F.lit(0).cast("decimal(28,4)"))


def group_sums(rows: DataFrame, by: Sequence[str], measures: Sequence[str]) -> DataFrame:
    """The mart from a whole table: ``by``, ``n_rows`` and the sum of each measure under its name."""
    return _sums(rows.select(*by, F.lit(1).cast("long").alias(COUNT), *[_measure(F.col(m)).alias(m) for m in measures]),
                 by, measures)


def change_sums(changes: DataFrame, by: Sequence[str], measures: Sequence[str]) -> DataFrame:
    """What change rows (``operators.changes``) add to each group: the mart's columns, signed."""
    inside = set(changes.schema["old"].dataType.fieldNames())

    def image(side: str, sign: int) -> Column:
        def value(c: str) -> Column:
            return F.col(f"{side}.{c}") if c in inside else F.col(c)  # a key stands beside the images

        row = F.struct(*[value(c).alias(c) for c in by], F.lit(sign).cast("long").alias(COUNT),
                       *[(_measure(value(m)) * sign).cast("decimal(28,4)").alias(m) for m in measures])
        return F.when(F.col(side).isNotNull(), row)

    images = F.explode(F.array_compact(F.array(image("old", -1), image("new", 1))))
    return _sums(changes.select(images.alias("image")).select("image.*"), by, measures)


def apply_sums(mart: DataFrame, deltas: DataFrame, by: Sequence[str], measures: Sequence[str]) -> DataFrame:
    """The mart after the changes; groups without a row are gone."""
    columns = [*by, COUNT, *measures]
    return _sums(mart.select(*columns).unionByName(deltas.select(*columns)), by, measures).filter(F.col(COUNT) > 0)
