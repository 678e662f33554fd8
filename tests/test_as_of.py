"""Trusted rebuilt from raw as of every stamp, and marts kept current by change rows."""

import datetime as dt
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from martforge.config import LOAD_FULL, LOAD_MERGE, MERGE_SNAPSHOT, MERGE_UPSERT, ColumnSpec, TableSpec
from martforge.operators import changes, deltas
from martforge.plans import load as LD
from martforge.plans.as_of import trusted_as_of
from martforge.sources import layers as L

SPEC = TableSpec("thing.csv", tuple(ColumnSpec(c, t) for c, t in (("ThingID", "int"), ("Name", "string"), ("Amount", "float"))),
                 keys=("ThingID",), load_mode=LOAD_MERGE)
STAMPS = [dt.datetime(2024, 1, 30) + dt.timedelta(days=i) for i in range(4)]  # two months
BATCHES = [
    [("1", "a", "1"), ("2", "b", "2"), ("3", "c", "3"), (None, "no key", "1"), ("1", "z", "9")],  # a repeated key
    [("2", "b", "2"), ("3", "changed", "3"), ("4", "d", "4"), (None, "other", "1")],
    [("5", "late", "5")],  # older than what is committed when it comes: raw only
    [("1.0", "back", "7"), (None, None, None)],
]


def rows(df):
    return sorted(map(repr, (tuple(r) for r in df.collect())))


@pytest.mark.parametrize("change", [
    {"load_mode": LOAD_FULL}, {"merge_mode": MERGE_SNAPSHOT}, {"merge_mode": MERGE_UPSERT},
    {"merge_mode": MERGE_UPSERT, "buckets": 4}], ids=["full", "snapshot", "upsert", "buckets"])
def test_equal_to_each_committed_snapshot(spark, scratch, change):
    spec, layout = replace(SPEC, **change), L.LakeLayout(f"{scratch}/lake")
    seen = {}
    for i, batch in enumerate(BATCHES):
        text = spark.createDataFrame(batch, "thing_id string, name string, amount string")
        stamp = STAMPS[0] if i == 2 else STAMPS[i]
        result = LD.load_batch(spark, spec, text, layout, f"00000{i}", stamp)
        assert (result.version is None) == (i == 2)
        if result.version:
            seen[stamp] = rows(L.read_trusted(spark, layout, spec))
    for stamp, want in seen.items():
        got = trusted_as_of(spark, layout, spec, stamp)
        assert got.columns == L.trusted_schema(spec).fieldNames()
        assert rows(got) == want, stamp
    assert rows(trusted_as_of(spark, layout, spec, STAMPS[2])) == seen[STAMPS[1]]
    assert trusted_as_of(spark, layout, spec, dt.datetime(2023, 1, 1)).isEmpty()


def test_before_any_load_and_by_modification_date(spark, scratch):
    layout = L.LakeLayout(f"{scratch}/lake")
    for mode in (MERGE_SNAPSHOT, MERGE_UPSERT):
        assert trusted_as_of(spark, layout, replace(SPEC, merge_mode=mode), STAMPS[0]).isEmpty()
    with pytest.raises(ValueError, match="modification date"):
        trusted_as_of(spark, layout, replace(SPEC, merge_mode=MERGE_UPSERT, modified="name"), STAMPS[0])


OLD = [(1, "x", 1.10), (2, "x", 2.20), (3, None, 3.0), (4, "y", None), (5, "gone", 5.0), (None, "x", 0.1)]
NEW = [(1, "x", 1.10), (2, "y", 2.25), (3, None, 4.0), (6, "new", 6.0), (None, "x", 0.2), (7, None, None)]


@pytest.mark.parametrize("mode", [MERGE_SNAPSHOT, MERGE_UPSERT])
@pytest.mark.parametrize("by", [["g"], ["k"], ["g", "k"]])
def test_sums_from_changes_equal_a_rebuild(spark, mode, by):
    from martforge.operators.merge import apply_merge

    old, new = (spark.createDataFrame(r, "k long, g string, v double") for r in (OLD, NEW))
    found = changes.change_rows(old, new, ["k"], mode)
    measures = ["v"]
    got = deltas.apply_sums(deltas.group_sums(old, by, measures), deltas.change_sums(found, by, measures), by, measures)
    want = deltas.group_sums(apply_merge(old, new, ["k"], mode), by, measures)
    assert rows(got) == rows(want) and got.schema.simpleString() == want.schema.simpleString()
    stored = found.filter(F.col("action") != changes.SAME)  # unchanged rows add nothing
    again = deltas.apply_sums(deltas.group_sums(old, by, measures), deltas.change_sums(stored, by, measures), by, measures)
    assert rows(again) == rows(want)
