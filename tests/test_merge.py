"""Merge semantics (FIXTURES.md section 5) and properties on random inputs."""

import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from martforge.config import MERGE_SNAPSHOT, MERGE_UPSERT
from martforge.operators import dedup, merge

SCHEMA = "k bigint, v string, t timestamp_ntz"
T1, T2 = dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 2)


def _df(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def _rows(df):
    return sorted((tuple(r) for r in df.collect()), key=lambda r: (r[0] is None, r[0] or 0, r[1] or "", r[2]))


def _counts(spark, target, batch, mode=MERGE_SNAPSHOT):
    r = merge.change_counts(target, batch, ["k"], mode).collect()[0]
    return r["rows_inserted"], r["rows_updated"], r["rows_deleted"], r["null_keys"]


def test_case_table(spark):
    target = _df(spark, [(1, "a", T1), (2, "b", T1)])
    batch = _df(spark, [(2, "c", T2), (3, "d", T2)])
    assert _rows(merge.apply_merge(target, batch, ["k"], MERGE_SNAPSHOT)) == [(2, "c", T2), (3, "d", T2)]
    assert _rows(merge.apply_merge(target, batch, ["k"], MERGE_UPSERT)) == [(1, "a", T1), (2, "c", T2), (3, "d", T2)]
    assert _counts(spark, target, batch) == (1, 1, 1, 0)
    assert _counts(spark, target, batch, MERGE_UPSERT) == (1, 1, 0, 0)


def test_null_keys_never_match(spark):
    target = _df(spark, [(None, "x", T1)])
    batch = _df(spark, [(None, "y", T2)])
    assert _rows(merge.apply_merge(target, batch, ["k"], MERGE_SNAPSHOT)) == [(None, "y", T2)]
    assert len(_rows(merge.apply_merge(target, batch, ["k"], MERGE_UPSERT))) == 2
    assert _counts(spark, target, batch) == (1, 0, 1, 1)


def test_same_time_duplicates_pick_one_row_repeatably(spark):
    batch = _df(spark, [(1, "a", T1), (1, "b", T1)])
    first = _rows(dedup.latest_per_key(batch, ["k"], ["t"]))
    assert first == [(1, "b", T1)]  # ties broken on the remaining columns, greatest wins
    assert _rows(dedup.latest_per_key(batch.repartition(3), ["k"], ["t"])) == first


def test_latest_stamp_wins(spark):
    batch = _df(spark, [(1, "new", T2), (1, "old", T1), (2, "x", T1)])
    assert _rows(dedup.latest_per_key(batch, ["k"], ["t"])) == [(1, "new", T2), (2, "x", T1)]


def test_composite_key_compares_every_part(spark):
    schema = "a bigint, b bigint, v string"
    target = spark.createDataFrame([(1, 1, "x"), (1, 2, "y")], schema)
    batch = spark.createDataFrame([(1, 2, "z"), (2, 1, "w")], schema)
    r = merge.change_counts(target, batch, ["a", "b"]).collect()[0]
    assert (r["rows_inserted"], r["rows_updated"], r["rows_deleted"]) == (1, 1, 1)


def test_duplicate_key_guard(spark):
    import pytest

    batch = _df(spark, [(1, "a", T1), (1, "b", T2)])
    with pytest.raises(ValueError, match="has 2 rows"):
        dedup.assert_unique_keys(batch, ["k"])
    dedup.assert_unique_keys(dedup.latest_per_key(batch, ["k"], ["t"]), ["k"])


keys = st.one_of(st.none(), st.integers(0, 6))
rows = st.lists(st.tuples(keys, st.sampled_from(["a", "b", "c"])), max_size=8)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(target_rows=rows, batch_rows=rows)
def test_merge_properties(spark, target_rows, batch_rows):
    # target: unique non-null keys (as a trusted table is) plus any null-key rows
    seen, tgt = set(), []
    for k, v in target_rows:
        if k is None or k not in seen:
            tgt.append((k, v, T1))
            seen.add(k)
    target = _df(spark, tgt)
    batch = dedup.latest_per_key(_df(spark, [(k, v, T2) for k, v in batch_rows]), ["k"], ["t"])
    b = _rows(batch)
    snap = _rows(merge.apply_merge(target, batch, ["k"], MERGE_SNAPSHOT))
    assert snap == b
    batch_keys = {r[0] for r in b if r[0] is not None}
    upsert = _rows(merge.apply_merge(target, batch, ["k"], MERGE_UPSERT))
    expected = sorted(b + [r for r in tgt if r[0] is None or r[0] not in batch_keys],
                      key=lambda r: (r[0] is None, r[0] or 0, r[1] or "", r[2]))
    assert upsert == expected
    ins, upd, dele, _ = _counts(spark, target, batch)
    assert ins + upd == len(b)
    assert dele == len(tgt) - upd
    # merging the same batch again changes nothing, except that NULL keys never
    # match (D10): every merge inserts a batch's NULL-key rows once more
    keyed = batch.filter("k IS NOT NULL")
    once = merge.apply_merge(target, keyed, ["k"], MERGE_UPSERT)
    assert _rows(merge.apply_merge(once, keyed, ["k"], MERGE_UPSERT)) == _rows(once)
