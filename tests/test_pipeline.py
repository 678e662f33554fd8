
import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from martforge.config import LOAD_FULL, LOAD_MERGE, MERGE_UPSERT, ColumnSpec, TableSpec
from martforge.operators.audit import read_audit
from martforge.plans import load as LD
from martforge.sources import layers as L
from martforge.sources.flatfile import read_flat_file

SPEC = TableSpec(
    "Sales.Thing.csv",
    (ColumnSpec("ThingID", "int"), ColumnSpec("Name", "string"), ColumnSpec("Amount", "float"),
     ColumnSpec("Day", "date")),
    keys=("ThingID",),
    load_mode=LOAD_MERGE,
)
T1, T2, T3 = dt.datetime(2024, 8, 31, 21), dt.datetime(2024, 9, 5, 9), dt.datetime(2024, 9, 6, 9)


def local(path):
    return path[5:] if path.startswith("file:") else path


def write_csv(folder, name, lines):
    os.makedirs(local(folder), exist_ok=True)
    path = f"{folder}/{name}"
    with open(local(path), "w") as f:
        f.write("\n".join(lines) + "\n")
    return path


def load(spark, layout, folder, name, lines, batch_id, stamp, spec=SPEC):
    path = write_csv(folder, name, lines)
    return LD.load_batch(spark, spec, read_flat_file(spark, path, spec), layout, batch_id, stamp)


def trusted(spark, layout, spec=SPEC):
    rows = [tuple(r) for r in L.read_trusted(spark, layout, spec).drop("partition_time").collect()]
    return sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, repr(r)))


B1 = ["ThingID;Name;Amount;Day", "1;a;1,5;2024-01-01", "2;b;2.5;2024-01-02", "3;c;-;2024-01-03"]
B2 = ["Name;ThingID;Amount;Day",  # other column order: read by header name
      "b2;2.0;20;2024-02-02", "c2;3;30;2024-02-03 10:00:00", "d;4;NA;", "d;4;NA;"]


def test_two_batches_merge(spark, scratch):
    layout = L.LakeLayout(f"{scratch}/lake")
    r1 = load(spark, layout, scratch, "b1.csv", B1, "000001", T1)
    assert (r1.rows_in, r1.rows_inserted, r1.rows_updated, r1.rows_deleted) == (3, 3, 0, 0)
    r2 = load(spark, layout, scratch, "b2.csv", B2, "000002", T2)
    assert (r2.rows_in, r2.rows_inserted, r2.rows_updated, r2.rows_deleted) == (4, 1, 2, 1)
    assert trusted(spark, layout) == [
        (2, "b2", 20.0, dt.date(2024, 2, 2)), (3, "c2", 30.0, dt.date(2024, 2, 3)), (4, "d", None, None)]
    raw = L.read_raw(spark, layout, SPEC)
    assert raw.count() == 7
    assert sorted(r[0] for r in raw.select("partition_month").distinct().collect()) == ["2024-08", "2024-09"]
    audit = read_audit(spark, layout.audit).filter(F.col("operation") == "MERGE").orderBy("batch_id").collect()
    assert [(a["rows_inserted"], a["rows_updated"], a["rows_deleted"]) for a in audit] == [(3, 0, 0), (1, 2, 1)]
    marks = L.latest_watermarks(spark, layout).collect()
    assert [(m["partition_time"], m["n_batches"]) for m in marks] == [(T2, 2)]


def test_rerun_of_a_batch_does_not_double_raw(spark, scratch):
    layout = L.LakeLayout(f"{scratch}/lake")
    load(spark, layout, scratch, "b1.csv", B1, "000001", T1)
    load(spark, layout, scratch, "b1.csv", B1, "000001", T1)
    assert L.read_raw(spark, layout, SPEC).count() == 3
    assert len(trusted(spark, layout)) == 3


def test_failure_before_commit_keeps_old_snapshot(spark, scratch, monkeypatch):
    layout = L.LakeLayout(f"{scratch}/lake")
    load(spark, layout, scratch, "b1.csv", B1, "000001", T1)
    before = trusted(spark, layout)

    def boom(*a, **k):
        raise RuntimeError("lost before commit")

    monkeypatch.setattr(L, "commit_snapshot", boom)
    with pytest.raises(RuntimeError):
        load(spark, layout, scratch, "b2.csv", B2, "000002", T2)
    assert trusted(spark, layout) == before
    statuses = [r["status"] for r in read_audit(spark, layout.audit).collect()]
    assert "ERROR" in statuses


def test_empty_batch_is_refused(spark, scratch):
    layout = L.LakeLayout(f"{scratch}/lake")
    load(spark, layout, scratch, "b1.csv", B1, "000001", T1)
    r = load(spark, layout, scratch, "empty.csv", ["ThingID;Name;Amount;Day"], "000002", T2)
    assert r.status == "SKIPPED"
    assert len(trusted(spark, layout)) == 3


def test_bad_int_fails_the_load(spark, scratch):
    layout = L.LakeLayout(f"{scratch}/lake")
    with pytest.raises(Exception):
        load(spark, layout, scratch, "bad.csv", ["ThingID;Name;Amount;Day", "x;a;1;2024-01-01"], "000001", T1)
    assert L.current_version(spark, layout, SPEC) is None


def test_full_load_keeps_only_the_latest_batch(spark, scratch):
    from dataclasses import replace

    spec = replace(SPEC, load_mode=LOAD_FULL)
    layout = L.LakeLayout(f"{scratch}/lake")
    load(spark, layout, scratch, "b1.csv", B1, "000001", T1, spec)
    r = load(spark, layout, scratch, "b3.csv", ["ThingID;Name;Amount;Day", "9;z;1;2024-03-03"], "000002", T3, spec)
    assert (r.rows_inserted, r.rows_deleted) == (1, 3)
    assert trusted(spark, layout, spec) == [(9, "z", 1.0, dt.date(2024, 3, 3))]


def test_upsert_keeps_rows_missing_from_a_delta(spark, scratch):
    from dataclasses import replace

    spec = replace(SPEC, merge_mode=MERGE_UPSERT)
    layout = L.LakeLayout(f"{scratch}/lake")
    load(spark, layout, scratch, "b1.csv", B1, "000001", T1, spec)
    r = load(spark, layout, scratch, "b2.csv", B2, "000002", T2, spec)
    assert (r.rows_inserted, r.rows_updated, r.rows_deleted) == (1, 2, 0)
    assert [k for k, *_ in trusted(spark, layout, spec)] == [1, 2, 3, 4]


def test_quarantine_sets_bad_rows_aside(spark, scratch):
    layout = L.LakeLayout(f"{scratch}/lake")
    lines = ["ThingID;Name;Amount;Day", "1;a;1;2024-01-01", "x;b;2;2024-01-02", "3;c;zz;02/01/2024"]
    path = write_csv(scratch, "q.csv", lines)
    r = LD.load_batch(spark, SPEC, read_flat_file(spark, path, SPEC), layout, "000001", T1, quarantine=True)
    assert (r.rows_in, r.rows_inserted, r.rows_rejected) == (3, 1, 2)
    bad = {row["thing_id"]: row["bad_column"] for row in L.read_quarantine(spark, layout, SPEC).collect()}
    assert bad == {"x": "thing_id", "3": "day"}
    assert trusted(spark, layout) == [(1, "a", 1.0, dt.date(2024, 1, 1))]


def test_files_with_disagreeing_headers_fail(spark, scratch):
    folder = f"{scratch}/mixed"
    write_csv(folder, "a.csv", ["ThingID;Name;Amount;Day", "1;a;1;2024-01-01"])
    write_csv(folder, "b.csv", ["Name;ThingID;Amount;Day", "b;2;1;2024-01-01"])
    with pytest.raises(Exception):
        read_flat_file(spark, folder, SPEC).collect()


def test_raw_only_mode_leaves_trusted_alone(spark, scratch):
    from dataclasses import replace

    from martforge.config import LOAD_RAW_ONLY

    layout = L.LakeLayout(f"{scratch}/lake")
    load(spark, layout, scratch, "b1.csv", B1, "000001", T1)
    r = load(spark, layout, scratch, "b2.csv", B2, "000002", T2, replace(SPEC, load_mode=LOAD_RAW_ONLY))
    assert (r.status, r.rows_in) == ("SKIPPED", 4)
    assert L.read_raw(spark, layout, SPEC).count() == 7
    assert [k for k, *_ in trusted(spark, layout)] == [1, 2, 3]


def test_upsert_by_modification_date_applies_only_newer_rows(spark, scratch):
    spec = TableSpec(
        "Sales.Thing.csv",
        (ColumnSpec("ThingID", "int"), ColumnSpec("Name", "string"), ColumnSpec("ModifiedDate", "date")),
        keys=("ThingID",), load_mode=LOAD_MERGE, merge_mode=MERGE_UPSERT, modified="ModifiedDate",
    )
    layout = L.LakeLayout(f"{scratch}/lake")
    head = "ThingID;Name;ModifiedDate"
    load(spark, layout, scratch, "m1.csv", [head, "1;a;2024-01-01", "2;b;2024-01-05"], "000001", T1, spec)
    # a full extract again: only id 2 (changed after 2024-01-05) and id 3 (new) apply
    r = load(spark, layout, scratch, "m2.csv", [head, "1;a;2024-01-01", "2;b2;2024-01-09", "3;c;2024-01-09"],
             "000002", T2, spec)
    assert (r.rows_in, r.rows_inserted, r.rows_updated, r.rows_deleted) == (3, 1, 1, 0)
    assert trusted(spark, layout, spec) == [
        (1, "a", dt.date(2024, 1, 1)), (2, "b2", dt.date(2024, 1, 9)), (3, "c", dt.date(2024, 1, 9))]


def test_modified_column_needs_upsert():
    with pytest.raises(ValueError, match="upsert"):
        TableSpec("t.csv", (ColumnSpec("A", "int"), ColumnSpec("M", "date")), keys=("A",),
                  load_mode=LOAD_MERGE, modified="M")


def test_missing_file_is_skipped_with_an_audit_row(spark, scratch):
    layout = L.LakeLayout(f"{scratch}/lake")
    load(spark, layout, scratch, "b1.csv", B1, "000001", T1)
    r = LD.load_file(spark, SPEC, f"{scratch}/nowhere.csv", layout, "000002", T2)
    assert r.status == "SKIPPED"
    assert len(trusted(spark, layout)) == 3
    msgs = [a["message"] for a in read_audit(spark, layout.audit).collect() if a["batch_id"] == "000002"]
    assert msgs and msgs[0].startswith("missing file")


def test_raw_and_trusted_files_are_sorted_by_key(spark, scratch):
    import glob

    import pyarrow.parquet as pq

    layout = L.LakeLayout(f"{scratch}/lake")
    ids = list(range(40, 0, -1))  # delivered in descending key order
    lines = ["ThingID;Name;Amount;Day"] + [f"{i};n{i};{i}.5;2024-09-0{1 + i % 9}" for i in ids]
    res = load(spark, layout, f"{scratch}/in", "sorted.csv", lines, "b1", T1)
    for folder, column in ((f"{layout.raw(SPEC)}/batch_id=b1/*", "thing_id"),
                           (f"{layout.trusted(SPEC)}/v={res.version}", "thing_id")):
        parts = glob.glob(f"{local(folder)}/*.parquet")
        assert parts
        for part in parts:
            keys = pq.read_table(part, columns=[column]).column(0).to_pylist()
            assert keys == sorted(keys)


def test_old_committed_versions_expire_uncommitted_stay(spark, scratch):
    import glob
    from dataclasses import replace

    spec = replace(SPEC, load_mode=LOAD_FULL, keep_versions=2)
    layout = L.LakeLayout(f"{scratch}/lake")
    stray = f"{layout.trusted(spec)}/v=in-progress"
    spark.range(1).write.parquet(stray)  # a write that has not committed (yet)
    versions = []
    for i, stamp in enumerate((T1, T2, T3, dt.datetime(2024, 9, 7, 9))):
        lines = ["ThingID;Name;Amount;Day", f"{i};n{i};1.5;2024-09-01"]
        versions.append(load(spark, layout, f"{scratch}/in", f"f{i}.csv", lines, f"b{i}", stamp, spec).version)
    left = sorted(p.rsplit("v=", 1)[1] for p in glob.glob(f"{local(layout.trusted(spec))}/v=*"))
    assert left == sorted([*versions[-2:], "in-progress"])
    assert [r["thing_id"] for r in L.read_trusted(spark, layout, spec).collect()] == [3]


def test_rerun_in_another_month_replaces_the_batch(spark, scratch):
    layout = L.LakeLayout(f"{scratch}/lake")
    load(spark, layout, scratch, "b1.csv", B1, "000001", T1)
    load(spark, layout, scratch, "b1.csv", B1, "000001", T2)  # the month after
    assert L.read_raw(spark, layout, SPEC).count() == 3


def test_older_batch_is_refused_unless_forced(spark, scratch):
    layout = L.LakeLayout(f"{scratch}/lake")
    load(spark, layout, scratch, "b1.csv", B1, "000001", T1)
    load(spark, layout, scratch, "b2.csv", B2, "000002", T2)
    before = trusted(spark, layout)
    path = f"{scratch}/b1.csv"
    for stamp in (T1, None):  # its own stamp, given or remembered
        r = LD.load_batch(spark, SPEC, read_flat_file(spark, path, SPEC), layout, "000001", stamp)
        assert r.status == "SKIPPED" and r.stamp == T1
        assert trusted(spark, layout) == before
    r = LD.load_batch(spark, SPEC, read_flat_file(spark, path, SPEC), layout, "000001", T1, force=True)
    assert r.status == "OK"
    assert [k for k, *_ in trusted(spark, layout)] == [1, 2, 3]  # the old batch alone, not mixed with the newer


def test_repeated_keys_are_counted_or_refused(spark, scratch):
    layout = L.LakeLayout(f"{scratch}/lake")
    lines = ["ThingID;Name;Amount;Day", "1;a;1;2024-01-01", "1;b;2;2024-01-02"]
    r = load(spark, layout, scratch, "k.csv", lines, "000001", T1)
    assert (r.rows_in, r.rows_inserted, r.rows_collapsed) == (2, 1, 1)
    with pytest.raises(ValueError, match="has 2 rows"):
        LD.load_batch(spark, SPEC, read_flat_file(spark, f"{scratch}/k.csv", SPEC), layout, "000002", T2, unique_keys=True)


def test_same_day_and_undated_changes_are_applied(spark, scratch):
    spec = TableSpec(
        "Sales.Thing.csv",
        (ColumnSpec("ThingID", "int"), ColumnSpec("Name", "string"), ColumnSpec("ModifiedDate", "date")),
        keys=("ThingID",), load_mode=LOAD_MERGE, merge_mode=MERGE_UPSERT, modified="ModifiedDate",
    )
    layout = L.LakeLayout(f"{scratch}/lake")
    head = "ThingID;Name;ModifiedDate"
    load(spark, layout, scratch, "m1.csv", [head, "1;a;2024-01-05"], "000001", T1, spec)
    load(spark, layout, scratch, "m2.csv", [head, "1;a2;2024-01-05", "2;b;2024-01-05", "3;c;"], "000002", T2, spec)
    assert [(k, n) for k, n, _ in trusted(spark, layout, spec)] == [(1, "a2"), (2, "b"), (3, "c")]


def test_malformed_lines_fail_or_are_set_aside(spark, scratch):
    lines = ["ThingID;Name;Amount;Day", "1;a;1;2024-01-01;EXTRA", "2;b", "3;c;3;2024-01-03"]
    path = write_csv(scratch, "bad.csv", lines)
    layout = L.LakeLayout(f"{scratch}/lake")
    with pytest.raises(Exception, match="malformed line"):
        LD.load_file(spark, SPEC, path, layout, "000001", T1)
    r = LD.load_file(spark, SPEC, path, layout, "000001", T1, quarantine=True)
    assert (r.rows_in, r.rows_inserted, r.rows_rejected) == (1, 1, 2)
    aside = L.read_quarantine(spark, layout, SPEC).collect()
    assert sorted(a["malformed_line"] for a in aside) == ["1;a;1;2024-01-01;EXTRA", "2;b"]
    path = write_csv(scratch, "bad.csv", [lines[0], "1;a;1;2024-01-01", "2;b;2;2024-01-02", lines[3]])  # corrected
    r = LD.load_file(spark, SPEC, path, layout, "000001", T1, quarantine=True)
    assert (r.rows_in, r.rows_rejected, r.status) == (3, 0, "OK")
    assert L.read_quarantine(spark, layout, SPEC).count() == 0


def test_quoted_line_break_needs_multi_line(spark, scratch):
    from dataclasses import replace

    path = write_csv(scratch, "m.csv", ["ThingID;Name;Amount;Day", '3;"line1', 'line2";3;2024-01-03'])
    with pytest.raises(Exception, match="malformed line"):
        read_flat_file(spark, path, SPEC).collect()
    rows = read_flat_file(spark, path, replace(SPEC, multi_line=True)).collect()
    assert [tuple(r) for r in rows] == [("3", "line1\nline2", "3", "2024-01-03")]


def test_two_writers_from_one_version_conflict(spark, scratch, monkeypatch):
    layout = L.LakeLayout(f"{scratch}/lake")
    load(spark, layout, scratch, "b1.csv", B1, "000001", T1)
    write_snapshot = L.write_snapshot

    def other_commits_first(df, lay, spec, version):
        path = write_snapshot(df, lay, spec, version)
        monkeypatch.setattr(L, "write_snapshot", write_snapshot)
        load(spark, layout, scratch, "b2.csv", B2, "000002", T2)
        return path

    monkeypatch.setattr(L, "write_snapshot", other_commits_first)
    with pytest.raises(L.CommitConflict):
        load(spark, layout, scratch, "b3.csv", ["ThingID;Name;Amount;Day", "9;z;1;2024-03-03"], "000003", T3)
    assert [k for k, *_ in trusted(spark, layout)] == [2, 3, 4]  # the other writer's


def test_expired_versions_are_deleted_once(spark, scratch):
    root = f"{scratch}/mart"
    for i in range(4):
        L.write_version(spark.range(1), root, f"v{i}")
        L.commit_version(spark, root, f"v{i}", str(i), None, L.commit_number(spark, root))
    assert sorted(L.expire_versions(spark, root, 2)) == ["v0", "v1"]
    assert L.expire_versions(spark, root, 2) == []


def test_whole_error_message_is_audited(spark, scratch):
    layout = L.LakeLayout(f"{scratch}/lake")
    with pytest.raises(Exception) as failure:
        load(spark, layout, scratch, "bad.csv", ["ThingID;Name;Amount;Day", "x;a;1;2024-01-01"], "000001", T1)
    messages = [a["message"] for a in read_audit(spark, layout.audit).collect() if a["status"] == "ERROR"]
    assert messages == [str(failure.value)]


def test_upsert_of_one_key_rewrites_its_bucket_only(spark, scratch):
    import glob
    from dataclasses import replace

    plain, spec = replace(SPEC, merge_mode=MERGE_UPSERT), replace(SPEC, merge_mode=MERGE_UPSERT, buckets=4)
    layout, other = L.LakeLayout(f"{scratch}/lake"), L.LakeLayout(f"{scratch}/plain")
    first = ["ThingID;Name;Amount;Day", ";nokey;1;2024-01-01"] + [f"{i};n{i};{i};2024-01-01" for i in range(40)]
    delta = ["ThingID;Name;Amount;Day", "7;changed;1;2024-01-02"]
    for name, lines, batch_id, stamp in (("f.csv", first, "000001", T1), ("d.csv", delta, "000002", T2)):
        results = [load(spark, lake, scratch, name, lines, batch_id, stamp, s) for lake, s in ((layout, spec), (other, plain))]
        assert {(r.rows_inserted, r.rows_updated, r.rows_deleted, r.null_keys, r.rows_collapsed) for r in results} == {
            (41, 0, 0, 1, 0) if name == "f.csv" else (0, 1, 0, 0, 0)}
        before, after = trusted(spark, other, plain), trusted(spark, layout, spec)
        assert sorted(before, key=repr) == sorted(after, key=repr)
    written = glob.glob(f"{local(layout.trusted(spec))}/v=000002-*/bucket=*")
    assert len(written) == 1  # the other buckets' files are those of the first load
    folders = L.bucket_folders(spark, layout, spec, L.current_version(spark, layout, spec)).values()
    assert sum("v=000001-" in f for f in folders) == len(folders) - 1
