"""Line breaks inside quoted values, read in splits: against the whole-file reader, at every split size."""

import random
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from martforge.config import ColumnSpec, TableSpec
from martforge.session import session_conf
from martforge.sources import flatfile, quoted

SPEC = TableSpec("notes.csv", tuple(ColumnSpec(c, "string") for c in ("ID", "NOTE", "TAIL")), keys=("ID",), multi_line=True)


def quote(value):
    return '"' + value.replace('"', '""') + '"'


def write(folder, name, rows, end="\n", header="ID;NOTE;TAIL", last=True):
    import os

    os.makedirs(folder, exist_ok=True)
    text = end.join([header, *[";".join(r) for r in rows]]) + (end if last else "")
    with open(f"{folder}/{name}", "w", encoding="utf-8", newline="") as f:
        f.write(text)


def sample(n, seed):
    rng, out = random.Random(seed), []
    for i in range(n):
        note = "".join(rng.choice(["word ", "é;", "\n", "\n\n", 'say "so" ', ";", "-"]) for _ in range(rng.randrange(0, 12)))
        out.append((str(i), quote(note) if rng.random() < 0.8 or any(c in note for c in ';"\n') else note, rng.choice(["x", quote("a\nb"), ""])))
    return out


def splits(size):
    return {"spark.sql.files.maxPartitionBytes": str(size), "spark.sql.files.openCostInBytes": "1"}


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.mark.parametrize("size", [17, 64, 1000, 1 << 20])
@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_every_split_size_reads_the_same_records(spark, scratch, size, end):
    rows = sample(120, size)
    write(scratch, "a.csv", rows[:90], end)
    write(scratch, "b.csv", rows[90:], end, last=False)
    expected = rows_of(spark.read.options(**{**flatfile.CSV_OPTIONS, "multiLine": "true"}).csv(scratch).select(
        "ID", F.when(F.trim("NOTE") != "", F.col("NOTE")), "TAIL"))
    with session_conf(spark, splits(size)):
        lines = quoted.physical_lines(spark, scratch)
        assert size > 1000 or lines.rdd.getNumPartitions() >= 4
        found = flatfile.read_flat_file(spark, scratch, SPEC)
        got = rows_of(found.select("id", F.when(F.trim("note") != "", F.col("note")), "tail"))
    assert got == expected and len(got) == 120


@pytest.mark.parametrize("before, after", [(1000, 64), (64, 1000)])
def test_settings_that_change_before_the_rows_are_used(spark, scratch, before, after):
    """A load bounds its tasks after the file was opened: the splits stay those whose quotes were counted."""
    rows = sample(120, 7)
    write(scratch, "a.csv", rows)
    with session_conf(spark, splits(before)):
        expected = rows_of(flatfile.read_flat_file(spark, scratch, SPEC))
        found = flatfile.read_flat_file(spark, scratch, SPEC)
    with session_conf(spark, splits(after)):
        assert rows_of(found) == expected and len(expected) == 120


def test_a_file_of_several_bounded_tasks_is_loaded(spark, scratch, monkeypatch):
    """The session's own splits are larger than those of a load."""
    import datetime as dt

    from martforge import session
    from martforge.config import LOAD_FULL
    from martforge.plans.load import load_batch, load_file
    from martforge.sources import layers

    rows, spec = sample(120, 9), replace(SPEC, load_mode=LOAD_FULL)
    write(scratch, "a.csv", rows)
    monkeypatch.setitem(session.TASK_BYTES, "spark.sql.files.maxPartitionBytes", 500)
    with session_conf(spark, splits(2000)):
        text = flatfile.read_flat_file(spark, scratch, spec)
        for n, load in enumerate((lambda to: load_file(spark, spec, scratch, to, "000001", dt.datetime(2024, 9, 4)),
                                  lambda to: load_batch(spark, spec, text, to, "000001", dt.datetime(2024, 9, 4)))):
            layout = layers.LakeLayout(f"{scratch}-lake{n}")
            assert load(layout).rows_in == 120
            got = layers.read_trusted(spark, layout, spec).select("id").collect()
            assert sorted(int(r["id"]) for r in got) == list(range(120))


def test_a_record_over_many_splits_and_a_break_at_each_edge(spark, scratch):
    long = "\n" * 50 + "x" * 300 + "\n;" * 40
    write(scratch, "a.csv", [("1", quote(long), "t"), ("2", quote(""), "t"), ("3", quote("\n"), quote("\n"))])
    with session_conf(spark, splits(31)):
        got = rows_of(flatfile.read_flat_file(spark, scratch, SPEC))
    assert got == [("1", long, "t"), ("2", None, "t"), ("3", "\n", "\n")]


def test_malformed_records_are_told(spark, scratch):
    write(scratch, "a.csv", [("1", quote("a\nb"), "t"), ("2", "x", "y", "z"), ("3", quote("only\ntwo"))])
    with session_conf(spark, splits(20)):
        got = flatfile.read_flat_file(spark, scratch, SPEC, malformed=flatfile.KEEP).collect()
        assert sorted(r[flatfile.MALFORMED] or "" for r in got) == ["", "2;x;y;z", '3;"only\ntwo"']
        with pytest.raises(Exception, match="malformed line"):
            flatfile.read_flat_file(spark, scratch, SPEC).collect()


def test_open_quotes_and_other_headers_are_errors(spark, scratch):
    write(f"{scratch}/open", "a.csv", [("1", '"never closed', "t")])
    with pytest.raises(ValueError, match="not closed"):
        flatfile.read_flat_file(spark, f"{scratch}/open", SPEC)
    write(f"{scratch}/two", "a.csv", [("1", "x", "t")])
    write(f"{scratch}/two", "b.csv", [("1", "x", "t")], header="ID;TAIL;NOTE")
    with pytest.raises(Exception, match="another header"):
        flatfile.read_flat_file(spark, f"{scratch}/two", SPEC).collect()


def test_file_columns_and_a_header_alone(spark, scratch):
    write(f"{scratch}/one", "a.csv", [("1", quote("a\nb"), "t")])
    (row,) = flatfile.read_flat_file(spark, f"{scratch}/one", SPEC, with_file=True).collect()
    assert row["file_path"].endswith("a.csv") and row["file_time"] is not None
    write(f"{scratch}/none", "a.csv", [])
    assert flatfile.read_flat_file(spark, f"{scratch}/none", SPEC).collect() == []
