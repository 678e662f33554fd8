"""Byte copies by the executors: prefix rewrite, re-runs, half copies, changed files, odd names."""

import datetime as dt
import os
import zlib

from pyspark.sql import functions as F

from martforge.sources import files


def put(folder, name, data):
    path = f"{folder}/{name}"
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "wb") as f:
        f.write(data)


def tree(folder):
    return {os.path.relpath(f"{d}/{n}", folder): open(f"{d}/{n}", "rb").read() for d, _, names in os.walk(folder) for n in names
            if not n.endswith(".crc")}


SOURCE = {"land/a.csv": b"a;b\n1;2\n", "land/deep/b c.bin": bytes(range(256)) * 50000, "other/land/d%20é.csv": b"x"}
DAY = files.dated_folder(files.ORIGINAL, dt.date(2024, 9, 5))
# the first occurrence of the prefix is replaced, wherever it stands
TARGET = {n.replace("land/", f"{DAY}/", 1): data for n, data in SOURCE.items()}


def run(spark, root, run_id):
    done = files.copy_new_files(spark, f"{root}/source", f"{root}/target", f"{root}/ledger", run_id, source_prefix="land/",
                                target_prefix=f"{DAY}/")
    return {r["file_name"]: r for r in done.collect()}


def fill(root):
    for name, data in SOURCE.items():
        put(f"{root}/source", name, data)


def test_dated_folder():
    assert DAY == "original/2024/09/05"


def test_bytes_names_and_crc(spark, scratch):
    fill(scratch)
    done = run(spark, scratch, "r1")
    assert tree(f"{scratch}/target") == TARGET
    assert {n: (r["length"], r["crc32"], r["status"]) for n, r in done.items()} == {
        n: (len(d), zlib.crc32(d), files.COPIED) for n, d in SOURCE.items()}


def test_a_second_run_copies_nothing_but_what_is_new_or_changed(spark, scratch):
    fill(scratch)
    run(spark, scratch, "r1")
    before = {n: os.stat(f"{scratch}/target/{n}").st_mtime_ns for n in TARGET}
    assert run(spark, scratch, "r2") == {}
    assert before == {n: os.stat(f"{scratch}/target/{n}").st_mtime_ns for n in TARGET}
    put(f"{scratch}/source", "land/a.csv", b"longer than before\n")
    put(f"{scratch}/source", "land/new.csv", b"new")
    assert set(run(spark, scratch, "r3")) == {"land/a.csv", "land/new.csv"}
    assert tree(f"{scratch}/target") == {**TARGET, f"{DAY}/a.csv": b"longer than before\n", f"{DAY}/new.csv": b"new"}
    noted = files.read_copied(spark, f"{scratch}/ledger").groupBy("run_id").agg(F.count(F.lit(1)).alias("n"))
    assert {r["run_id"]: r["n"] for r in noted.collect()} == {"r1": 3, "r3": 2}


def test_half_copied_and_lost_files_are_replaced(spark, scratch):
    fill(scratch)
    big = f"{DAY}/deep/b c.bin"
    put(f"{scratch}/target", big, TARGET[big][:1000])  # a copy that broke off under the final name
    assert set(run(spark, scratch, "r1")) == set(SOURCE)
    assert tree(f"{scratch}/target") == TARGET
    put(f"{scratch}/target", big, TARGET[big][:1000])
    os.replace(f"{scratch}/target/{DAY}/a.csv", f"{scratch}/gone")
    assert set(run(spark, scratch, "r2")) == {"land/deep/b c.bin", "land/a.csv"}
    assert tree(f"{scratch}/target") == TARGET


def test_a_run_that_ended_before_its_ledger_is_started_again(spark, scratch):
    fill(scratch)
    same, other = f"{DAY}/a.csv", f"{DAY}/deep/b c.bin"
    put(f"{scratch}/target", same, TARGET[same])  # whole, but not noted
    put(f"{scratch}/target", other, bytes(len(TARGET[other])))  # of the same size, with other bytes
    done = run(spark, scratch, "r1")
    assert done["land/a.csv"]["status"] == files.KEPT and done["land/deep/b c.bin"]["status"] == files.COPIED
    assert tree(f"{scratch}/target") == TARGET
    assert set(run(spark, scratch, "r1")) == set(SOURCE)  # the same run again: its rows are written anew, its files kept
    assert tree(f"{scratch}/target") == TARGET


def test_files_in_work_are_not_listed(spark, scratch):
    fill(scratch)
    put(f"{scratch}/source", "land/_copying-1-x.csv", b"half")
    put(f"{scratch}/source", "land/empty.csv", b"")  # nor are files without a byte
    assert set(run(spark, scratch, "r1")) == set(SOURCE)
