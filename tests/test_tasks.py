"""Loads and mart refreshes run in small tasks, whatever the table's size; the caller's settings come back."""

import datetime as dt
import glob
import io
from concurrent.futures import ThreadPoolExecutor
from contextlib import redirect_stdout
from dataclasses import replace
from threading import Barrier

from martforge import session
from martforge.config import LOAD_FULL
from martforge.plans import standins as S
from martforge.plans.load import load_batch
from martforge.plans.refresh import read_mart, refresh_marts
from martforge.sources import layers as L
from martforge.sources.flatfile import read_flat_file

from .conftest import SMALL_SF
from .test_pipeline import SPEC, local, trusted, write_csv

TINY = {"spark.sql.adaptive.coalescePartitions.minPartitionSize": "1k"}
SPLIT, ADVISORY = "spark.sql.files.maxPartitionBytes", "spark.sql.adaptive.advisoryPartitionSizeInBytes"


def small_tasks(monkeypatch):
    monkeypatch.setitem(session.TASK_BYTES, SPLIT, 4096)
    monkeypatch.setitem(session.TASK_BYTES, ADVISORY, 4096)
    monkeypatch.setattr(session, "PARTITION_FILE_BYTES", 2048)


def test_sizes():
    assert [session.byte_size(x) for x in ("16m", "64MB", "134217728b", "7", "1k")] == [16 << 20, 64 << 20, 128 << 20, 7, 1024]


def test_scopes_side_by_side_restore_the_callers_values(spark):
    before = {key: spark.conf.get(key) for key in (*session.TASK_BYTES, session.SHUFFLE_PARTITIONS)}
    first, second = Barrier(2, timeout=60), Barrier(2, timeout=60)

    def scope(ends_first):
        with session.bounded_tasks(spark):
            first.wait()
            session.shuffle_partitions_for(spark, 100 * session.PARTITION_FILE_BYTES)
            if not ends_first:
                second.wait()
                assert session.byte_size(spark.conf.get(SPLIT)) == session.TASK_BYTES[SPLIT]
                assert spark.conf.get(session.SHUFFLE_PARTITIONS) == "100"
        if ends_first:
            second.wait()

    with ThreadPoolExecutor(2) as pool:
        for job in [pool.submit(scope, x) for x in (True, False)]:
            job.result()
    assert {key: spark.conf.get(key) for key in before} == before


def test_smaller_values_of_the_caller_stay(spark):
    with session.session_conf(spark, {SPLIT: "1m"}), session.bounded_tasks(spark):
        assert spark.conf.get(SPLIT) == "1m"
    assert not session._scopes[spark]["open"]


def test_a_load_sorts_small_parts_of_the_file(spark, scratch, monkeypatch):
    small_tasks(monkeypatch)
    layout, spec = L.LakeLayout(f"{scratch}/lake"), replace(SPEC, load_mode=LOAD_FULL)
    lines = [f"{i * 7919 % 3000};name {i};{i},5;2024-01-02" for i in range(3000)]
    path = write_csv(scratch, "large.csv", ["ThingID;Name;Amount;Day", *lines])
    with session.session_conf(spark, TINY):
        res = load_batch(spark, spec, read_flat_file(spark, path, spec), layout, "b1", dt.datetime(2024, 8, 31, 21))
    assert res.rows_in == 3000 and len(trusted(spark, layout, spec)) == 3000
    assert len(glob.glob(f"{local(layout.raw(spec))}/batch_id=b1/*/*.parquet")) > 10
    assert len(glob.glob(f"{local(layout.trusted(spec))}/v={res.version}/*.parquet")) > 4  # the test session's shuffle partitions


def test_the_raw_write_sorts_by_the_keys_alone(spark, scratch, monkeypatch):
    """By the month first, every comparison of a batch's sort would begin with equal values."""
    layout, spec = L.LakeLayout(f"{scratch}/lake"), replace(SPEC, load_mode=LOAD_FULL)
    lines = [f"{i * 7919 % 300};name {i};{i},5;2024-01-02" for i in range(300)]
    path = write_csv(scratch, "large.csv", ["ThingID;Name;Amount;Day", *lines])
    before = {key: spark.conf.get(key, None) for key in session.OPEN_FILES}
    land = L.stamp_land(read_flat_file(spark, path, spec), dt.datetime(2024, 8, 31, 21), with_files=True)
    sorts, sort = [], type(land).sortWithinPartitions

    def seen(df, *keys):
        sorts.append((keys, {key: spark.conf.get(key, None) for key in session.OPEN_FILES}))
        return sort(df, *keys)

    monkeypatch.setattr(type(land), "sortWithinPartitions", seen)
    mark = L.append_raw(land, layout, spec, "b1")
    assert mark["rows_in"] == 300 and sorts == [(tuple(spec.keys), session.OPEN_FILES)]
    assert {key: spark.conf.get(key, None) for key in session.OPEN_FILES} == before
    files = glob.glob(f"{local(layout.raw(spec))}/batch_id=b1/partition_month=2024-08/*.parquet")
    found = [spark.read.parquet(f"file://{f}").select(*spec.keys).collect() for f in files]
    assert sum(map(len, found)) == 300 and all(rows == sorted(rows) for rows in found)


def test_a_refresh_joins_in_small_parts(spark, scratch, monkeypatch):
    small_tasks(monkeypatch)
    layout, specs = L.LakeLayout(f"{scratch}/lake"), S.star_specs()
    for role, name, _ in S.STAR_TABLES:
        text = S.render_text(S.table(spark, SMALL_SF, name), specs[role])
        path = S.write_batch_file(spark, text, specs[role], f"{name}.csv")
        load_batch(spark, specs[role], read_flat_file(spark, path, specs[role]), layout, "b1", S.BATCH1_TIME)
    with session.session_conf(spark, {**TINY, "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1", "spark.sql.autoBroadcastJoinThreshold": "-1"}):
        versions = refresh_marts(spark, layout, S.TEST_STAR, specs, prepare={"header": S.add_due_date})
    lines = S.table(spark, SMALL_SF, "lineitem").count()
    for name in ("pedidos", "tempo"):
        assert read_mart(spark, layout, name).count() == lines
        assert len(glob.glob(f"{local(layout.refined(name))}/v={versions[name]}/*.parquet")) > 4, name


def test_the_hash_that_parts_a_hot_key_is_not_shuffled(spark):
    rows = spark.range(100).selectExpr("id as k", "cast(id as string) as v")
    with redirect_stdout(io.StringIO()) as out:
        dealt = L.cluster_by_range(rows, ("k",))
        dealt.explain("formatted")
    exchange = out.getvalue().split("Exchange\n", 1)[1].split("\n\n")[0]
    assert dealt.columns == ["k", "v"] and "Input [2]" in exchange, exchange
