import collections

import pytest

from martforge.llm import mixing as M

from .conftest import rows_of, sample_rows


def plain_targets(sizes):
    """Weights 5, 2, 1 by code point, null last; excess over three times the size shared again."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    total, capped = sum(sizes.values()), set()
    while True:
        left = total - sum(3 * sizes[s] for s in capped)
        free = [s for s in names if s not in capped]
        share = {s: left * weight[s] / sum(weight[x] for x in free) for s in free}
        over = {s for s in free if share[s] > 3 * sizes[s] + 1e-9}
        if not over:
            return {s: share.get(s, 3.0 * sizes[s]) for s in names}
        capped |= over


def test_plan_meets_targets(docs, clashing):
    rows = M.mix_plan(docs).collect()
    assert len(rows) == len(sample_rows())
    size = collections.Counter()
    for r in sample_rows():
        size[r[3]] += len((r[1] or "").split())
    expect = plain_targets(dict(size))
    taken = collections.Counter()
    for r in rows:
        assert r["source_size"] == size[r["source"]]
        assert r["target"] == pytest.approx(expect[r["source"]])
        assert 0 <= r["taken"] <= 3 * r["size"]
        taken[r["source"]] += r["taken"]
    for source, target in expect.items():
        assert abs(taken[source] - target) <= 3 * M.BLOCK_TOKENS + 1, source
    plan = ["doc_id", "source", "size", "source_size", "target", "taken"]
    again = rows_of(M.mix_plan(docs.repartition(5)), *plan)
    assert rows_of(M.mix_plan(docs), *plan) == again  # the order of the input does not matter
    assert rows_of(M.mix_plan(clashing), *plan) == again


def test_small_sources_meet_their_targets(spark):
    """One large source and fifteen small ones, of less than a block to a few blocks."""
    sizes = {"a": 100_000, **{f"s{i:02d}": (10, 65, 100)[i % 3] for i in range(15)}}
    rows = [(i * 1000 + j, "w " * n, name) for i, (name, total) in enumerate(sizes.items())
            for j, n in enumerate([500] * (total // 500) or [total // 2, total - total // 2])]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    taken = collections.Counter()
    for r in M.mix_plan(docs).collect():
        assert 0 <= r["taken"] <= 3 * r["size"]
        taken[r["source"]] += r["taken"]
    for source, target in plain_targets(sizes).items():
        shards = -(-sizes[source] // M.SHARD_TOKENS)
        assert abs(taken[source] - target) <= (1 if shards == 1 else M.BLOCK_TOKENS), source
    words = collections.Counter()
    for r in M.mixed_documents(docs).collect():
        words[r["source"]] += len(r["text"].split())
    assert words == taken


def test_rows_of_a_null_id_are_spread_over_shards(spark, monkeypatch):
    monkeypatch.setattr(M, "SHARD_TOKENS", 100)
    rows = [(None, f"word{i} " * 10, "a") for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    plan = M.mix_plan(docs, max_repeats=1).collect()
    assert sum(r["taken"] for r in plan) == 4000
    assert len({(r["walk"], r["blocks"], r["room"]) for r in plan}) > 10
    assert max(r["start"] for r in plan) < 600


def test_mixed_documents_have_the_words_of_the_plan(docs, clashing):
    plan = {(r["doc_id"], r["source"], r["size"]): r["taken"] for r in M.mix_plan(docs).collect() if r["taken"]}
    for table in (docs, clashing):
        mixed = M.mixed_documents(table)
        assert mixed.columns == table.columns
        got = collections.Counter()
        originals = {(r["doc_id"], r["source"]): r["text"].split() for r in docs.collect() if r["text"]}
        copies = collections.Counter(r["doc_id"] for r in docs.collect())
        for r in mixed.collect():
            words = originals[r["doc_id"], r["source"]]
            got[r["doc_id"], r["source"], len(words)] += len(r["text"].split()) / copies[r["doc_id"]]
            assert not collections.Counter(r["text"].split()) - collections.Counter(words)
        assert got == plan


def test_apportionment_is_that_of_highest_quotients(spark):
    import random

    rng = random.Random(2)
    for n, seats in ((1, 5), (7, 100), (30, 12), (12, 1000)):
        weights = [rng.random() ** 3 * 100 + 0.01 for _ in range(n)]
        won = [0] * n
        for _ in range(seats):
            best = max(range(n), key=lambda i: (weights[i] / (2 * won[i] + 1), -i))
            won[best] += 1
        units = spark.createDataFrame([(0, i, w, seats) for i, w in enumerate(weights)] + [(0, n, 0.0, seats)],
                                      "g int, unit int, weight double, seats long")
        got = [r["quota"] for r in M.apportion(units, ["g"], "unit", "weight", "seats").orderBy("unit").collect()]
        assert got == [*won, 0]


def test_empty_table_and_texts_without_words(spark, empty):
    assert M.mix_plan(empty).collect() == []
    assert M.mixed_documents(empty).collect() == []
    blank = spark.createDataFrame([(1, "", "a"), (2, None, None)], "doc_id long, text string, source string")
    assert rows_of(M.mix_plan(blank), "doc_id", "size", "target", "taken") == [(1, 0, 0.0, 0), (2, 0, 0.0, 0)]
