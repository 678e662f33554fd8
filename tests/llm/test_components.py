import random

import numpy as np

from martforge.llm.components import bucket_components, connected_components, shared_buckets

from .conftest import rows_of


def plain(edges):
    parent = {x: x for e in edges for x in e if None not in e}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a is not None and b is not None:
            x, y = sorted((find(a), find(b)))
            parent[y] = x
    return sorted((x, find(x)) for x in parent if find(x) != x)


def test_components_of_chains_stars_and_random_graphs(spark):
    rng = random.Random(4)
    chain = [(i, i + 1) for i in range(0, 40)]
    star = [(100 + i, 99) for i in range(50)] + [(99, 98)]
    loose = [(rng.randrange(200, 400), rng.randrange(200, 400)) for _ in range(120)]
    for edges in (chain, star, loose, chain + star + loose + [(None, 3), (7, 7)], []):
        got = connected_components(spark.createDataFrame(edges, "a long, b long"))
        assert rows_of(got) == sorted(plain(edges), key=repr)


def test_edges_beyond_one_chunk_go_through_star_rounds(spark, monkeypatch):
    import martforge.llm.components as K

    monkeypatch.setattr(K, "CHUNK_EDGES", 10)  # what the driver compares with; workers keep their own
    rng = random.Random(11)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(180)] + [(400 + i, 399 + i) for i in range(60)]
    table = spark.createDataFrame(edges, "a long, b long").repartition(7)
    assert rows_of(K.connected_components(table)) == sorted(plain(edges), key=repr)


def test_ids_may_be_strings(spark):
    edges = [("b", "a"), ("é", "b"), ("z", "y"), (None, "a")]
    got = connected_components(spark.createDataFrame(edges, "a string, b string"))
    assert rows_of(got) == [("b", "a"), ("z", "y"), ("é", "a")]


def test_a_chunk_of_edges_becomes_stars():
    import pyarrow as pa

    from martforge.llm.components import _chunk_forest

    rng = random.Random(3)
    for n, m in ((50, 30), (200, 260), (400, 300)):
        edges = [(rng.randrange(n), rng.randrange(n)) for _ in range(m)] + [(n + i, n + i + 1) for i in range(99)]
        below, root = _chunk_forest(*(pa.chunked_array([[e[k] for e in edges]]) for k in (0, 1)))
        assert sorted(zip(below.tolist(), root.tolist()), key=repr) == sorted(plain(edges), key=repr)


def test_bucket_search_finds_links_that_its_first_star_misses(spark):
    # 0-1, 2-3 and 4-5 are linked; all share one large bucket with unlinked members
    linked = {(0, 1), (2, 3), (4, 5)}
    members = [(7, i) for i in range(14)] + [(8, 20), (8, 21), (9, 22)]
    links = spark.createDataFrame(sorted(linked | {(20, 21)}), "a long, b long")
    got = bucket_components(shared_buckets(spark.createDataFrame(members, "bucket long, node long")),
                            lambda pairs: pairs.join(links, ["a", "b"], "left_semi"))
    assert rows_of(got) == [(1, 0), (21, 20), (3, 2), (5, 4)]


def test_large_buckets_are_searched_in_full(spark, monkeypatch):
    """Several hundred members without a hub, in one bucket: all pairs, by either route."""
    import martforge.llm.components as K

    monkeypatch.setattr(K, "TILE", 32)
    rng, n = random.Random(7), 300
    linked = {tuple(sorted(rng.sample(range(n), 2))) for _ in range(110)}
    links = spark.createDataFrame(sorted(linked), "a long, b long")
    members = spark.createDataFrame([(1, i) for i in range(n)], "bucket long, node long")
    values = spark.createDataFrame([(i, i) for i in range(n)], "node long, value long")

    def prepare(column):
        own = column.to_pylist()
        return lambda i, others: np.array([tuple(sorted((own[i], own[j]))) in linked for j in others.tolist()], bool)

    def verify(pairs):
        return pairs.join(links, ["a", "b"], "left_semi")

    expect = sorted(plain(sorted(linked)), key=repr)
    assert rows_of(bucket_components(shared_buckets(members), verify)) == expect
    assert rows_of(bucket_components(shared_buckets(members), verify, values=values, prepare=prepare)) == expect


def test_members_of_a_bucket_are_copied_to_few_units(spark):
    """Each copy of a member carries its text through a shuffle: 1,000 members outside the largest component need a unit or two."""
    from martforge.llm.components import _tile_units

    rows = [(1, i, max(i, 100)) for i in range(1000)]  # the members 0 to 100 are one component
    units = _tile_units(spark.createDataFrame(rows, "bucket long, node long, component long"))
    assert units.select("node").distinct().count() == 1000
    assert units.count() <= 2 * len(rows)


def test_a_unit_finds_links_beyond_its_first_chunks(spark):
    import pyarrow as pa

    from martforge.llm.components import _unit_edges

    rng, n = random.Random(9), 400
    linked = {tuple(sorted(rng.sample(range(n), 2))) for _ in range(250)}

    def prepare(column):
        return lambda i, others: np.array([tuple(sorted((i, j))) in linked for j in others.tolist()], bool)

    tiles = pa.array([0] * n, pa.int32())
    group = pa.table({"bucket": pa.array([1] * n), "node": pa.array(range(n)), "component": pa.array(range(n)),
                      "tile": tiles, "low": tiles, "high": tiles, "value": pa.array(range(n))})
    edges = _unit_edges(group, prepare)
    assert set(edges) <= linked and len(edges) < n
    assert plain(edges) == plain(sorted(linked))
