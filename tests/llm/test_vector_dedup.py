import math

import numpy as np

from martforge.llm import vector_dedup as V

from .conftest import rows_of


def clustered(n=260, dim=16):
    rng = np.random.default_rng(3)
    centers = rng.standard_normal((9, dim))
    vecs = centers[rng.integers(0, 9, n)] + rng.standard_normal((n, dim)) * rng.choice([0.02, 0.2, 1.0], (n, 1))
    rows = [(int(i), [float(np.float32(x)) for x in v]) for i, v in zip(rng.permutation(1000)[:n], vecs)]
    rows += [(2000, rows[5][1]), (2001, rows[5][1]), (2002, [2 * x for x in rows[5][1]])]  # copies, and one scaled
    rows += [(3000, None), (3001, []), (3002, [0.0] * dim), (3003, [math.nan] + [1.0] * (dim - 1)),
             (3004, [math.inf] * dim), (3005, [None] + [1.0] * (dim - 1)), (3006, rows[5][1][:-1]), (None, rows[5][1])]
    return rows


def plain(rows, cosine=0.95):
    ok = {i: np.array(v) for i, v in rows
          if i is not None and v and None not in v and np.isfinite(v).all() and any(v)}
    ids = [i for i, _ in rows]
    near = {i: [] for i in ids}
    for i, a in ok.items():
        for j, b in ok.items():
            if i != j and len(a) == len(b) and a @ b / math.sqrt(a @ a) / math.sqrt(b @ b) >= cosine:
                near[i].append(j)
    out = []
    for i in ids:
        reached, stack = {i}, [i]
        while stack:
            for j in near[stack.pop()]:
                if j not in reached:
                    reached.add(j)
                    stack.append(j)
        component = None if i is None else min(reached)
        out.append((i, len(near[i]), component, i == component))
    return sorted(out, key=repr)


def test_links_and_components_are_those_of_all_pairs(spark, monkeypatch):
    rows = clustered()
    expect = plain(rows)
    assert sum(n for _, n, *_ in expect) > 500
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert rows_of(V.near_duplicate_vectors(table)) == expect
    monkeypatch.setattr(V, "TILE", 16)  # buckets of many tiles
    clash = table.selectExpr("*", "1 as node", "2 as cid", "'x' as vec", "3 as label", "4 as table")
    assert rows_of(V.near_duplicate_vectors(clash)) == expect


def test_number_of_tables_gives_the_promised_recall():
    for n in (10, 10_000, 50_000, 10 ** 9):
        bits, tables = V.plan_tables(n)
        same = (1 - math.acos(V.COSINE) / math.pi) ** bits
        assert (1 - same) ** tables <= V.MISS < (1 - same) ** (tables - 2)


def test_empty_table(spark):
    assert V.near_duplicate_vectors(spark.createDataFrame([], "vec_id long, embedding array<float>")).collect() == []
