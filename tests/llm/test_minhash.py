import random
import re

import numpy as np

from martforge.llm import minhash as M

from .conftest import rows_of, sample_rows

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain_set(text, k):
    w = WORD.findall((text or "").translate({i: i + 32 for i in range(65, 91)}))
    return {tuple(w[i:i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else {tuple(w)} - {()}


def plain_components(rows, k, percent=80):
    """doc_id, n_shingles, component_id, kept by comparing all pairs."""
    sets = [(doc_id, plain_set(text, k)) for doc_id, text in rows]
    parent = {d: d for d, _ in sets if d is not None}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, (a, s) in enumerate(sets):
        for b, t in sets[:i]:
            if None not in (a, b) and s and t and 100 * len(s & t) >= percent * len(s | t):
                x, y = sorted((find(a), find(b)))
                parent[y] = x
    out = [(d, len(s), None if d is None else find(d)) for d, s in sets]
    return sorted(((d, n, c, d == c) for d, n, c in out), key=repr)


def test_components_are_those_of_all_pairs(docs, clashing):
    rows = [(r[0], r[1]) for r in sample_rows()]
    for k in (2, 5):
        expect = plain_components(rows, k)
        assert rows_of(M.near_duplicates(docs, shingle_words=k)) == expect
    assert rows_of(M.near_duplicates(clashing, shingle_words=5)) == expect


def test_groups_of_near_copies_around_one_original(spark):
    rng, rows = random.Random(9), []
    for group in range(6):
        base = [f"g{group}w{rng.randrange(500)}" for _ in range(120)]
        for copy in range(rng.choice((2, 25))):
            own = list(base)
            for _ in range(rng.randrange(0, 7)):
                own[rng.randrange(len(own))] = f"x{rng.randrange(10 ** 6)}"
            rows.append((rng.randrange(10 ** 6), " ".join(own)))
    table = spark.createDataFrame(rows, "doc_id long, text string")
    assert rows_of(M.near_duplicates(table, shingle_words=2)) == plain_components(rows, 2)


def test_large_groups_without_an_original(spark):
    """Members are random subsets of one template: no centre resembles them all, few of them resemble each other."""
    rng, template = random.Random(12), [f"w{i}" for i in range(100)]
    rows = [(i, " ".join(w for w in template if rng.random() < 0.82)) for i in range(500)]
    expect = plain_components(rows, 1)
    assert 100 < sum(not r[3] for r in expect) < 400
    table = spark.createDataFrame(rows, "doc_id long, text string")
    assert rows_of(M.near_duplicates(table, shingle_words=1)) == expect


def test_an_id_with_two_texts_ties_their_groups(spark):
    a, b, c = (" ".join(f"{x}{i}" for i in range(30)) for x in "abc")
    rows = [(5, a), (9, a), (9, b), (7, b), (8, c)]
    got = M.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"))
    assert rows_of(got, "doc_id", "component_id") == [(5, 5), (7, 5), (8, 8), (9, 5), (9, 5)]


def test_bands_find_pairs_at_the_threshold():
    rng, n = np.random.default_rng(1), 400
    for size, extra in ((4, 1), (8, 2), (40, 10)):  # similarity 0.8
        keys = rng.integers(0, 2 ** 63, (n, size + extra)).astype(np.uint64)
        one = M.band_keys(keys[:, :size].reshape(-1), np.repeat(np.arange(n), size), n)
        two = M.band_keys(keys.reshape(-1), np.repeat(np.arange(n), size + extra), n)
        assert (one == two).any(axis=1).all()


def test_empty_bins_are_filled():
    out = M.one_permutation(np.array([3, 9, 12], np.uint64), np.array([0, 0, 2]), 3, 0, 32)
    assert (out[[0, 2]] != M._NONE).all() and (out[1] == M._NONE).all()
    assert len(set(out[2].tolist())) == 1


def test_empty_table(empty):
    assert M.near_duplicates(empty).collect() == []
