"""NRA against scoring every document, on odd rows, small shards, ties and query blocks."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from martforge.llm import ranked_search as R

from .conftest import CLASHING, rows_of, words

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def terms(text):
    return TERM.findall((text or "").translate(UPPER))


def plain_search(docs, items, k):
    live = [(i, Counter(t)) for i, text in docs if (t := terms(text))]
    total, n_docs = sum(sum(c.values()) for _, c in live), len(live)
    df = Counter(t for _, c in live for t in c)
    wanted = {}
    for item, text in items:
        wanted.setdefault(item, set()).update(terms(text))
    out = []
    for item, own in wanted.items():
        scored = []
        for i, c in live:
            m = 10 + (90 * sum(c.values()) * n_docs) // total
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10 ** 9 * c[t] // (1000 * c[t] + 8 * m))
                        for t in own if t in c)
            if score > 0:
                scored.append((-score, i is None, i))
        out += [(item, rank, s[2], -s[0]) for rank, s in enumerate(sorted(scored)[:k], 1)]
    return sorted(out, key=repr)


@pytest.fixture(scope="module")
def items():
    rng = random.Random(11)
    rows = [(n, " ".join(words(rng, rng.randrange(1, 40)))) for n in range(25)]
    return rows + [(100, None), (101, ""), (102, "?!"), (103, "w w w"), (104, "nowhere else"), (None, "one w1"), (5, "w7, again W8"),
                   (105, "ZWÖLF boxkämpfer ÜBER über"), (106, "x y")]


@pytest.mark.parametrize("k, shard, block", [(10, 1 << 20, 1 << 19), (3, 200, 1 << 19), (10, 1, 40)])
def test_as_by_scoring_all(spark, docs, items, k, shard, block):
    asked = spark.createDataFrame(items, "item_id long, text string")
    found = R.search(docs, asked, k, query_terms=block, shard_postings=shard)
    expected = plain_search([(r["doc_id"], r["text"]) for r in docs.collect()], items, k)
    assert rows_of(found, "item_id", "rank", "doc_id", "score") == expected


def test_equal_scores_go_by_id(spark):
    docs = [(i, "same words here") for i in range(30, 0, -1)] + [(None, "same words here"), (7, "same words here"), (99, "others")]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    asked = spark.createDataFrame([(1, "same")], "item_id long, text string")
    found = rows_of(R.search(df, asked), "item_id", "rank", "doc_id", "score")
    assert found == plain_search(docs, [(1, "same")], 10)
    assert [r[2] for r in sorted(found, key=lambda r: r[1])] == [1, 2, 3, 4, 5, 6, 7, 7, 8, 9]


def test_bounds_settle_before_the_lists_end():
    """On lists that agree about the best, NRA reads less than all of them; on any lists it is exact."""
    rng = np.random.default_rng(1)
    for agree in (True, False):
        scores = np.sort(rng.pareto(1.0, 20000) * 1000).astype(np.int64)[::-1] + 1
        listed = []
        for _ in range(5):
            docs = np.arange(20000) if agree else rng.permutation(20000)
            listed.append((docs, scores))
        place, score, read = R.nra(listed, 20000, 10)
        total = np.zeros(20000, np.int64)
        for docs, impacts in listed:
            total[docs] += impacts
        kth = np.sort(total)[-10]
        assert sorted(zip(place, score)) == sorted((i, total[i]) for i in np.flatnonzero(total >= kth))
        if agree:
            assert read < 5 * 20000 / 10


def test_extra_columns_and_empty_tables(spark, docs, items, empty):
    asked = spark.createDataFrame(items, "item_id long, text string")
    extra = [*CLASHING, "n", "terms", "query", "rank", "m", "part"]
    found = R.search(docs.withColumns({x: F.lit("clash") for x in extra}), asked.withColumns({x: F.lit("clash") for x in ["doc_id", "nth", "rank"]}))
    assert rows_of(found) == rows_of(R.search(docs, asked))
    assert rows_of(R.search(empty, asked)) == []
    assert rows_of(R.search(docs, asked.limit(0))) == []
