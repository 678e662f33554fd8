"""The trees against a plain recount, the exchange against all shapes of trees, odd rows, and what a proof is worth."""

import hashlib

import pytest
from pyspark.sql import functions as F

from martforge.llm import merkle

from .conftest import rows_of


def h(text):
    return hashlib.sha256(text.encode()).hexdigest()


def plain_tree(leaves, fanout):
    """The root, and for each leaf the siblings' digests before and after it, level by level."""
    levels = [leaves]
    while len(levels[-1]) > 1:
        below = levels[-1]
        levels.append([h("".join(below[i: i + fanout])) for i in range(0, len(below), fanout)])
    paths = []
    for i in range(len(leaves)):
        path = []
        for level in levels[:-1]:
            run = i - i % fanout
            path.append(("".join(level[run:i]), "".join(level[i + 1: run + fanout])))
            i //= fanout
        paths.append(path)
    return levels[-1][0], paths


def plain_manifest(rows, fanout):
    """(id, leaf) -> path, subroot, root; rows are (group, id, leaf)."""
    groups = {}
    for g, i, leaf in sorted(rows, key=lambda r: (r[0] is not None, (r[0] or "").encode(), r[1] is not None, r[1] or 0, r[2])):
        groups.setdefault(g, []).append((i, leaf))
    trees = {g: plain_tree([leaf for _, leaf in own], fanout) for g, own in groups.items()}
    root, above = plain_tree([t[0] for t in trees.values()], fanout)
    out = []
    for (g, own), upper in zip(groups.items(), above):
        subroot, paths = trees[g]
        out += [(i, leaf, path + upper, subroot, root) for (i, leaf), path in zip(own, paths)]
    return sorted(out, key=repr)


def found_rows(df):
    return sorted(((r["id"], r["leaf"], [tuple(p) for p in r["path"]], r["subroot"], r["root"]) for r in df.collect()), key=repr)


@pytest.mark.parametrize("fanout, block_levels", [(2, 1), (2, 2), (3, 1), (4, 12)])
def test_all_shapes_of_trees(spark, fanout, block_levels):
    """Groups of 1 to 23 leaves: whole and partial blocks, one to five rounds."""
    rows = [(f"g{n}", i, h(f"{n} {i}")) for n in (1, 2, 3, 4, 5, 7, 8, 9, 13, 16, 17, 23) for i in range(n)]
    rows += [(None, 5, h("x")), (None, None, h("y")), ("g3", 1, h("twice")), ("g3", 1, h("twice"))]
    df = spark.createDataFrame(rows, "lang string, doc_id long, h string").repartition(5)
    found = merkle.manifest(df, F.col("h"), fanout=fanout, block_levels=block_levels)
    assert found_rows(found) == plain_manifest(rows, fanout)


def test_large_group_over_many_partitions(spark):
    """One group of 3,000 leaves in blocks of 16: 188 blocks, the last of them partial."""
    df = spark.range(3000).select(F.col("id").alias("doc_id"), F.lit("en").alias("lang"),
                                  F.sha2(F.col("id").cast("string"), 256).alias("h")).repartition(7)
    found = merkle.manifest(df, F.col("h"), block_levels=4)
    root, paths = plain_tree([h(str(i)) for i in range(3000)], 2)
    assert found_rows(found) == sorted(((i, h(str(i)), paths[i], root, root) for i in range(3000)), key=repr)


def plain_leaf(*values):
    return h("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def test_leaves_and_odd_rows(spark, docs, clashing):
    columns = ["doc_id", "source", "lang", "n_chars", "text"]
    leaf = merkle.leaf_digest(*[F.col(c) for c in columns])
    rows = [(r["lang"], r["doc_id"], plain_leaf(*[r[c] for c in columns])) for r in docs.collect()]
    expected = plain_manifest(rows, 2)
    assert found_rows(merkle.manifest(docs, leaf)) == expected
    assert found_rows(merkle.manifest(clashing, leaf)) == expected


def test_changed_leaves_do_not_verify(spark):
    df = spark.range(40).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, "a").otherwise("b").alias("lang"),
                                F.sha2(F.col("id").cast("string"), 256).alias("h"))
    changed = F.when(F.col("doc_id") % 5 == 0, F.sha2(F.lit("other"), 256)).otherwise(F.col("h"))
    found = merkle.verified(merkle.manifest(df, F.col("h"), changed)).collect()
    assert all(r["verified"] == (r["id"] % 5 != 0) == (r["folded_root"] == r["root"]) for r in found) and len(found) == 40


def test_proof_is_the_digest_of_the_siblings(spark):
    df = spark.createDataFrame([(i, "en", h(str(i))) for i in range(5)], "doc_id long, lang string, h string")
    _, paths = plain_tree([h(str(i)) for i in range(5)], 2)
    found = {r["id"]: r["proof_sha256"] for r in merkle.verified(merkle.manifest(df, F.col("h"))).collect()}
    assert found == {i: h("".join(a + b for a, b in path)) for i, path in enumerate(paths)}


def test_one_row_and_empty(spark, empty):
    one = spark.createDataFrame([(1, "en", h("a"))], "doc_id long, lang string, h string")
    (row,) = merkle.verified(merkle.manifest(one, F.col("h"))).collect()
    assert row["leaf"] == row["subroot"] == row["root"] == row["folded_root"] and row["proof_sha256"] == h("")
    assert rows_of(merkle.verified(merkle.manifest(empty, merkle.leaf_digest(F.col("doc_id"))))) == []
