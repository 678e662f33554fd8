"""Merkle manifest of a dataset: hash trees built by butterfly exchange between partitions.

Rows of one group (``group_col``) are the leaves of one tree, in the order of
their ids; ``fanout`` consecutive nodes make a parent, the last run of a level
may be shorter, and a level of one node is the root. The roots of the groups,
in the order of the groups, are the leaves of one more tree, whose root stands
for the dataset. A digest is the lowercase hex sha256 of the children's
digests, one after the other.

Leaves get their place by a range sort and prefix sums over its partitions, so
no task holds a group. ``fanout ** BLOCK_LEVELS`` consecutive leaves make a
block, which one task hashes up to the block's root. Blocks then exchange their
roots as a butterfly: in round r the blocks below sibling nodes of level r
swap the digests of those nodes, partner with partner, and every block hashes
the parent for itself. After log(blocks) rounds each block holds the group's
root and, from what it received, the upper part of the proof of its leaves; no
pass leads down the tree. Where the last node of a level stands over fewer
blocks than its siblings, its blocks serve several partners each.

Defined results: null ids come first, rows that share an id are in the order of
their digests; null is a group of its own, before the others; extra columns
have no part in it; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .shared import arrow_map, written
from .text import lists

FANOUT = 2
BLOCK_LEVELS = 12  # levels that one task hashes: 4,096 leaves at a fanout of 2
_SEQ_BITS = 33  # monotonically_increasing_id: partition number above, row number below
_PATH = "array<struct<left: string, right: string>>"


def leaf_digest(*values: Column) -> Column:
    """H of a row's values: ``-`` for null, else the UTF-8 length, ``:`` and the value (as text)."""
    texts = [v.cast("string") for v in values]
    return F.sha2(F.concat(*[F.when(t.isNull(), "-").otherwise(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t))
                             for t in texts]), 256)


def _digest(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def _places(leaves: DataFrame) -> DataFrame:
    """grp, leaf and item of every row, with its place ``nth`` in its group and the group's size ``n``."""
    order = ["grp", "id", "leaf", "salt"]  # the salt parts rows that are equal in all else
    # the table is written first: a range sort reads its input twice
    salted = written(leaves.withColumn("salt", F.monotonically_increasing_id()), "leaves")
    placed = salted.repartitionByRange(*order).sortWithinPartitions(*order)
    placed = written(placed.select("grp", "leaf", "item", F.spark_partition_id().alias("pid"),
                                   F.monotonically_increasing_id().bitwiseAND((1 << _SEQ_BITS) - 1).alias("seq")), "sorted_leaves")
    runs = placed.groupBy("grp", "pid").agg(F.min("seq").alias("first"), F.count(F.lit(1)).alias("m"))
    group = Window.partitionBy("grp")  # a row per sort partition
    before = F.coalesce(F.sum("m").over(group.orderBy("pid").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    runs = written(runs.select(F.col("grp").alias("g"), F.col("pid").alias("p"), (before - F.col("first")).alias("shift"),
                               F.sum("m").over(group).alias("n")), "runs")
    return placed.join(runs, (F.col("pid") == F.col("p")) & F.col("grp").eqNullSafe(F.col("g"))).select(
        "grp", "leaf", "item", (F.col("seq") + F.col("shift")).alias("nth"), "n")


def _height(n: int, fanout: int) -> int:
    levels = 0
    while n > 1:
        n, levels = -(-n // fanout), levels + 1
    return levels


def _levels(leaves: list[str], fanout: int, height: int) -> list[list[str]]:
    out = [leaves]
    for _ in range(height):
        below = out[-1]
        out.append([_digest("".join(below[i: i + fanout])) for i in range(0, len(below), fanout)])
    return out


def _block_height(n: int, fanout: int, block_levels: int) -> int:
    return min(block_levels, _height(n, fanout))


def _block_roots(fanout: int, block_levels: int):
    def run(batches):
        for batch in batches:
            roots = [_levels([x["leaf"] for x in rows], fanout, _block_height(n, fanout, block_levels))[-1][0]
                     for rows, n in zip(batch.column("rows").to_pylist(), batch.column("n").to_pylist())]
            yield pa.RecordBatch.from_arrays([batch.column("grp"), batch.column("block"), batch.column("n"),
                                              pa.array(roots, pa.string())], names=["grp", "block", "n", "root"])
    return run


def _receivers(fanout: int, width: int) -> Column:
    """The blocks that a block sends its node's digest to; a node of this round stands over ``width`` blocks."""
    node, last = F.col("node"), F.floor((F.col("n_blocks") - 1) / width).cast("long")
    first = F.floor(node / fanout).cast("long") * fanout
    own = F.least(F.lit(width), F.col("n_blocks") - node * width)  # blocks below the own node

    def partners(sibling: Column) -> Column:
        start = sibling * width + (F.col("block") - node * width)
        stop = F.least((sibling + 1) * width, F.col("n_blocks"))
        return F.when((sibling == node) | (start >= stop), F.expr("cast(array() as array<bigint>)")).otherwise(
            F.sequence(start, F.greatest(start, stop - 1), own))

    return F.flatten(F.transform(F.sequence(first, F.least(first + fanout - 1, last)), partners))


def _exchange(state: DataFrame, fanout: int, width: int) -> DataFrame:
    """One round: siblings' digests are swapped, every block hashes the parent and notes the siblings."""
    state = state.withColumn("node", F.floor(F.col("block") / width).cast("long"))
    own = F.struct("n", "n_blocks", "node", "root", "path")
    said = F.struct("node", "root")
    sent = state.filter(F.col("n_blocks") > width).select(
        "grp", F.explode(_receivers(fanout, width)).alias("block"), F.lit(None).cast(state.select(own.alias("o")).schema["o"].dataType).alias("own"),
        said.alias("said"))
    kept = state.select("grp", "block", own.alias("own"), F.lit(None).cast(sent.schema["said"].dataType).alias("said"))
    met = kept.union(sent).groupBy("grp", "block").agg(  # a block's own row and at most fanout - 1 digests
        F.max("own").alias("own"), F.sort_array(F.collect_list("said")).alias("said"))

    def joined(side) -> Column:
        return F.array_join(F.transform(F.filter("said", side), lambda x: x["root"]), "")

    node = F.col("own.node")
    met = met.select("grp", "block", "own.n", "own.n_blocks", "own.root", "own.path",
                     joined(lambda x: x["node"] < node).alias("left"), joined(lambda x: x["node"] > node).alias("right"))
    busy = F.col("n_blocks") > width  # the smaller groups are done
    return met.select(
        "grp", "block", "n", "n_blocks",
        F.when(busy, F.sha2(F.concat("left", "root", "right"), 256)).otherwise(F.col("root")).alias("root"),
        F.when(busy, F.concat("path", F.array(F.struct("left", "right")))).otherwise(F.col("path")).alias("path"))


def _around(nodes: list[str], fanout: int) -> tuple[list[str], list[str]]:
    """The siblings before and after each node of a level, as one text each."""
    runs = [nodes[i - i % fanout: i - i % fanout + fanout] for i in range(len(nodes))]
    return (["".join(run[: i % fanout]) for i, run in enumerate(runs)],
            ["".join(run[i % fanout + 1:]) for i, run in enumerate(runs)])


def _paths(fanout: int, block_levels: int, names: list[str]):
    """A block's leaves with their whole paths: their own levels', then the block's."""
    def run(batches):
        for batch in batches:
            for k in range(batch.num_rows):
                row = batch.slice(k, 1)
                rows = row.column("rows").flatten()
                leaves, n = rows.field("leaf"), row.column("n")[0].as_py()
                height = _block_height(n, fanout, block_levels)
                upper, count = row.column("path").flatten(), len(leaves)
                place, sides = np.arange(count), ([], [])
                for level in _levels(leaves.to_pylist(), fanout, height)[:height]:
                    for out, texts in zip(sides, _around(level, fanout)):
                        out.append(pa.array(texts, pa.string()).take(pa.array(place)))
                    place = place // fanout
                zeros = pa.array(np.zeros(count, np.int64))
                for out, name in zip(sides, ("left", "right")):
                    out.extend(upper.field(name).slice(j, 1).take(zeros) for j in range(len(upper)))
                steps = len(sides[0])
                by_row = pa.array(np.arange(steps * count).reshape(steps, count).T.reshape(-1))
                both = [pa.concat_arrays(out).take(by_row) if steps else pa.array([], pa.string()) for out in sides]
                path = lists(pa.StructArray.from_arrays(both, ["left", "right"]), np.full(count, steps))
                rest = [row.column(x).take(zeros) for x in names]
                yield pa.RecordBatch.from_arrays([rows.field("item"), leaves, path, *rest],
                                                 names=["item", "leaf", "path", *names])
    return run


def _blocks(leaves: DataFrame, fanout: int, block_levels: int) -> tuple[DataFrame, DataFrame]:
    """The blocks with their rows, and (grp, block, root, path) after all rounds of exchange."""
    size = fanout ** block_levels
    placed = _places(leaves).withColumn("block", F.floor(F.col("nth") / size).cast("long"))
    blocks = written(placed.groupBy("grp", "block").agg(
        F.max("n").alias("n"), F.sort_array(F.collect_list(F.struct("nth", "leaf", "item"))).alias("rows")), "blocks")
    kind = dict(blocks.dtypes)["grp"]
    state = arrow_map(blocks, _block_roots(fanout, block_levels), f"grp {kind}, block long, n long, root string")
    state = written(state.select("grp", "block", "n", F.ceil(F.col("n") / size).cast("long").alias("n_blocks"), "root",
                                 F.expr(f"cast(array() as {_PATH})").alias("path")), "block_roots")
    most, width = state.agg(F.max("n_blocks")).first()[0] or 0, 1
    while width < most:
        state, width = written(_exchange(state, fanout, width), "exchanged"), width * fanout
    return blocks, state


def _tree(leaves: DataFrame, next_level: Callable[[DataFrame], DataFrame] | None, fanout: int, block_levels: int) -> tuple[DataFrame, DataFrame]:
    """(item, leaf, path, ...) of every leaf and (grp, root) of every group.

    ``next_level`` makes the leaves of the tree above out of the groups' roots;
    the paths there are added to the blocks, which are few, not to the leaves.
    """
    blocks, state = _blocks(leaves, fanout, block_levels)
    roots = state.filter("block = 0").select("grp", "root")
    names = ["root"]
    if next_level is not None:
        above, _ = _tree(next_level(roots), None, fanout, block_levels)
        above = written(above.select(F.col("item").alias("g"), F.col("path").alias("above"), F.col("root").alias("top")), "above")
        state = state.join(above, F.col("grp").eqNullSafe(F.col("g"))).select(
            "grp", "block", "n_blocks", "root", F.concat("path", "above").alias("path"), "top")
        names.append("top")
    upper = state.select(F.col("grp").alias("g"), F.col("block").alias("b"), "path", *names)
    both = blocks.join(upper, F.col("grp").eqNullSafe(F.col("g")) & (F.col("block") == F.col("b"))).select(
        "n", "rows", "path", *names)
    item = blocks.schema["rows"].dataType.elementType["item"].dataType.simpleString()
    schema = f"item {item}, leaf string, path {_PATH}, " + ", ".join(f"{x} string" for x in names)
    return arrow_map(both, _paths(fanout, block_levels, names), schema), roots


def manifest(docs: DataFrame, leaf: Column, changed: Column | None = None, id_col: str = "doc_id", group_col: str = "lang",
             fanout: int = FANOUT, block_levels: int = BLOCK_LEVELS) -> DataFrame:
    """One row per row: id, leaf, changed, path, subroot and root.

    ``path`` has, level by level up to the root of the dataset, the siblings'
    digests before (left) and after (right) the node. ``changed`` is the digest
    that a check finds instead of ``leaf`` (the same, if not given).
    """
    rows = docs.select(F.col(group_col).alias("grp"), F.col(id_col).alias("id"), leaf.alias("leaf"),
                       (leaf if changed is None else changed).alias("changed"))
    rows = rows.select("grp", "id", "leaf", F.struct("id", "changed").alias("item"))

    def groups(roots: DataFrame) -> DataFrame:
        return roots.select(F.lit(0).alias("grp"), F.col("grp").alias("id"), F.col("root").alias("leaf"), F.col("grp").alias("item"))

    found, _ = _tree(rows, groups, fanout, block_levels)
    return found.select("item.id", "leaf", "item.changed", "path", F.col("root").alias("subroot"), F.col("top").alias("root"))


def fold(leaf: Column, path: Column) -> Column:
    """The root that a leaf and its path give."""
    return F.aggregate(path, leaf, lambda node, step: F.sha2(F.concat(step["left"], node, step["right"]), 256))


def proof_digest(path: Column) -> Column:
    """H of the path's digests, in order."""
    return F.sha2(F.array_join(F.transform(path, lambda step: F.concat(step["left"], step["right"])), ""), 256)


def verified(found: DataFrame) -> DataFrame:
    """``manifest``'s rows with proof_sha256, folded_root (from ``changed``) and verified."""
    out = found.withColumn("folded_root", fold(F.col("changed"), F.col("path")))
    return out.select("id", "leaf", "subroot", "root", proof_digest(F.col("path")).alias("proof_sha256"), "folded_root",
                      (F.col("folded_root") == F.col("root")).alias("verified"))
