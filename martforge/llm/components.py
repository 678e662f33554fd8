"""Connected components and star-shaped candidate edges, as Spark joins and aggregates.

Ids may be of any type that Spark orders. A node with very many neighbours is
no obstacle: minima are combined before the shuffle, and the joins are plain
sort-merge joins whose hot partitions Spark splits.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import BLOOM, arrow_map, settings, written

SMALL_BUCKET = 16  # split buckets of up to so many members are compared in full in the second round
TILE = 1024  # members of a larger split bucket that are compared with as many others as one unit of work; a unit holds two tiles
STAR_TURNS = 2  # turns of other centres before the rest is compared in tiles
CHUNK_EDGES = 1 << 18  # edges that a task contracts at a time
_CHUNK = 16  # pairs of one member compared before those joined meanwhile are left out; twice as many after a chunk without a link


def _is_forest_of_stars(edges: DataFrame) -> bool:
    """Whether every v has one u, and no u is a v."""
    ends = edges.select(F.col("v").alias("x"), F.lit(1).alias("below"), F.lit(0).alias("above")).union(
        edges.select("u", F.lit(0), F.lit(1)))
    of_node = ends.groupBy("x").agg(F.sum("below").alias("below"), F.max("above").alias("above"))
    return of_node.filter("below + above > 1").isEmpty()


def _chunk_forest(a: pa.ChunkedArray, b: pa.ChunkedArray) -> list[np.ndarray]:
    """The edges of one chunk as stars: every node with the smallest node that the chunk's edges reach."""
    nodes, place = np.unique(np.concatenate([x.to_numpy() for x in (a, b)]), return_inverse=True)
    one, other = np.split(place, 2)
    label = np.arange(len(nodes))
    while True:
        low = np.minimum(label[one], label[other])
        before = label.copy()
        for end in (label[one], label[other]):  # the root of either end learns the smaller root
            np.minimum.at(label, end, low)
        while not np.array_equal(label, label[label]):
            label = label[label]
        if np.array_equal(before, label):
            break
    below = label != np.arange(len(nodes))
    return [nodes[below], nodes[label[below]]]


def _contract(batches):
    """Edges (v, u) contracted in chunks of at most ``CHUNK_EDGES``, which is all that a task holds."""
    held: list[pa.RecordBatch] = []
    size = 0

    def flush():
        rows = pa.Table.from_batches(held)
        forest = _chunk_forest(rows.column("v"), rows.column("u"))
        return pa.RecordBatch.from_arrays([pa.array(x.tolist(), rows.schema.field("v").type) for x in forest], names=["v", "u"])

    for batch in batches:
        if size + batch.num_rows > CHUNK_EDGES and held:
            yield flush()
            held.clear()
            size = 0
        if batch.num_rows:
            held.append(batch)
            size += batch.num_rows
    if held:
        yield flush()


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """node, component (the smallest node reachable) for every node that is not itself the smallest of its component.

    Tasks first contract the edges they read, chunk by chunk, to stars; a chunk
    leaves fewer edges than it has nodes and connects the same nodes. Edges that
    fit one chunk are then contracted in one task, which gives the components.
    More go through rounds of alternating star contraction (every node sends
    its larger neighbours to the smallest node it knows, then its smaller
    neighbours and itself) until they fit or are one star per component. Nulls
    link with nothing.
    """
    def contracted(rows: DataFrame) -> DataFrame:
        kind = dict(rows.dtypes)["v"]
        return written(arrow_map(rows, _contract, f"v {kind}, u {kind}"), "edges")

    now = contracted(edges.filter(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b))).select(
        F.greatest(a, b).alias("v"), F.least(a, b).alias("u")))
    while now.count() > CHUNK_EDGES:
        both = now.select(F.col("u").alias("x"), F.col("u").alias("y")).union(now.select("v", "u")).union(
            now.select("u", "v"))
        least = both.groupBy("x").agg(F.min("y").alias("m"))
        large = now.join(least, now["u"] == least["x"]).select("v", F.col("m").alias("u")).filter(
            F.col("v") != F.col("u")).distinct()
        least = large.groupBy(F.col("v").alias("x")).agg(F.min("u").alias("m"))
        small = large.join(least, large["v"] == least["x"]).select(F.col("u").alias("v"), F.col("m").alias("u")).filter(
            F.col("u") != F.col("v"))
        now = written(least.select(F.col("x").alias("v"), F.col("m").alias("u")).union(small).distinct(), "edges")
        if _is_forest_of_stars(now):
            break
    else:
        now = contracted(now.coalesce(1))
    return now.select(F.col("v").alias("node"), F.col("u").alias("component"))


def shared_buckets(members: DataFrame) -> DataFrame:
    """The rows of (bucket, node) whose bucket has several rows, with their number n."""
    sizes = written(members.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).filter("n > 1"), "bucket_sizes")
    with settings(members.sparkSession, BLOOM):  # most buckets have one member: they stay out of the shuffle
        return written(members.join(sizes.filter("n > 1"), "bucket"), "buckets")


def _pairs(rows: DataFrame) -> DataFrame:
    return rows.select(F.least("node", "center").alias("a"), F.greatest("node", "center").alias("b")).distinct()


_UNIT = ["bucket", "low", "high"]


def _unit_edges(group: pa.Table, prepare: Callable) -> list[tuple]:
    """Edges that connect what the links of one pair of tiles (or one tile with itself) connect; at most one per member."""
    node = group.column("node").to_pylist()
    tile, low, high = (group.column(x).to_numpy() for x in ("tile", "low", "high"))
    _, label = np.unique(np.array(group.column("component").to_pylist()), return_inverse=True)
    near, edges = prepare(group.column("value")), []
    one = low[0] == high[0]
    others = np.arange(len(node)) if one else np.flatnonzero(tile == high[0])
    for i in range(len(node)) if one else np.flatnonzero(tile == low[0]).tolist():
        rest = others[others > i] if one else others
        rest = rest[label[rest] != label[i]]
        step = _CHUNK
        while len(rest):
            some, rest = rest[:step], rest[step:]
            linked = False
            for j in some[near(i, some)].tolist():
                if label[i] != label[j]:
                    edges.append((node[i], node[j]))
                    label[label == label[j]] = label[i]
                    linked = True
            if linked:
                rest, step = rest[label[rest] != label[i]], _CHUNK
            else:
                step *= 2
    return edges


def _units(prepare: Callable):
    """Rows come sorted by unit; one unit is held at a time."""
    def run(batches):
        held: list[pa.Table] = []

        def flush():
            group = pa.concat_tables(held).combine_chunks()
            edges = _unit_edges(group, prepare) if group.num_rows > 1 else []
            of = group.schema.field("node").type
            return pa.RecordBatch.from_arrays([pa.array([e[k] for e in edges], of) for k in (0, 1)], names=["a", "b"])

        for batch in batches:
            if not batch.num_rows:
                continue
            rows = pa.Table.from_batches([batch])
            keys = np.stack([rows.column(x).to_numpy() for x in _UNIT])
            cuts = [0, *(np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(axis=0)) + 1).tolist(), rows.num_rows]
            for first, last in zip(cuts, cuts[1:]):
                if held and any(held[-1].column(x)[-1].as_py() != rows.column(x)[first].as_py() for x in _UNIT):
                    yield flush()
                    held.clear()
                held.append(rows.slice(first, last - first))
        if held:
            yield flush()
    return run


def _tile_units(split: DataFrame) -> DataFrame:
    """The members of each bucket of ``split`` with the pairs of tiles (low, high) that they are compared in.

    The members of a bucket's largest component need no comparison among
    themselves: their tiles meet those of the other members only. A member
    has a row for each tile that its own meets: up to ``TILE`` members
    outside the largest component, one row and one for each tile of that.
    """
    sizes = split.groupBy("bucket", "component").agg(F.count(F.lit(1)).alias("m")).groupBy("bucket").agg(
        F.max(F.struct("m", "component")).alias("top"), F.sum("m").alias("all"))
    sizes = sizes.select("bucket", F.col("top.component").alias("top"),
                         F.ceil((F.col("all") - F.col("top.m")) / TILE).cast("int").alias("others"),
                         F.ceil(F.col("top.m") / TILE).cast("int").alias("tops"))
    in_top, hashed = F.col("component") == F.col("top"), F.xxhash64("node", "bucket")
    placed = split.select("bucket", "node", "component").join(sizes, "bucket").withColumn(
        "tile", F.when(in_top, F.col("others") + F.pmod(hashed, F.col("tops"))).otherwise(
            F.pmod(hashed, F.col("others"))).cast("int"))
    meets = F.sequence(F.lit(0), F.when(in_top, F.col("others")).otherwise(F.col("others") + F.col("tops")) - 1)
    return placed.withColumn("with", F.explode(meets)).select(
        "bucket", "node", "component", "tile", F.least("tile", "with").alias("low"), F.greatest("tile", "with").alias("high"))


def _tile_links(split: DataFrame, values: DataFrame, prepare: Callable) -> DataFrame:
    """Edges (a, b) that connect all links between different components of each bucket of ``split``; no pair is written out."""
    kind = dict(split.dtypes)["node"]
    dealt = _tile_units(split).join(values, "node").repartition(*_UNIT).sortWithinPartitions(*_UNIT)
    return arrow_map(dealt, _units(prepare), f"a {kind}, b {kind}")


def _split(rows: DataFrame, labels: DataFrame, turn: int = 0) -> tuple[DataFrame, DataFrame]:
    """``rows`` with their components, and the buckets that span several, each with one hashed member."""
    of_node = labels.withColumnRenamed("node", "of")
    placed = rows.join(of_node, rows["node"] == of_node["of"], "left").select(
        "bucket", "node", "n", F.coalesce("component", "node").alias("component"))
    split = placed.groupBy("bucket").agg(
        F.min("component").alias("low"), F.max("component").alias("high"),
        F.max(F.struct(F.xxhash64("node", F.lit(turn)), "node", "component")).alias("top")).filter("low <> high")
    return placed, split.select("bucket", "top")


def _across(rows: DataFrame) -> DataFrame:
    """All pairs (node, center) of a bucket whose components differ."""
    own = rows.select("bucket", "node", "component")
    other = own.select("bucket", F.col("node").alias("center"), F.col("component").alias("c"))
    return own.join(other, "bucket").filter((F.col("node") < F.col("center")) & (F.col("component") != F.col("c"))).select(
        "node", "center")


def bucket_components(shared: DataFrame, verify: Callable[[DataFrame], DataFrame],
                      known: DataFrame | None = None, values: DataFrame | None = None,
                      prepare: Callable | None = None) -> DataFrame:
    """Components (as above) of the links that ``verify`` confirms among nodes that share a bucket.

    ``shared`` comes from ``shared_buckets``; ``verify`` takes candidate pairs
    (a, b) and returns those that are linked. Each bucket proposes a star, not
    all its pairs: its centre is the member that meets most other nodes over
    all buckets (an original that many copies resemble meets more of them than
    the copies meet each other). Buckets that then still span several
    components are searched further: small ones in full, large ones by stars
    around other centres for at most ``STAR_TURNS`` turns. What large buckets
    still span then is compared in full as well, every member with all of other
    components, so the result is that of all pairs within buckets: in tiles
    (see ``_tile_links``) on ``values`` (node, value), where ``prepare`` turns
    the values of a unit into a function of a place and other places that tells
    which of these are linked; without ``values``, as pairs for ``verify``.
    ``known`` has links (a, b) found elsewhere.
    """
    if known is not None and shared.isEmpty():
        return connected_components(known)
    scores = shared.groupBy("node").agg(F.sum("n").alias("score"))
    scored = shared.join(scores, "node").select("bucket", "node", "n", "score")
    centers = scored.groupBy("bucket").agg(F.max(F.struct("score", "node"))["node"].alias("center"))
    tried = written(_pairs(shared.join(centers, "bucket").filter(F.col("node") != F.col("center"))), "pairs")
    links = verify(tried) if known is None else verify(tried).union(known)
    labels = connected_components(written(links, "links"))
    open_rows = shared.select("bucket", "node", "n")
    turn = 0
    while True:
        placed, split = _split(open_rows, labels, turn)
        placed = written(placed.join(split, "bucket"), "split")
        candidates = placed.filter(F.col("component") != F.col("top")["component"]).select(
            "node", F.col("top")["node"].alias("center"))
        if turn == 0:
            candidates = candidates.union(_across(placed.filter(F.col("n") <= SMALL_BUCKET)))
        fresh = written(_pairs(candidates).join(tried, ["a", "b"], "left_anti"), "pairs")
        found = written(verify(fresh), "links")
        # the components so far, as edges, stand for the links that made them
        done = labels.select(F.col("node").alias("a"), F.col("component").alias("b"))
        labels = connected_components(done.union(found))
        open_rows, tried, turn = placed.filter(F.col("n") > SMALL_BUCKET).select("bucket", "node", "n"), tried.union(fresh), turn + 1
        if turn == STAR_TURNS or open_rows.isEmpty() or found.isEmpty():
            break
    if open_rows.isEmpty():
        return labels
    placed, split = _split(open_rows, labels)
    rest = written(placed.join(split, "bucket"), "split")
    if rest.isEmpty():
        return labels
    if values is None:
        found = verify(_pairs(_across(rest)).join(tried, ["a", "b"], "left_anti"))
    else:
        found = _tile_links(rest, values, prepare)
    done = labels.select(F.col("node").alias("a"), F.col("component").alias("b"))
    return connected_components(done.union(written(found, "links")))
