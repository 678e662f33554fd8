"""Near-duplicate vectors: random-hyperplane sign hashing, exact cosine, connected components.

Equal vectors form one class, which the search handles once, with its number
of copies. Every class is hashed by the signs of its products with random
hyperplanes: ``tables`` tables of ``bits`` signs each. Classes that share a
table's signs form a bucket, and all pairs of a bucket are compared exactly,
in double precision. Buckets are cut into tiles of about ``TILE`` classes and
each pair of tiles is a task's unit of work, so a bucket of any size is spread
over the cluster. No pair is ever written out: a unit returns the number of
links of each of its classes and at most one edge per class for the
components. A pair that meets in several tables counts in the first of them
only.

``bits`` follows the number of classes (about 64 classes to a bucket of evenly
spread vectors), and ``tables`` is the number that finds a pair at the cosine
threshold with probability 1 - ``MISS``; closer pairs are found more surely.

Defined results: a vector that is null, empty, zero or holds a null or
non-finite component, or has no id, links with nothing and is kept; vectors of different
lengths never link; rows that share an id count as one vector in components,
their links are counted row by row; an empty table gives an empty result.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .components import connected_components
from .shared import arrow_map, written

COSINE = 0.95
MISS = 1e-6
TILE = 512
SEED = 11
BUCKET_CLASSES = 64
_NEAR = 1e-9  # products this close to the threshold are divided again, as the definition has it


def plan_tables(classes: int, cosine: float = COSINE, miss: float = MISS) -> tuple[int, int]:
    """bits, tables."""
    bits = min(30, max(8, round(math.log2(max(classes, 1) / BUCKET_CLASSES)))) if classes else 8
    same = (1 - math.acos(cosine) / math.pi) ** bits
    return bits, math.ceil(math.log(miss) / math.log(1 - same))


def _vectors(batches):
    """vec_id and the vector's bytes (float64), null where it links with nothing."""
    for batch in batches:
        column = batch.column("vec")
        out = []
        for row in range(batch.num_rows):
            value = column[row].values if column[row].is_valid else None
            if value is None or not len(value) or value.null_count:
                out.append(None)
                continue
            vec = value.to_numpy(zero_copy_only=False).astype("<f8") + 0.0  # one zero
            out.append(vec.tobytes() if np.isfinite(vec).all() and vec.any() and np.isfinite(vec @ vec) and vec @ vec > 0
                       else None)
        yield pa.RecordBatch.from_arrays([batch.column("vec_id"), pa.array(out, pa.binary())], names=["vec_id", "vec"])


def _signs(bits: int, tables: int, seed: int):
    planes: dict[int, np.ndarray] = {}

    def run(batches):
        for batch in batches:
            raw = batch.column("vec").to_pylist()
            out: list[bytes] = [b""] * len(raw)
            by_length: dict[int, list[int]] = {}
            for i, v in enumerate(raw):
                by_length.setdefault(len(v) // 8, []).append(i)
            for dim, own in by_length.items():
                if dim not in planes:
                    planes[dim] = np.random.default_rng([seed, dim]).standard_normal((dim, tables * bits))
                vecs = np.frombuffer(b"".join(raw[i] for i in own), "<f8").reshape(len(own), dim)
                vecs = vecs / np.abs(vecs).max(axis=1, keepdims=True)
                on = ((vecs @ planes[dim]) > 0).reshape(len(own), tables, bits)
                keys = (on * (1 << np.arange(bits))).sum(axis=2).astype("<i4")
                for i, row in zip(own, keys):
                    out[i] = row.tobytes()
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(x) for x in ("node", "cid", "copies", "vec")), pa.array(out, pa.binary()),
                 pa.array([np.frombuffer(x, "<i4") for x in out], pa.list_(pa.int32()))],
                names=["node", "cid", "copies", "vec", "signs", "keys"])
    return run


def _compare(vecs: np.ndarray, norms: np.ndarray, a: np.ndarray, b: np.ndarray, cosine: float, itself: bool):
    """Places in a and b of the pairs whose cosine is at least the threshold."""
    unit = vecs / norms[:, None]
    found = unit[a] @ unit[b].T
    i, j = np.nonzero(found >= cosine - _NEAR)
    if itself:
        i, j = i[i < j], j[i < j]
    value = found[i, j]
    edge = np.flatnonzero(value < cosine + _NEAR)
    for e in edge.tolist():
        x, y = a[i[e]], b[j[e]]
        value[e] = np.dot(vecs[x], vecs[y]) / (norms[x] * norms[y])
    ok = value >= cosine
    return a[i[ok]], b[j[ok]]


_UNIT = ["bucket", "low", "high"]
_OUT = pa.schema([("node", pa.int64()), ("cid", pa.int64()), ("n", pa.int64()), ("other", pa.int64())])


def _unit(group: pa.Table, cosine: float) -> pa.RecordBatch | None:
    """The links of one pair of tiles (or one tile with itself)."""
    part, low, high = (group.column(x).to_numpy() for x in ("tile", "low", "high"))
    vecs = np.frombuffer(b"".join(group.column("vec").to_pylist()), "<f8").reshape(len(part), -1)
    norms = np.sqrt(np.einsum("ij,ij->i", vecs, vecs))
    if low[0] == high[0]:
        every = np.arange(len(part))
        i, j = _compare(vecs, norms, every, every, cosine, True)
    else:
        i, j = _compare(vecs, norms, np.flatnonzero(part == low), np.flatnonzero(part == high), cosine, False)
    if not len(i):
        return None
    table = int(group.column("table")[0].as_py())
    signs = np.frombuffer(b"".join(group.column("signs").to_pylist()), "<i4").reshape(len(part), -1)
    fresh = np.ones(len(i), bool)
    for t in range(table):
        fresh &= signs[i, t] != signs[j, t]
    i, j = i[fresh], j[fresh]
    if not len(i):
        return None
    copies, node, cid = (group.column(x).to_numpy() for x in ("copies", "node", "cid"))
    n = np.bincount(i, weights=copies[j], minlength=len(part)) + np.bincount(j, weights=copies[i], minlength=len(part))
    label, before = np.arange(len(part)), None
    while before is None or (label != before).any():
        before = label.copy()
        np.minimum.at(label, i, label[j])
        np.minimum.at(label, j, label[i])
        label = label[label]
    counted, tied = np.flatnonzero(n), np.flatnonzero(label != np.arange(len(part)))
    none = np.zeros(0, np.int64)
    return pa.RecordBatch.from_arrays([
        pa.array(np.r_[node[counted], node[tied]]),
        pa.array(np.r_[cid[counted], np.zeros(len(tied), np.int64)]),
        pa.array(np.r_[n[counted].astype(np.int64), np.zeros(len(tied), np.int64)]),
        pa.array(np.r_[node[counted], node[label[tied]]] if len(part) else none)], schema=_OUT)


def _units(cosine: float):
    """Rows come sorted by unit; one unit is held at a time."""
    def run(batches):
        held: list[pa.Table] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = pa.Table.from_batches([batch])
            keys = np.stack([rows.column(x).to_numpy() for x in _UNIT])
            cuts = np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(axis=0)) + 1
            if held and any(held[-1].column(x)[-1].as_py() != rows.column(x)[0].as_py() for x in _UNIT):
                cuts = np.r_[0, cuts]
            first = 0
            for cut in cuts.tolist():
                group = pa.concat_tables([*held, rows.slice(first, cut - first)])
                held, first = [], cut
                out = _unit(group.combine_chunks(), cosine) if group.num_rows > 1 else None
                if out:
                    yield out
            held.append(rows.slice(first))
        if held and sum(x.num_rows for x in held) > 1:
            out = _unit(pa.concat_tables(held).combine_chunks(), cosine)
            if out:
                yield out
    return run


def near_duplicate_vectors(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding",
                           cosine: float = COSINE, seed: int = SEED) -> DataFrame:
    """One row per vector: vec_id, n_links, component_id and kept."""
    raw = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vec_col).alias("vec"))
    found = arrow_map(raw, _vectors, "vec_id long, vec binary")
    rows = written(found.withColumn("vec", F.when(F.col("vec_id").isNotNull(), F.col("vec"))), "vectors")
    classes = rows.filter("vec is not null").groupBy("vec").agg(
        F.min("vec_id").alias("node"), F.count(F.lit(1)).alias("copies")).withColumn("cid", F.xxhash64("vec"))
    classes = written(classes, "vector_classes")
    bits, tables = plan_tables(classes.count(), cosine)
    hashed = written(arrow_map(classes.select("node", "cid", "copies", "vec"), _signs(bits, tables, seed),
                               "node long, cid long, copies long, vec binary, signs binary, keys array<int>"), "signs")
    members = hashed.select("node", "cid", F.length("vec").alias("size"), F.posexplode("keys").alias("table", "key")).select(
        "node", "cid", "table", F.xxhash64("size", "table", "key").alias("bucket"))
    sizes = members.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select(
        F.col("bucket").alias("shared"), F.ceil(F.col("n") / TILE).cast("int").alias("tiles"))
    tile = F.pmod(F.xxhash64("cid", "node", "table"), F.col("tiles")).cast("int")
    placed = members.join(sizes, F.col("bucket") == F.col("shared")).withColumn("tile", tile)
    units = placed.withColumn("with", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1))).select(
        "node", "cid", "table", "bucket", "tile", F.least("tile", "with").alias("low"),
        F.greatest("tile", "with").alias("high"))
    full = units.join(hashed.select("node", "cid", "copies", "vec", "signs"), ["node", "cid"])
    dealt = full.repartition(*_UNIT).sortWithinPartitions(*_UNIT)
    links = written(arrow_map(dealt, _units(cosine), "node long, cid long, n long, other long"), "vector_links")

    counts = links.filter("n > 0").groupBy("node", "cid").agg(F.sum("n").alias("n"))
    edges = links.filter("n = 0").select(F.col("node").alias("a"), F.col("other").alias("b"))
    known = rows.join(classes.withColumnRenamed("vec", "class_vec"), F.col("vec") == F.col("class_vec"), "left").select(
        "vec_id", "node", "cid", "copies")
    ids = known.filter("node is not null").select("vec_id", "node").distinct()
    several = ids.groupBy("vec_id").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("vec_id")
    ties = ids.join(several, "vec_id", "left_semi").select(F.col("vec_id").alias("a"), F.col("node").alias("b"))
    labels = connected_components(edges.union(ties)).withColumnsRenamed({"node": "of", "component": "label"})
    joined = known.join(counts, ["node", "cid"], "left").join(labels, F.col("node") == F.col("of"), "left")
    n_links = F.when(F.col("node").isNull(), 0).otherwise(F.coalesce("n", F.lit(0)) + F.col("copies") - 1)
    component = F.coalesce("label", "node", "vec_id")
    return joined.select("vec_id", n_links.cast("long").alias("n_links"), component.alias("component_id"),
                         F.col("vec_id").eqNullSafe(component).alias("kept"))
