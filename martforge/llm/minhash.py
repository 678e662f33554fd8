"""Near-duplicate documents by one-permutation MinHash with optimal densification.

A document's set is that of its ``shingle_words``-word shingles (ASCII lower
case; with fewer words, the whole sequence is the one shingle), as 64-bit
hashes. Each of ``ROWS`` permutations is used once for all ``BANDS`` bins: a
bin's value is the smallest hash that falls into it, and an empty bin borrows
from a bin that a fixed sequence of hashes picks (optimal densification). A
band is the same bin under every permutation, so its rows are independent.
With 32 bands of 5 rows, two sets at a similarity of 0.8 share a band with
probability 0.999997.

Documents with equal sets (a 128-bit fingerprint of the whole set) form one
class, and the search goes on with one representative each. Bands that several
representatives share propose star-shaped candidate edges (see
``components.bucket_components``), so a group of thousands of near copies
proposes a few edges per member; every edge is confirmed on the full sets.

Defined results: a text that is null or has no word has an empty set and is
linked with nothing; rows that share an id count as one document, linked if
any of their texts is; a row without an id is linked with nothing and kept; an
empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .components import bucket_components, connected_components, shared_buckets
from .shared import BLOOM, arrow_map, settings, written
from .text import Texts, lists, mix, one_of_each, signed, span_hashes, text_slices

SHINGLE_WORDS = 5
SIMILARITY_PERCENT = 80
BANDS, ROWS = 32, 5
_NONE = np.uint64(0xFFFFFFFFFFFFFFFF)
_COLUMNS = 4096  # shingles counted at a time


def shingle_sets(texts: Texts, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The distinct shingle hashes of each row, and the row of each, rows in order."""
    starts, ends = texts.word_spans()
    rows = texts.row_of(starts)
    words = span_hashes(texts.data, starts, ends, lower=True)
    count = np.bincount(rows, minlength=texts.rows)
    first = np.cumsum(count) - count
    # the words of a row from each place on, up to k; short rows have one window of all their words
    keep = np.flatnonzero((np.arange(len(words)) - first[rows] + k <= count[rows]) |
                          ((count[rows] < k) & (np.arange(len(words)) == first[rows])))
    left = np.minimum(count[rows[keep]], k)
    key = mix(left.astype(np.uint64))
    for i in range(k):
        inside = left > i
        key[inside] = mix(key[inside] ^ words[keep[inside] + i])
    of_row = rows[keep]
    own = one_of_each(mix(key + mix(of_row.astype(np.uint64))))
    return key[own], of_row[own]


def one_permutation(keys: np.ndarray, rows: np.ndarray, n: int, seed: int, bins: int) -> np.ndarray:
    """Rows by bins: the smallest hash in each bin, empty bins filled by optimal densification."""
    hashed = mix(keys ^ mix(np.uint64(seed + 1)))
    out = np.full((n, bins), _NONE, np.uint64)
    np.minimum.at(out.reshape(-1), rows * bins + (hashed >> np.uint64(32)).astype(np.int64) % bins, hashed)
    filled = out != _NONE
    todo = np.flatnonzero(filled.any(axis=1) & ~filled.all(axis=1))
    attempt, source = 0, out.copy()
    while len(todo):
        attempt += 1
        pick = (mix(np.arange(bins, dtype=np.uint64) + np.uint64(attempt * 1000003 + seed * 7919)) % np.uint64(bins)).astype(np.int64)
        got = source[np.ix_(todo, pick)]
        take = (out[todo] == _NONE) & (got != _NONE)
        part = out[todo]
        part[take] = got[take]
        out[todo] = part
        todo = todo[(part == _NONE).any(axis=1)]
    return out


def band_keys(keys: np.ndarray, rows: np.ndarray, n: int, bands: int = BANDS, per_band: int = ROWS) -> np.ndarray:
    key = mix(np.arange(bands, dtype=np.uint64))[None, :].repeat(n, axis=0)
    for p in range(per_band):
        key = mix(key ^ one_permutation(keys, rows, n, p, bands))
    return key


def _signatures(k: int):
    def run(batches):
        for part, texts in text_slices(batches):
            keys, rows = shingle_sets(texts, k)
            n = texts.rows
            count = np.bincount(rows, minlength=n)
            prints = np.zeros((2, n), np.uint64)
            filled = np.flatnonzero(count)
            if len(filled):
                first = (np.cumsum(count) - count)[filled]
                prints[0, filled] = np.add.reduceat(mix(keys), first)
                prints[1, filled] = np.add.reduceat(mix(keys ^ np.uint64(0x5851F42D4C957F2D)), first)
            bands = band_keys(keys, rows, n)[filled]
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), pa.array(count.astype(np.int64)), pa.array(signed(prints[0])),
                 pa.array(signed(prints[1])), lists(pa.array(signed(bands.reshape(-1))), np.where(count > 0, BANDS, 0))],
                names=["doc_id", "n_shingles", "print1", "print2", "bands"])
    return run


def _full_sets(k: int):
    def run(batches):
        for part, texts in text_slices(batches):
            keys, rows = shingle_sets(texts, k)
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), lists(pa.array(signed(keys)), np.bincount(rows, minlength=texts.rows))],
                names=["doc_id", "shingles"])
    return run


def similar_pairs(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose full sets have at least ``percent`` of their union in common."""
    def side(x: str) -> DataFrame:
        return sets.select(F.col("doc_id").alias(x), F.col("shingles").alias(f"set_{x}"))

    near = 100 * F.least(F.size("set_a"), F.size("set_b")) >= percent * F.greatest(F.size("set_a"), F.size("set_b"))
    both = pairs.join(side("a"), "a").join(side("b"), "b").filter(near)
    shared = F.size(F.array_intersect("set_a", "set_b"))
    union = F.size("set_a") + F.size("set_b") - shared
    return both.filter(100 * shared >= percent * union).select("a", "b").distinct()


def _similar_sets(percent: int):
    """For sets of one unit: which of some others are similar to one."""
    def prepare(values):
        sets = [np.asarray(x, np.int64) for x in values.to_pylist()]
        size = np.array([len(x) for x in sets])
        key, of_set = np.concatenate(sets), np.repeat(np.arange(len(sets)), size)
        _, key, times = np.unique(key, return_inverse=True, return_counts=True)
        many = times > 1  # a shingle of one set alone is in no intersection
        place = np.cumsum(many) - 1
        of_set, key = of_set[many[key]], place[key[many[key]]]
        order = np.argsort(key, kind="stable")
        of_set, key, shared = of_set[order], key[order], np.zeros((len(sets), len(sets)))
        for first in range(0, int(many.sum()), _COLUMNS):
            a, b = np.searchsorted(key, [first, first + _COLUMNS])
            part = np.zeros((len(sets), _COLUMNS), np.float32)
            part[of_set[a:b], key[a:b] - first] = 1
            shared += part @ part.T

        def near(i: int, others: np.ndarray) -> np.ndarray:
            common = shared[i, others]
            return 100 * common >= percent * (size[i] + size[others] - common)
        return near
    return prepare


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    shingle_words: int = SHINGLE_WORDS, percent: int = SIMILARITY_PERCENT) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles, component_id and kept."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    kind = dict(rows.dtypes)["doc_id"]
    signed_rows = written(arrow_map(rows, _signatures(shingle_words),
                                    f"doc_id {kind}, n_shingles long, print1 long, print2 long, bands array<long>"),
                          "signatures")
    live = signed_rows.filter("n_shingles > 0 and doc_id is not null")
    prints = ["print1", "print2"]
    classes = live.groupBy(*prints).agg(F.min("doc_id").alias("rep"))
    tagged = live.select("doc_id", *prints).distinct().join(classes, prints)
    reps = live.join(classes, prints).filter(F.col("doc_id") == F.col("rep"))
    buckets = shared_buckets(reps.select(F.explode("bands").alias("bucket"), F.col("rep").alias("node")))
    wanted = written(buckets.groupBy("node").agg(F.max("n").alias("n")), "wanted").filter("n > 1").select(
        F.col("node").alias("doc_id"))
    with settings(docs.sparkSession, BLOOM):  # most texts stay out of the shuffle
        sets = written(arrow_map(rows.join(wanted, "doc_id", "left_semi"), _full_sets(shingle_words),
                                 f"doc_id {kind}, shingles array<long>"), "sets")
    values = sets.select(F.col("doc_id").alias("node"), F.col("shingles").alias("value"))
    labels = bucket_components(buckets, lambda pairs: similar_pairs(pairs, sets, percent), values=values,
                               prepare=_similar_sets(percent))

    # an id with several texts ties their classes together
    ties = tagged.select(F.col("doc_id").alias("a"), F.col("rep").alias("b")).filter("a <> b")
    several = tagged.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select(F.col("doc_id").alias("a"))
    ties = ties.join(several, "a", "left_semi")
    if not ties.isEmpty():
        labels = connected_components(labels.select(F.col("node").alias("a"), F.col("component").alias("b")).union(ties))
    found = tagged.join(labels, tagged["rep"] == labels["node"], "left").select(
        F.col("doc_id").alias("id"), F.coalesce("component", "rep").alias("component_id"))
    found = found.groupBy("id").agg(F.min("component_id").alias("component_id"))
    joined = signed_rows.select("doc_id", "n_shingles").join(found, F.col("doc_id") == F.col("id"), "left")
    component = F.coalesce("component_id", "doc_id")
    return joined.select("doc_id", "n_shingles", component.alias("component_id"),
                         F.col("doc_id").eqNullSafe(component).alias("kept"))
