"""Ranked lexical search by NRA (no random access) over impact-sorted postings.

Terms are the maximal runs of ASCII letters and digits and of characters beyond
ASCII, A-Z lower-cased. With N documents that have a term, L terms in all, n
terms in a document, df documents that hold a term and tf occurrences of it in
the document, a term counts

    floor(1000 ln((2 N + 2) / (2 df + 1))) * ((10^9 tf) div (1000 tf + 8 m)),
    m = 100 - B + (B n N) div L,  B = 90

(its impact) for the document; a document's score for a query is the sum over
the query's terms, once each.

The index is partitioned by documents: a *shard* is a run of index rows of at
most ``SHARD_POSTINGS`` postings (or one document), whose lists a task sorts by
impact. N, L and df are those of the whole table, so scores of all shards
compare. In a shard each query reads its terms' lists in step, from the highest
impact down, a growing number of postings a turn. A document's lower bound is
the sum of what was read; its upper bound adds, for each list where it was not
met, the impact last read there. Reading goes on until no document, met or not,
whose upper bound reaches the k-th lower bound has an open interval: then
membership, ties and scores are final. The best k of all shards are ranked in
two steps, so that no task holds a candidate of every shard.

The postings hold the queries' terms only. Queries are taken in blocks of about
``QUERY_TERMS`` (query, term) pairs, each of which is sent to the tasks; more
queries make more blocks, each of them against all rows.

Defined results: a null text has no term and is not counted; documents that
share an id are documents of their own; a null id ranks after others of its
score; queries that share an id (null too) are one query with the terms of all;
a query without terms, or without a match, has no row; empty tables give an
empty result; extra columns have no part in it.
"""

from __future__ import annotations

import math
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .shared import arrow_map, written
from .text import lists, release

TOP = 10
SHARD_POSTINGS = 1 << 20
QUERY_TERMS = 1 << 19
FIRST_READ = 64  # postings of a list read in the first turn; each turn reads as many as all before it
SCALE = 1_000_000_000
K_TF, K_LENGTH, B = 1000, 8, 90  # tf saturation, weight of a document's length, share of the length in it
_MERGE = 64  # parts of a query's candidates in the first ranking

# bytes of terms as they are, A-Z in lower case, all others a blank
_TERM_BYTES = bytes(c if c >= 128 or chr(c).isalnum() else 32 for c in range(256)).lower()


def terms_of(text: str | None) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").translate(_TERM_BYTES).split(b" ") if text else []


def _counts(text: str | None) -> Counter:
    counts = Counter(terms_of(text))
    del counts[b""]
    return counts


def _query_terms(batches):
    for batch in batches:
        ids, terms = [], []
        for k, text in enumerate(batch.column("text").to_pylist()):
            own = _counts(text)
            ids.extend([k] * len(own))
            terms.extend(own)
        yield pa.RecordBatch.from_arrays([batch.column("item_id").take(pa.array(ids, pa.int64())), pa.array(terms, pa.binary())],
                                         names=["item_id", "term"])


def _index_rows(vocabulary):
    """Rows of the index: a document's number of terms, and its postings of the vocabulary's terms."""
    def run(batches):
        known = vocabulary.value
        for batch in batches:
            total, sizes, terms, times = [], [], [], []
            for text in batch.column("text").to_pylist():
                own = _counts(text)
                total.append(sum(own.values()))
                found = [(known[t], c) for t, c in own.items() if t in known]
                sizes.append(len(found))
                terms.extend(t for t, _ in found)
                times.extend(c for _, c in found)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(total, pa.int64()), lists(pa.array(terms, pa.int32()), np.array(sizes)),
                 lists(pa.array(times, pa.int64()), np.array(sizes))], names=["doc_id", "n", "terms", "times"])
        release()
    return run


def nra(listed: list[tuple[np.ndarray, np.ndarray]], size: int, k: int, first_read: int = FIRST_READ) -> tuple[np.ndarray, np.ndarray, int]:
    """Places and scores of the documents (of ``size``) that can be among the best k, and the postings read.

    ``listed`` has the documents and impacts of each term, impacts descending.
    Returned are all documents above 0 whose score is not below the k-th.
    """
    low = np.zeros(size, np.int64)
    met = np.zeros((len(listed), size), bool)
    frontier = np.zeros(len(listed), np.int64)
    depth, step, read = 0, first_read, 0
    while True:
        for t, (docs, impacts) in enumerate(listed):
            some = docs[depth: depth + step]
            if len(some):
                low[some] += impacts[depth: depth + step]  # a document stands once in a list
                met[t, some] = True
                read += len(some)
            end = depth + step
            frontier[t] = impacts[end - 1] if end < len(impacts) else 0
        depth, step = depth + step, depth + step
        unseen = int(frontier.sum())
        found = np.flatnonzero(low)
        kth = int(np.partition(low[found], len(found) - k)[len(found) - k]) if len(found) >= k else 1
        if unseen >= kth:
            continue  # a document that no list has shown yet could be among them
        near = found[low[found] + unseen >= kth]
        missing = unseen - frontier @ met[:, near]
        near = near[low[near] + missing >= kth]
        missing = unseen - frontier @ met[:, near]
        if not missing.any():
            return near, low[near], read


class _Shard:
    """The impact-sorted lists of some documents."""

    def __init__(self, ids: pa.Array, terms: np.ndarray, docs: np.ndarray, impacts: np.ndarray):
        order = np.lexsort((-impacts, terms))
        self.ids, self.terms, self.docs, self.impacts = ids, terms[order], docs[order], impacts[order]

    def listed(self, term: int) -> tuple[np.ndarray, np.ndarray]:
        a, b = np.searchsorted(self.terms, [term, term + 1])
        return self.docs[a:b], self.impacts[a:b]


def _best(queries, weights, k: int, shard_postings: int):
    def search(held: list[pa.RecordBatch], number: int):
        rows = pa.Table.from_batches(held).combine_chunks()
        sizes = np.diff(rows.column("terms").combine_chunks().offsets.to_numpy())
        terms = rows.column("terms").combine_chunks().flatten().to_numpy()
        times = rows.column("times").combine_chunks().flatten().to_numpy()
        docs = np.repeat(np.arange(rows.num_rows), sizes)
        m = rows.column("m").to_numpy()[docs]
        impacts = weights.value[terms] * (SCALE * times // (K_TF * times + K_LENGTH * m))
        live = impacts > 0
        shard = _Shard(rows.column("doc_id").combine_chunks(), terms[live], docs[live], impacts[live])
        found: list[tuple[int, np.ndarray, np.ndarray]] = []
        for query, wanted in enumerate(queries.value):
            listed = [x for x in map(shard.listed, wanted) if len(x[0])]
            if listed:
                place, score, _ = nra(listed, rows.num_rows, k)
                found.append((query, place, score))
        counts = [len(place) for _, place, _ in found]
        places = np.concatenate([p for _, p, _ in found]) if found else np.zeros(0, np.int64)
        scores = np.concatenate([s for _, _, s in found]) if found else np.zeros(0, np.int64)
        query = np.repeat(np.array([q for q, _, _ in found], np.int32), counts)
        return pa.RecordBatch.from_arrays(
            [pa.array(query, pa.int32()), shard.ids.take(pa.array(places)), pa.array(scores)], names=["query", "doc_id", "score"])

    def run(batches):
        held, postings, number = [], 0, 0
        for batch in batches:
            sizes = np.diff(batch.column("terms").offsets.to_numpy()) if batch.num_rows else np.zeros(0, np.int64)
            first = 0
            while first < len(sizes):
                total = np.cumsum(sizes[first:]) + postings
                fits = int(np.searchsorted(total, shard_postings, "right"))
                if not fits and held:
                    yield search(held, number)
                    held, postings, number = [], 0, number + 1
                    continue
                fits = max(fits, 1)
                held.append(batch.slice(first, fits))
                postings, first = int(total[fits - 1]), first + fits
        if held:
            yield search(held, number)
        release()
    return run


def _ranked(found: DataFrame, k: int) -> DataFrame:
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last()]
    for keys in (["query", "part"], ["query"]):
        found = found.withColumn("rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).filter(F.col("rank") <= k)
    return found


def _search_block(docs: DataFrame, pairs: list, k: int, item_kind: str, shard_postings: int) -> DataFrame:
    spark, kind = docs.sparkSession, dict(docs.dtypes)["doc_id"]
    items = sorted({item for item, _ in pairs}, key=lambda x: (x is None, x))
    terms = sorted({term for _, term in pairs})
    number, place = {t: i for i, t in enumerate(terms)}, {x: i for i, x in enumerate(items)}
    queries: list[list[int]] = [[] for _ in items]
    for item, term in pairs:
        queries[place[item]].append(number[term])

    vocabulary = spark.sparkContext.broadcast(number)
    index = written(arrow_map(docs, _index_rows(vocabulary), f"doc_id {kind}, n long, terms array<int>, times array<long>"), "index")
    live = index.filter("n > 0")
    whole = live.agg(F.count(F.lit(1)).alias("docs"), F.sum("n").alias("terms")).first()
    n_docs, n_terms = whole["docs"], whole["terms"] or 1
    holds = live.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    weights = np.zeros(len(terms), np.int64)
    for row in holds.toLocalIterator():  # a row per term of this block of queries
        weights[row["term"]] = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * row["df"] + 1)))
    # decimals: the product passes 64 bits on long texts of very large tables
    m = F.expr(f"{100 - B} + cast((cast({B} as decimal(38,0)) * n * {n_docs}L) div {n_terms}L as bigint)")
    best = arrow_map(live.select("doc_id", m.alias("m"), "terms", "times"),
                     _best(spark.sparkContext.broadcast(queries), spark.sparkContext.broadcast(weights), k, shard_postings),
                     f"query int, doc_id {kind}, score long")
    best = written(_ranked(best.withColumn("part", F.spark_partition_id() % _MERGE), k), "best")
    names = spark.createDataFrame(list(enumerate(items)), f"nth int, item_id {item_kind}")
    return best.join(names, best["query"] == names["nth"]).select("item_id", "rank", "doc_id", "score")


def search(docs: DataFrame, items: DataFrame, k: int = TOP, id_col: str = "doc_id", text_col: str = "text",
           item_col: str = "item_id", item_text: str = "text", query_terms: int = QUERY_TERMS,
           shard_postings: int = SHARD_POSTINGS) -> DataFrame:
    """item_id, rank (from 1), doc_id and score of the k highest documents of each query, scores above 0."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    asked = items.select(F.col(item_col).alias("item_id"), F.col(item_text).alias("text"))
    item_kind = dict(asked.dtypes)["item_id"]
    pairs = written(arrow_map(asked, _query_terms, f"item_id {item_kind}, term binary").distinct(), "query_terms")
    blocks = max(1, -(-pairs.count() // query_terms))

    def block(number: int) -> Column:
        return F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == number

    found = None
    for number in range(blocks):
        own = [(r["item_id"], bytes(r["term"])) for r in pairs.filter(block(number)).collect()]  # about query_terms rows
        part = _search_block(rows, own, k, item_kind, shard_postings)
        found = part if found is None else found.union(part)
    return found
