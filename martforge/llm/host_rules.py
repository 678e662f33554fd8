"""Quality rules per document and, by an empirical beta prior, per host.

Every document is judged by two base rules (too few words; too many words in
repeated eight-word windows). The failures are counted by host, the rate of
each host is shrunk towards the mean of all hosts by a beta prior fitted to
the hosts themselves (method of moments), and the verdict on the host is
joined back: a document is kept if it passes the base rules and its host's
shrunk failure rate stays below ``max_host_rate``.

Defined results: a null text has no words and fails; a null host is a host of
its own; repeated rows are judged one by one; an empty table gives an empty
result; columns other than the id, text and host are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import arrow_map, written
from .text import BLANK, CONTINUATION, mix, one_of_each, span_hashes, text_slices

MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
WINDOW_WORDS = 8
MAX_HOST_RATE = 0.5
# bounds of the prior's strength (its pseudo-documents): no host spread at all, or the widest
MIN_STRENGTH, MAX_STRENGTH = 1.0, 1e6

SYMBOLS = np.zeros(256, bool)
SYMBOLS[list(b"#*$%&|<>")] = True
FEATURES = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long"


def _duplicates(keys: np.ndarray, rows: np.ndarray, n: int) -> np.ndarray:
    """Per row, how many of its keys equal an earlier key of the row."""
    own = one_of_each(mix(keys + mix(rows.astype(np.uint64))))
    return np.bincount(rows, minlength=n) - np.bincount(rows[own], minlength=n)


def _repeated_words(words: np.ndarray, rows: np.ndarray, n: int, window: int) -> np.ndarray:
    """Per row, how many words lie in a window that occurs at least twice in the row."""
    if len(words) < window:
        return np.zeros(n, np.int64)
    last = len(words) - window + 1
    key = np.zeros(last, np.uint64)
    for k in range(window):
        key = mix(key ^ words[k: k + last])
    whole = np.flatnonzero(rows[:last] == rows[window - 1:])
    key = key[whole] + mix(rows[whole].astype(np.uint64))
    _, which, count = np.unique(key, return_inverse=True, return_counts=True)
    again = whole[count[which] > 1]
    steps = np.zeros(len(words) + 1, np.int32)
    steps[again] += 1  # a window starts once at a place
    np.subtract.at(steps, again + window, 1)
    return np.bincount(rows[np.cumsum(steps[:-1]) > 0], minlength=n)


def _features(batches):
    for part, texts in text_slices(batches):
        n = texts.rows
        starts, ends = texts.word_spans()
        rows = texts.row_of(starts)
        words = span_hashes(texts.data, starts, ends)
        solid = ~BLANK[texts.data]
        begin, end = texts.line_spans()
        total = np.zeros(len(solid) + 1, np.int64)
        np.cumsum(solid, out=total[1:])
        filled = total[end] > total[begin]
        begin, end = begin[filled], end[filled]
        found = [
            np.bincount(rows, minlength=n),
            texts.per_row(solid & ~CONTINUATION[texts.data]),
            texts.per_row(SYMBOLS[texts.data]),
            _duplicates(span_hashes(texts.data, begin, end), texts.row_of(begin), n),
            _repeated_words(words, rows, n, WINDOW_WORDS),
        ]
        kept = [part.column(i) for i, name in enumerate(part.schema.names) if name != "text"]
        names = [name for name in part.schema.names if name != "text"] + [x.split()[0] for x in FEATURES.split(", ")]
        yield pa.RecordBatch.from_arrays(kept + [pa.array(x.astype(np.int64)) for x in found], names=names)


def rule_features(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source") -> DataFrame:
    """doc_id, host and the five counts of each row."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(host_col).cast("string").alias("host"),
                       F.col(text_col).alias("text"))
    kind = dict(rows.dtypes)["doc_id"]
    return arrow_map(rows, _features, f"doc_id {kind}, host string, {FEATURES}")


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))


def host_rates(judged: DataFrame) -> DataFrame:
    """host, n_docs, n_failed and host_rate: the posterior mean under the prior fitted to all hosts.

    The prior has the mean m of all documents and the strength that makes the
    spread of the hosts' rates, less the spread that chance alone gives, its
    variance. It needs three sums over the hosts, which come back as one row.
    """
    hosts = judged.groupBy("host").agg(F.count(F.lit(1)).alias("n_docs"),
                                       F.sum(F.col("base_failed").cast("long")).alias("n_failed"))
    sums = hosts.agg(F.sum("n_docs").alias("n"), F.sum("n_failed").alias("f"), F.count(F.lit(1)).alias("h"),
                     F.sum(F.col("n_failed") * F.col("n_failed") / F.col("n_docs")).alias("sq")).first()
    mean = strength = 0.0
    if sums["n"]:
        mean = sums["f"] / sums["n"]
        noise = mean * (1 - mean)
        spread = sums["sq"] / sums["n"] - mean * mean - noise * sums["h"] / sums["n"]
        strength = min(max(noise / spread - 1, MIN_STRENGTH), MAX_STRENGTH) if spread > 1e-12 else MAX_STRENGTH
    return hosts.withColumn(
        "host_rate", (F.lit(mean * strength) + F.col("n_failed")) / (F.lit(strength) + F.col("n_docs")))


def judge_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source",
                    max_host_rate: float = MAX_HOST_RATE) -> DataFrame:
    """One row per document: the counts, base_failed, host_rate, host_failed and kept."""
    judged = written(rule_features(docs, id_col, text_col, host_col).withColumn("base_failed", base_failed()),
                     "host_rules")
    rates = host_rates(judged).select(F.col("host").alias("of_host"), "host_rate",
                                      (F.col("host_rate") >= max_host_rate).alias("host_failed"))
    joined = judged.join(rates, F.col("host").eqNullSafe(F.col("of_host")), "left").drop("of_host")
    return joined.withColumn("kept", ~F.col("base_failed") & ~F.col("host_failed"))
