"""Language identification with a string kernel, Nystroem landmarks and one-versus-rest kernel ridge regression.

The kernel of two texts is the blended-spectrum presence kernel: the number of
distinct n-grams of 1 to ``MAX_ORDER`` lower-cased characters that both hold,
divided by the geometric mean of their own numbers. n-grams are hashed to
``2 ** BITS`` bins.

The classifier is fitted on a bounded sample of labelled texts: about
``max_train`` texts in all, the same number for every language (drawn by a
seeded hash of the id). ``landmarks`` of them, dealt evenly to the languages,
span the Nystroem subspace. The driver sees the sampled texts' bins only.

A text's scores are its kernel row against the landmarks times the dual
coefficients. As the kernel is a product of presence vectors, the landmarks'
vectors and the coefficients are multiplied once, into a matrix of bins by
languages; each batch of texts is then one sparse presence matrix times it.

Defined results: a text that is null or holds no letter is ``und`` with score
0, and so is every text if nothing can be learned; ties go to the first
language in code point order; repeated rows get equal results.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .shared import arrow_map, bound_batches
from .text import lists, release, text_slices

MAX_ORDER = 4
BITS = 18
MAX_TRAIN = 2048
LANDMARKS = 192
RIDGE = 1e-2
SEED = 7
UNKNOWN = "und"
_ODD = np.uint64(0x9E3779B97F4A7C15)
_PIECE = 1 << 20  # characters at a time
BATCH = 128  # texts in a batch
_COLUMNS = 1 << 13  # bins multiplied at a time


def present_bins(text: str, seen: np.ndarray) -> np.ndarray:
    """The bins of all n-grams of a text, in order; ``seen`` is a scratch array of zeros."""
    chars = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    for first in range(0, len(chars), _PIECE):
        piece = chars[first: first + _PIECE + MAX_ORDER - 1].astype(np.uint64) + np.uint64(1)
        key = np.zeros(len(piece), np.uint64)
        for order in range(min(MAX_ORDER, len(piece))):
            key = (key[: len(piece) - order] ^ piece[order:]) * _ODD
            key ^= key >> np.uint64(29)
            seen[((key * _ODD) >> np.uint64(64 - BITS)).astype(np.int64)] = True
    bins = np.flatnonzero(seen)
    seen[bins] = False
    return bins


def has_letter(text: str) -> bool:
    return any(map(str.isalpha, text))


@dataclass
class LanguageModel:
    languages: list[str]
    weights: np.ndarray  # bins by languages

    def scores(self, texts: list[str]) -> np.ndarray:
        """Texts by languages: the presence matrix of each batch (as bins and row starts) times the weights."""
        seen = np.zeros(1 << BITS, bool)
        out = np.zeros((len(texts), len(self.languages)))
        for first in range(0, len(texts), BATCH):
            bins = [present_bins(t, seen) for t in texts[first: first + BATCH]]
            sizes = np.array([len(b) for b in bins])
            filled = np.flatnonzero(sizes)
            if len(filled):
                starts = np.r_[0, np.cumsum(sizes[filled])[:-1]]
                sums = np.add.reduceat(self.weights[np.concatenate(bins)], starts, axis=0, dtype=np.float64)
                out[first + filled] = sums / np.sqrt(sizes[filled])[:, None]
        return out


def fit(bins: list[np.ndarray], labels: list[str], landmarks: int = LANDMARKS, ridge: float = RIDGE) -> LanguageModel:
    """Kernel ridge regression in the span of the landmarks: the first texts of each language in turn."""
    languages = sorted(set(labels))
    if not languages:
        return LanguageModel([], np.zeros((1 << BITS, 0), np.float32))
    turn = {x: 0 for x in languages}
    order = []
    for i, label in enumerate(labels):
        order.append((turn[label], label, i))
        turn[label] += 1
    chosen = [i for _, _, i in sorted(order)[:landmarks]]
    columns, place = np.unique(np.concatenate([bins[i] for i in chosen]), return_inverse=True)
    marks = np.zeros((len(chosen), len(columns)), np.float32)
    at = 0
    for row, i in enumerate(chosen):
        marks[row, place[at: at + len(bins[i])]] = 1 / np.sqrt(len(bins[i]))
        at += len(bins[i])
    kernel = np.zeros((len(bins), len(chosen)))
    where = np.full(1 << BITS, -1, np.int64)
    where[columns] = np.arange(len(columns))
    for i, b in enumerate(bins):
        own = where[b]
        kernel[i] = marks[:, own[own >= 0]].sum(axis=1) / np.sqrt(len(b))
    of_marks = (marks @ marks.T).astype(np.float64)
    targets = np.array([[float(label == x) for x in languages] for label in labels])
    balance = 1.0 / np.maximum(targets.sum(axis=0), 1)  # every language counts alike
    weight = (targets * balance).sum(axis=1)[:, None] * len(labels) / len(languages)
    left = kernel.T @ (kernel * weight) + ridge * len(bins) * (of_marks + 1e-8 * np.eye(len(chosen)))
    dual = np.linalg.solve(left, kernel.T @ (targets * weight))
    weights = np.zeros((1 << BITS, len(languages)), np.float32)
    for first in range(0, len(columns), _COLUMNS):  # the product takes its factors as doubles
        weights[columns[first: first + _COLUMNS]] = marks[:, first: first + _COLUMNS].T @ dual
    return LanguageModel(languages, weights)


def _bins_of_rows(batches):
    seen = np.zeros(1 << BITS, bool)
    for part, _ in text_slices(batches):
        bins = [present_bins(t, seen).astype(np.int32) for t in part.column("text").to_pylist()]
        names = [x for x in part.schema.names if x != "text"]
        flat = pa.array(np.concatenate(bins) if bins else np.zeros(0, np.int32))
        yield pa.RecordBatch.from_arrays([*(part.column(x) for x in names), lists(flat, [len(b) for b in bins])],
                                         names=[*names, "bins"])


def train(labelled: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
          max_train: int = MAX_TRAIN, landmarks: int = LANDMARKS, seed: int = SEED) -> LanguageModel:
    """Fit on a seeded sample of at most ``max_train`` rows that have a text with a letter and a label."""
    rows = labelled.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"),
                           F.col(lang_col).cast("string").alias("lang")).filter(
        F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}"))
    counts = {r["lang"]: r["count"] for r in rows.groupBy("lang").count().collect()}  # one row per language
    if not counts:
        return fit([], [])
    each = max(1, max_train // len(counts))
    draw = F.pmod(F.xxhash64(F.lit(seed), F.col("id").cast("string"), "text"), F.lit(1 << 40)) / float(1 << 40)
    chance = F.create_map(*[F.lit(x) for lang, n in counts.items() for x in (lang, min(1.0, each / n))])
    sample = rows.withColumn("draw", draw).filter(F.col("draw") < F.element_at(chance, F.col("lang")))
    drawn = arrow_map(sample, _bins_of_rows, f"id {dict(rows.dtypes)['id']}, lang string, draw double, bins array<int>")
    model = fit(*_in_order(drawn.select("lang", "draw", "bins").toArrow()), landmarks)
    release()
    return model


def _in_order(drawn: pa.Table) -> tuple[list[np.ndarray], list[str]]:
    """Bins and labels of the sample, by draw, label and bins: about ``max_train`` rows of at most 2 ** BITS bins.

    They stay arrays: as Python numbers the driver would hold nine times as much.
    """
    bins = [x.values.to_numpy().astype(np.int32, copy=False) for x in drawn.column("bins")]
    labels, draws = drawn.column("lang").to_pylist(), drawn.column("draw").to_pylist()
    # of numbers above zero the order of the lists is that of their bytes, highest first
    order = sorted(range(len(bins)), key=lambda i: (draws[i], labels[i], bins[i].astype(">i4").tobytes()))
    return [bins[i] for i in order], [labels[i] for i in order]


def language_of(spark: SparkSession, model: LanguageModel, text: Column) -> Column:
    """A struct of lang_pred and score (the winning regression value, held to 0 to 1)."""
    bound_batches(spark)
    shared = spark.sparkContext.broadcast(model)  # 2 ** BITS rows by languages, whatever the corpus

    @F.pandas_udf("lang_pred string, score double")
    def classify(texts: pd.Series) -> pd.DataFrame:
        known = shared.value
        texts = texts.fillna("").to_numpy(object)
        spoken = np.array([bool(known.languages) and has_letter(t) for t in texts], bool)
        names, scores = np.full(len(texts), UNKNOWN, object), np.zeros(len(texts))
        if spoken.any():
            found = known.scores(list(texts[spoken]))
            best = found.argmax(axis=1)
            names[spoken] = np.array(known.languages, object)[best]
            scores[spoken] = np.clip(found[np.arange(len(best)), best], 0, 1)
        release()
        return pd.DataFrame({"lang_pred": names, "score": scores})

    return classify(text)


def predict(docs: DataFrame, model: LanguageModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, lang_pred and score of every row."""
    found = docs.select(F.col(id_col).alias("doc_id"), language_of(docs.sparkSession, model, F.col(text_col)).alias("found"))
    return found.select("doc_id", "found.lang_pred", "found.score")
