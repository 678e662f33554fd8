"""Class-based bigram language model (Brown): exchange clustering, class transitions, word emissions.

Tokens are the ASCII lower-cased words of a text, then one end. The model is
P(word | previous) = P(class | previous class) * P(word | class).

Every word of the training texts gets a class by exchange. First the
``SYMBOLS`` most frequent words are clustered: they are symbols of their own,
the other words stand in as symbols of their endings, and in each round Spark
aggregates, for every symbol, its neighbours' classes on both sides; half of
the symbols in turn go to the class that gives their tokens the highest
probability, as long as the likelihood of the corpus rises. Then every other
word, however rare, goes to the class of the highest gain by the same rule:
Spark counts the classes before and after it (one row per word and pair of
classes) and takes the best class. The steps between classes are counted anew
with the classes of all words. Endings give a class to words that the training
texts do not have.

The driver holds tables of symbols by classes and of classes by classes, whose
size does not depend on the corpus, and the listed words: the most frequent
ones, at most ``LISTED_WORDS`` (words of nearly equal counts are listed all or
none). Tasks look listed words up in a broadcast table of at most 18 bytes a
word; the others, of which none is more than about 1 / ``LISTED_WORDS`` of the
training tokens, are joined with the table of all words and their classes. The
scores do not depend on which words are listed.

Smoothing: transitions are interpolated with the class frequencies, emissions
add half a count to each word of the class and to one unseen word for each
word ending in it.

Defined results: a null or empty text is its end alone; rows with the same id
and text get equal scores; without training texts every word is unseen; a row
with a null id trains the model.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from ..session import work_dir
from .shared import arrow_map, settings, written
from .text import Texts, signed, span_hashes, text_slices

SYMBOLS = 2048
ENDINGS = 256
ENDING_BYTES = 3
CLASSES = 64
ROUNDS = 6
LISTED_WORDS = 1 << 20
PER_OCTAVE = 8  # counts are told apart by so many steps for each doubling, where the list is cut
HELD_ROWS = 1 << 20  # counts that a task sums before it passes them on
BACKOFF = 4.0  # weight, in tokens, of the class frequencies in a transition

FIRST_ENDING = SYMBOLS  # symbols from here on are word endings
END = SYMBOLS + ENDINGS
N_SYMBOLS = END + 1
END_CLASS = CLASSES  # the end has a class of its own
STEPS = CLASSES + 1


@dataclass
class Tokens:
    """The words of some texts: hashes (as Spark longs), rows, and where they stand."""

    texts: Texts
    starts: np.ndarray
    ends: np.ndarray
    words: np.ndarray
    rows: np.ndarray

    def endings(self, which: np.ndarray) -> np.ndarray:
        """The numbers of the endings of some words."""
        ends = self.ends[which]
        tails = span_hashes(self.texts.data, np.maximum(self.starts[which], ends - ENDING_BYTES), ends, lower=True)
        return (tails % np.uint64(ENDINGS)).astype(np.int64)


def _tokens(texts: Texts) -> Tokens:
    starts, ends = texts.word_spans()
    rows = np.repeat(np.arange(texts.rows), np.diff(np.searchsorted(starts, texts.offsets)))  # starts are in order
    return Tokens(texts, starts, ends, signed(span_hashes(texts.data, starts, ends, lower=True)), rows)


class Places:
    """Where hashes stand in a sorted list of distinct ones: their leading bits tell the few places to look at."""

    def __init__(self, keys: np.ndarray):
        self.keys, self.shift = keys, np.uint64(64 - max(1, len(keys).bit_length()))
        part = self._part(keys)
        self.first = np.searchsorted(part, np.arange((1 << (64 - int(self.shift))) + 1))

    def _part(self, keys: np.ndarray) -> np.ndarray:
        # with the sign bit turned, hashes stand in the order of their bits
        return ((keys.view(np.uint64) ^ np.uint64(1 << 63)) >> self.shift).astype(np.int64)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """The place of each key, or -1."""
        out, part = np.full(len(keys), -1, np.int64), self._part(keys)
        at, end, left = self.first[part], self.first[part + 1], np.arange(len(keys))
        while len(left):
            open_ = at < end
            left, at, end = left[open_], at[open_], end[open_]
            here = self.keys[at]
            same = here == keys[left]
            out[left[same]] = at[same]
            more = here < keys[left]
            left, at, end = left[more], at[more] + 1, end[more]
        return out


_ODD = np.uint64(0x9E3779B97F4A7C15)


def _summed(columns: list[np.ndarray], n: np.ndarray | None = None, lead: int = 0) -> tuple[list[np.ndarray], np.ndarray]:
    """The rows of some columns, each once, and the sums of ``n`` (by default, how often each occurs).

    With ``lead`` they come in the order of the first column, a number of so many bits.

    Equal rows are found by a hash. Rows of one hash that differ may stand in
    turns, so that a row comes several times, its count parted: sums stay right.
    """
    key = columns[0] if len(columns) == 1 else columns[0].astype(np.int64).view(np.uint64)
    for c in columns[1:]:
        key = (key ^ (key >> np.uint64(29))) * _ODD + c.astype(np.int64).view(np.uint64)
    if len(columns) > 1:
        key = (key ^ (key >> np.uint64(32))) * _ODD
    if lead:
        key = columns[0].astype(np.uint64) << np.uint64(64 - lead) | key >> np.uint64(lead)
    order = np.argsort(key)
    ordered = [c[order] for c in columns]
    new = np.zeros(len(order), bool)
    new[:1] = True
    for c in ordered:
        new[1:] |= c[1:] != c[:-1]
    first = np.flatnonzero(new)
    if n is None:
        return [c[first] for c in ordered], np.diff(np.r_[first, len(order)])
    return [c[first] for c in ordered], np.add.reduceat(n[order], first) if len(first) else n


def _task_sums(slices, names: list[str], types: list[pa.DataType]):
    """Batches of the summed rows (columns, n) of a task's slices, of up to ``HELD_ROWS`` rows at a time."""
    held, rows = [], 0

    def together():
        columns = [np.concatenate([x[0][i] for x in held]) for i in range(len(names) - 1)]
        return _summed(columns, np.concatenate([x[1] for x in held]))

    def batch(columns, n):
        return pa.RecordBatch.from_arrays([*(pa.array(c, t) for c, t in zip(columns, types)), pa.array(n, types[-1])], names=names)

    for columns, n in slices:
        held.append((columns, n))
        rows += len(n)
        if rows > HELD_ROWS:
            held = [together()]
            rows = len(held[0][1])
            if rows > HELD_ROWS // 2:
                yield batch(*held[0])
                held, rows = [], 0
    if held:
        yield batch(*together())


def _word_counts(batches):
    found = (_summed([_tokens(texts).words]) for _, texts in text_slices(batches))
    yield from _task_sums(found, ["word", "n"], [pa.int64(), pa.int64()])


def _chains(symbols: np.ndarray, rows: np.ndarray, n: int, end: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Previous and next symbol of every step, and its row: each row's symbols, opened and closed by the end.

    The step that leads to word i is number i + its row.
    """
    count = np.bincount(rows, minlength=n)
    after = np.full(len(symbols) + n, end, np.int64)
    after[np.arange(len(symbols)) + rows] = symbols
    before = np.full(len(after), end, np.int64)
    before[1:] = after[:-1]
    return before, after, np.repeat(np.arange(n), count + 1)


@dataclass
class Words:
    """The words that have a symbol of their own, by hash."""

    keys: np.ndarray
    symbols: np.ndarray

    @cached_property
    def places(self) -> Places:
        return Places(self.keys)

    def symbols_of(self, tokens: Tokens) -> np.ndarray:
        at = self.places.find(tokens.words)
        out = self.symbols[at] if len(self.symbols) else np.zeros(len(at), np.int64)
        other = np.flatnonzero(at < 0)
        out[other] = FIRST_ENDING + tokens.endings(other)
        return out


def _bigram_counts(known: Words):
    def found(batches):
        for _, texts in text_slices(batches):
            tokens = _tokens(texts)
            before, after, _ = _chains(known.symbols_of(tokens), tokens.rows, texts.rows, END)
            (pairs,), n = _summed([before * N_SYMBOLS + after])
            yield [pairs // N_SYMBOLS, pairs % N_SYMBOLS], n

    def run(batches):
        yield from _task_sums(found(batches), ["a", "b", "n"], [pa.int32(), pa.int32(), pa.int64()])
    return run


def _neighbours(bigrams: DataFrame, classes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Symbols by classes: how often a class follows each symbol, and how often it precedes it."""
    spark = bigrams.sparkSession
    of = spark.createDataFrame([(i, int(c)) for i, c in enumerate(classes)], "symbol int, class int")
    out = []
    for symbol, other in (("a", "b"), ("b", "a")):
        rows = bigrams.join(of, bigrams[other] == of["symbol"]).groupBy(symbol, "class").agg(F.sum("n").alias("n"))
        found = rows.toArrow()  # at most N_SYMBOLS * STEPS rows
        table = np.zeros((N_SYMBOLS, STEPS))
        table[found.column(symbol).to_numpy(), found.column("class").to_numpy()] = found.column("n").to_numpy()
        out.append(table)
    return out[0], out[1]


def _by_class(table: np.ndarray, classes: np.ndarray) -> np.ndarray:
    out = np.zeros((STEPS, table.shape[1]))
    np.add.at(out, classes, table)
    return out


def _likelihood(steps: np.ndarray) -> float:
    """Log-likelihood of the corpus, up to a term that classes do not change."""
    def part(x):
        x = x[x > 0]
        return float((x * np.log(x)).sum())

    return part(steps) - part(steps.sum(axis=1)) - part(steps.sum(axis=0))


class Gains:
    """What each class would give the tokens of a word, from the classes before and after them."""

    def __init__(self, steps: np.ndarray):
        total = steps.sum(axis=0)
        smooth = (steps + (total + 0.5) / (total.sum() + 0.5 * len(total))) / (steps.sum(axis=1, keepdims=True) + 1)
        self.step, self.size = np.log(smooth), np.log(total + 1)

    def best(self, precede: np.ndarray, follow: np.ndarray) -> np.ndarray:
        """The class of the highest gain (the lowest of equals), never that of the end."""
        gain = precede @ self.step + follow @ self.step.T - precede.sum(axis=1)[:, None] * self.size
        return gain[:, :CLASSES].argmax(axis=1)


def exchange(bigrams: DataFrame, rounds: int = ROUNDS) -> tuple[np.ndarray, np.ndarray]:
    """The class of every symbol, and the counts of class steps. Ends after two rounds, one for each half, without a gain."""
    classes = np.arange(N_SYMBOLS) % CLASSES
    classes[END] = END_CLASS
    follow, precede = _neighbours(bigrams, classes)
    steps = _by_class(follow, classes)
    best, failed = _likelihood(steps), 0
    for turn in range(rounds):
        count = precede.sum(axis=1)
        moved = classes.copy()
        own = np.flatnonzero((np.arange(END) % 2 == turn % 2) & (count[:END] > 0))
        moved[own] = Gains(steps).best(precede[own], follow[own])
        trial = _neighbours(bigrams, moved)
        after = _by_class(trial[0], moved)
        if _likelihood(after) > best:
            classes, (follow, precede), steps, best, failed = moved, trial, after, _likelihood(after), 0
        else:
            failed += 1
            if failed == 2:
                break
    return classes, steps


def _contexts(known: Words, classes: np.ndarray):
    """Of the words without a symbol: the classes before and after them, as one number, with counts."""
    def found(batches):
        for _, texts in text_slices(batches):
            tokens = _tokens(texts)
            symbols = known.symbols_of(tokens)
            before, after, _ = _chains(classes[symbols], tokens.rows, texts.rows, END_CLASS)
            rest = np.flatnonzero(symbols >= FIRST_ENDING)
            step = rest + tokens.rows[rest]
            yield _summed([tokens.words[rest], before[step] * STEPS + after[step + 1]])

    def run(batches):
        yield from _task_sums(found(batches), ["word", "context", "n"], [pa.int64(), pa.int32(), pa.int64()])
    return run


def _best_classes(gains: Gains):
    """The class of each word from its contexts."""
    def run(batches):
        for batch in batches:
            words = batch.num_rows
            found = batch.column("contexts")
            each = np.repeat(np.arange(words), np.diff(found.offsets.to_numpy()))
            context, n = (found.flatten().field(x).to_numpy(zero_copy_only=False) for x in ("context", "n"))
            precede, follow = (np.bincount(each * STEPS + c, weights=n, minlength=words * STEPS).reshape(words, STEPS)
                               for c in (context // STEPS, context % STEPS))
            yield pa.RecordBatch.from_arrays(
                [batch.column("word"), pa.array(gains.best(precede, follow).astype(np.int32)),
                 pa.array(precede.sum(axis=1).astype(np.int64))], names=["word", "class", "n"])
    return run


def _assigned(rows: DataFrame, known: Words, classes: np.ndarray, steps: np.ndarray) -> DataFrame:
    """word, class and n of every word without a symbol of its own.

    Dealt by word once; a word beyond the symbols holds at most 1 / symbols of
    the tokens, and is a list of at most STEPS * STEPS contexts by then.
    """
    found = arrow_map(rows, _contexts(known, classes), "word long, context int, n long")
    counted = found.repartition("word").groupBy("word", "context").agg(F.sum("n").alias("n"))
    of_word = counted.groupBy("word").agg(F.collect_list(F.struct("context", "n")).alias("contexts"))
    return arrow_map(of_word, _best_classes(Gains(steps)), "word long, class int, n long")


@dataclass
class ClassModel:
    listed: np.ndarray  # hashes of the frequent words, in order
    listed_counts: np.ndarray
    listed_classes: np.ndarray
    ending_classes: np.ndarray  # of unseen words, by ending
    steps: np.ndarray  # log10 P(class | previous class)
    room: np.ndarray  # by class: tokens, plus half a count for every word and unseen word
    tokens: int
    distinct: int
    ends: int

    @cached_property
    def places(self) -> Places:
        return Places(self.listed)

    @property
    def base_room(self) -> float:
        return self.tokens + 0.5 * (self.distinct + 1)

    def classed(self, tokens: Tokens) -> tuple[np.ndarray, np.ndarray]:
        """The place of each word in the list, or -1, and its class: that of its ending if it is not listed."""
        at = self.places.find(tokens.words)
        out = self.listed_classes[at] if len(self.listed) else np.zeros(len(at), np.int16)
        rest = np.flatnonzero(at < 0)
        out[rest] = self.ending_classes[tokens.endings(rest)]
        return at, out


_SIDES = "a_word long, a_class int, b_word long, b_class int, times long"
_SIDE_NAMES = ["a_word", "a_class", "b_word", "b_class", "times"]


def _steps(model: ClassModel, tokens: Tokens, at: np.ndarray, classes: np.ndarray, rows: int):
    """Every step's classes, its row, and the number of the unlisted token (else -1) on either side."""
    before, after, row = _chains(classes, tokens.rows, rows, END_CLASS)
    a, b, _ = _chains(np.where(at < 0, np.arange(len(at)), -1), tokens.rows, rows, -1)
    return before, after, row, a, b


def _open_columns(tokens: Tokens, row: np.ndarray, before, after, a, b) -> tuple[np.ndarray, list[pa.Array]]:
    """The distinct steps of each row with their rows: a_word (null if listed), a_class, b_word, b_class, times."""
    words = tokens.words if len(tokens.words) else np.zeros(1, np.int64)
    kind = ((a < 0) * 2 + (b < 0)) * STEPS * STEPS + before * STEPS + after
    (row, kind, a, b), times = _summed([row, kind, *(np.where(x < 0, 0, words[np.maximum(x, 0)]) for x in (a, b))], lead=20)
    listed, kind = np.divmod(kind, STEPS * STEPS)
    return row, [pa.array(a, mask=listed >= 2), pa.array((kind // STEPS).astype(np.int32)),
                 pa.array(b, mask=listed % 2 == 1), pa.array((kind % STEPS).astype(np.int32)), pa.array(times)]


def _all_steps(shared):
    """The steps of all texts, counted."""
    def run(batches):
        m: ClassModel = shared.value
        for _, texts in text_slices(batches):
            tokens = _tokens(texts)
            before, after, _, a, b = _steps(m, tokens, *m.classed(tokens), texts.rows)
            is_open = (a >= 0) | (b >= 0)
            times = np.bincount(before[~is_open] * STEPS + after[~is_open], minlength=STEPS * STEPS)
            pair = np.flatnonzero(times)
            none = pa.nulls(len(pair), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [none, pa.array((pair // STEPS).astype(np.int32)), none, pa.array((pair % STEPS).astype(np.int32)),
                 pa.array(times[pair])], names=_SIDE_NAMES)
            sides = [x[is_open] for x in (before, after, a, b)]
            _, columns = _open_columns(tokens, np.zeros(len(sides[0]), np.int64), *sides)
            yield pa.RecordBatch.from_arrays(columns, names=_SIDE_NAMES)
    return run


def _with_classes(steps: DataFrame, vocabulary: DataFrame) -> DataFrame:
    """The steps with the classes of their words, and the count n of the word that the step leads to.

    A step without a word on a side is dealt by its other columns: nulls do not pile up in one task.
    """
    others = F.xxhash64(*steps.columns)
    for side in ("a", "b"):
        of = vocabulary.select(F.col("word").alias("of_word"), F.col("class").alias("of_class"), F.col("n").alias("of_n"))
        found = steps.withColumn("of_key", F.coalesce(f"{side}_word", others)).join(
            of, F.col("of_key") == F.col("of_word"), "left")
        has = F.col(f"{side}_word").isNotNull()
        steps = found.withColumn(f"{side}_class", F.when(has, F.coalesce("of_class", f"{side}_class")).otherwise(
            F.col(f"{side}_class"))).withColumn("n", F.when(has, F.col("of_n"))).drop("of_key", "of_word", "of_class", "of_n")
    return steps


def _counted_steps(rows: DataFrame, model: ClassModel, vocabulary: DataFrame) -> np.ndarray:
    """How often each class follows each other, by the classes of all words."""
    shared = rows.sparkSession.sparkContext.broadcast(model)
    steps = arrow_map(rows, _all_steps(shared), _SIDES)
    found = _with_classes(steps, vocabulary).groupBy("a_class", "b_class").agg(F.sum("times").alias("n")).toArrow()
    out = np.zeros((STEPS, STEPS))  # at most STEPS * STEPS rows
    out[found.column("a_class").to_numpy(), found.column("b_class").to_numpy()] = found.column("n").to_numpy()
    return out


def transitions(steps: np.ndarray) -> np.ndarray:
    """log10 P(class | previous class) from the counts of steps, interpolated with the class frequencies."""
    arrivals = steps.sum(axis=0)
    share = (arrivals + 0.5) / (arrivals + 0.5).sum()
    return np.log10((steps + BACKOFF * share) / (steps.sum(axis=1, keepdims=True) + BACKOFF))


def train(texts: DataFrame, text_col: str = "text", symbols: int = SYMBOLS) -> tuple[ClassModel, DataFrame]:
    """The model and the table of all words (word, class, n); at most SYMBOLS words are clustered as ``symbols``."""
    spark, rows = texts.sparkSession, texts.select(F.col(text_col).alias("text"))
    counts = written(arrow_map(rows, _word_counts, "word long, n long").groupBy("word").agg(F.sum("n").alias("n")), "word_counts")
    ends = rows.count()
    first = counts.orderBy(F.desc("n"), "word").limit(min(symbols, SYMBOLS)).toArrow()
    word, n = (first.column(x).to_numpy() for x in ("word", "n"))
    by_hash = np.argsort(word)
    known = Words(word[by_hash], by_hash)
    bigrams = written(arrow_map(rows, _bigram_counts(known), "a int, b int, n long").groupBy("a", "b").agg(
        F.sum("n").alias("n")), "bigrams")
    classes, steps = exchange(bigrams)

    own = spark.createDataFrame([(int(w), int(classes[i]), int(k)) for i, (w, k) in enumerate(zip(word, n))],
                                "word long, class int, n long")
    vocabulary = written(_assigned(rows, known, classes, steps).union(own), "vocabulary")
    of_class = vocabulary.groupBy("class").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("words")).collect()
    room = np.zeros(STEPS)
    for r in of_class:  # one row per class
        room[r["class"]] = r["n"] + 0.5 * r["words"]
    ending_classes = classes[FIRST_ENDING:END]
    np.add.at(room, ending_classes, 0.5)  # an unseen word for each ending
    total, distinct = sum(r["n"] for r in of_class), sum(r["words"] for r in of_class) + (ends > 0)

    size = F.floor(F.log2("n") * PER_OCTAVE)
    least, room_left = None, LISTED_WORDS
    for r in sorted(vocabulary.groupBy(size.alias("size")).count().collect(), reverse=True):  # PER_OCTAVE rows a doubling
        room_left -= r["count"]
        if room_left < 0:
            break
        least = r["size"]
    top = vocabulary.filter(F.lit(False) if least is None else size >= least).toArrow()  # at most LISTED_WORDS rows
    order = np.argsort(top.column("word").to_numpy())
    listed, of, count = (top.column(x).to_numpy()[order] for x in ("word", "class", "n"))
    model = ClassModel(listed, count, of.astype(np.int16), ending_classes.astype(np.int16), transitions(steps), room, int(total + ends),
                       int(distinct), int(ends))
    model.steps = transitions(_counted_steps(rows, model, vocabulary))
    return model, vocabulary


_PART, _STEP = 0, 1  # a row for each text; a row for each of its steps from or to words that are not listed


def _row_scores(schema: pa.Schema, shared):
    """Of each row: the steps between listed words and ends, and the listed words themselves; then its other steps, with their counts."""
    def rows_of(values: dict) -> pa.RecordBatch:
        n = len(values["doc_id"])
        return pa.RecordBatch.from_arrays([values[f.name] if f.name in values else pa.nulls(n, f.type) for f in schema], schema=schema)

    def run(batches):
        m: ClassModel = shared.value
        for part, texts in text_slices(batches):
            tokens = _tokens(texts)
            rows = tokens.rows
            at, classes = m.classed(tokens)
            before, after, of_step, a, b = _steps(m, tokens, at, classes, texts.rows)
            weights = np.where((a < 0) & (b < 0), m.steps[before, after], 0.0)
            score = np.bincount(of_step, weights=weights, minlength=texts.rows)
            known = at >= 0
            n, mine = m.listed_counts[at[known]] + 0.5, rows[known]
            score += np.bincount(mine, weights=np.log10(n / m.room[classes[known]]), minlength=texts.rows)
            base = np.bincount(mine, weights=np.log10(n / m.base_room), minlength=texts.rows)
            base = base + np.log10((m.ends + 0.5) / m.base_room)
            count = np.bincount(rows, minlength=texts.rows)
            found = np.bincount(mine, minlength=texts.rows)
            yield rows_of({
                "doc_id": part.column("doc_id"), "text_hash": part.column("text_hash"), "n_tokens": pa.array(count + 1),
                "n_listed": pa.array(found + (m.ends > 0)), "n_rare": pa.array(count - found), "base_part": pa.array(base),
                "score_part": pa.array(score), "kind": pa.array(np.full(texts.rows, _PART, np.int32))})
            is_open = (a >= 0) | (b >= 0)
            row, columns = _open_columns(tokens, of_step[is_open], *(x[is_open] for x in (before, after, a, b)))
            take = pa.array(row)
            yield rows_of({"doc_id": part.column("doc_id").take(take), "text_hash": part.column("text_hash").take(take),
                           **dict(zip(_SIDE_NAMES, columns)), "kind": pa.array(np.full(len(row), _STEP, np.int32))})
    return run


def _written_scores(rows: DataFrame, shared) -> tuple[DataFrame, DataFrame]:
    """The two kinds of rows of ``_row_scores``, from one reading of the texts."""
    spark, path = rows.sparkSession, work_dir(rows.sparkSession, "llm", "row_scores")
    ids = f"doc_id {dict(rows.dtypes)['doc_id']}, text_hash long"
    sums = "n_tokens long, n_listed long, n_rare long, base_part double, score_part double"
    schema = spark.createDataFrame([], f"{ids}, {sums}, {_SIDES}, kind int").schema
    found = arrow_map(rows, _row_scores(to_arrow_schema(schema), shared), schema)
    with settings(spark, {"spark.sql.maxConcurrentOutputFileWriters": "4"}):  # both kinds side by side, without a sort
        found.write.partitionBy("kind").parquet(path)
    every = spark.read.schema(schema).parquet(path)
    return (every.filter(F.col("kind") == _PART).select("doc_id", "text_hash", "n_tokens", "n_listed", "n_rare", "base_part", "score_part"),
            every.filter(F.col("kind") == _STEP).select("doc_id", "text_hash", *_SIDE_NAMES))


def _step_table(spark: SparkSession, model: ClassModel) -> DataFrame:
    """log10 P(class | previous class) and the room of the class, a row for each pair of classes."""
    return spark.createDataFrame(
        [(a, b, float(model.steps[a, b]), float(model.room[b])) for a in range(STEPS) for b in range(STEPS)],
        "from_class int, to_class int, step double, room double")


def _log_share(n: Column, room: Column) -> Column:
    return F.log10((F.coalesce(n, F.lit(0)) + 0.5) / room)


def score_texts(docs: DataFrame, model: ClassModel, vocabulary: DataFrame, id_col: str = "doc_id",
                text_col: str = "text") -> DataFrame:
    """One row per text: doc_id, n_tokens, n_known, train_tokens, base_score (unigrams) and score (the class model)."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(model)  # at most LISTED_WORDS words
    rows = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(text_col).alias("text_hash"),
                       F.col(text_col).alias("text"))
    parts, rare = _written_scores(rows, shared)
    steps = _with_classes(rare, vocabulary).join(
        F.broadcast(_step_table(spark, model)),  # STEPS * STEPS rows
        (F.col("a_class") == F.col("from_class")) & (F.col("b_class") == F.col("to_class")))
    is_rare, times = F.col("b_word").isNotNull(), F.col("times")
    sums = steps.groupBy("doc_id", "text_hash").agg(
        F.sum(F.when(is_rare, times).otherwise(0)).alias("all_rare"),
        F.sum(F.when(is_rare & F.col("n").isNotNull(), times).otherwise(0)).alias("seen"),
        F.sum(F.when(is_rare, times * _log_share(F.col("n"), F.lit(model.base_room))).otherwise(0.0)).alias("base_rare"),
        F.sum(times * (F.col("step") + F.when(is_rare, _log_share(F.col("n"), F.col("room"))).otherwise(0.0))).alias("score_rare"))
    sums = sums.withColumnsRenamed({"doc_id": "of_id", "text_hash": "of_hash"})
    joined = parts.join(sums, F.col("doc_id").eqNullSafe(F.col("of_id")) & (F.col("text_hash") == F.col("of_hash")), "left")
    # rows with the same id and text were summed together
    share = F.coalesce(F.col("n_rare") / F.col("all_rare"), F.lit(0.0))
    return joined.select(
        "doc_id", "n_tokens", (F.col("n_listed") + F.coalesce(F.round(share * F.col("seen")), F.lit(0))).cast("long").alias("n_known"),
        F.lit(model.tokens).cast("long").alias("train_tokens"),
        (F.col("base_part") + F.coalesce(share * F.col("base_rare"), F.lit(0.0))).alias("base_score"),
        (F.col("score_part") + F.coalesce(share * F.col("score_rare"), F.lit(0.0))).alias("score"))
