import collections
import math
import random
import re

import numpy as np
import pyarrow as pa
import pytest

from martforge.llm import class_lm as C
from martforge.llm.text import text_array

from .conftest import rows_of, sample_rows

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def tokens(text):
    return WORD.findall((text or "").translate({i: i + 32 for i in range(65, 91)})) + [None]


def check_base(scored, train_texts, rows):
    count = collections.Counter(t for text in train_texts for t in tokens(text))
    total, distinct = sum(count.values()), len(count)
    assert len(scored) == len(rows)
    for r, (doc_id, text) in zip(sorted(scored, key=lambda r: repr((r["doc_id"], r["n_tokens"]))),
                                 sorted(rows, key=lambda r: repr((r[0], len(tokens(r[1])))))):
        own = tokens(text)
        base = sum(math.log10((count[t] + 0.5) / (total + 0.5 * (distinct + 1))) for t in own)
        assert (r["doc_id"], r["n_tokens"], r["train_tokens"]) == (doc_id, len(own), total)
        assert r["n_known"] == sum(count[t] > 0 for t in own)
        assert r["base_score"] == pytest.approx(base, rel=1e-9, abs=1e-9)
        assert r["score"] < 0 or not total


def test_base_score_is_that_of_plain_counts(docs, clashing):
    rows = [(r[0], r[1]) for r in sample_rows()]
    for table in (docs, clashing):
        model, vocabulary = C.train(table.filter("doc_id % 3 <> 1 or doc_id is null"))
        train = [t for i, t in rows if i is None or i % 3 != 1]
        check_base(C.score_texts(table, model, vocabulary).collect(), train, rows)


def test_class_model_learns_word_order(spark):
    """Words of one kind follow words of the other: classes see it, unigrams cannot."""
    rng = random.Random(1)
    nouns, verbs = [f"noun{i}" for i in range(60)], [f"verb{i}" for i in range(60)]

    def text():
        return " ".join(rng.choice(nouns if i % 2 else verbs) for i in range(200))

    table = spark.createDataFrame([(i, text()) for i in range(80)], "doc_id long, text string")
    model, vocabulary = C.train(table.filter("doc_id < 60"))
    held = C.score_texts(table.filter("doc_id >= 60"), model, vocabulary).collect()
    assert sum(r["score"] for r in held) > sum(r["base_score"] for r in held) + 0.25 * sum(r["n_tokens"] for r in held)


def number_of(word):
    """The hash of one word, and its ending's number."""
    found = C._tokens(text_array(pa.array([word])))
    return int(found.words[0]), int(found.endings(np.arange(1))[0])


def test_model_is_a_probability(docs):
    """Transitions sum to 1, and so do the emissions of a class over its words and unseen words."""
    model, vocabulary = C.train(docs)
    assert np.allclose((10 ** model.steps).sum(axis=1), 1)
    total = np.zeros(C.CLASSES + 1)
    for r in vocabulary.collect():
        total[r["class"]] += (r["n"] + 0.5) / model.room[r["class"]]
    for of_ending in model.ending_classes:  # one unseen word for each ending
        total[of_ending] += 0.5 / model.room[of_ending]
    assert np.allclose(total[:C.CLASSES][model.room[:C.CLASSES] > 0], 1)


@pytest.mark.parametrize("symbols, listed", [(50, 60), (2048, 0)])
def test_score_is_that_of_the_classes_by_hand(docs, monkeypatch, symbols, listed):
    """Every word of the training texts has a class of its own choosing, and texts score by plain counts of these."""
    monkeypatch.setattr(C, "LISTED_WORDS", listed)
    rows = [(r[0], r[1]) for r in sample_rows()]
    train = [t for i, t in rows if i is None or i % 3 != 1]
    model, vocabulary = C.train(docs.filter("doc_id % 3 <> 1 or doc_id is null"), symbols=symbols)
    count = collections.Counter(t for text in train for t in tokens(text) if t)
    table = {r["word"]: (r["class"], r["n"]) for r in vocabulary.collect()}
    numbers = {w: number_of(w) for w in {t for _, text in rows for t in tokens(text) if t}}
    assert {numbers[w][0]: n for w, n in count.items()} == {w: n for w, (_, n) in table.items()}
    assert len(table) > 100

    def class_of(word):
        if word is None:
            return C.CLASSES
        own, ending = numbers[word]
        return table[own][0] if own in table else int(model.ending_classes[ending])

    steps = np.zeros((C.CLASSES + 1, C.CLASSES + 1))
    for text in train:
        for a, b in zip([None] + tokens(text), tokens(text)):
            steps[class_of(a), class_of(b)] += 1
    arrivals = steps.sum(axis=0) + 0.5
    chance = (steps + 4 * arrivals / arrivals.sum()) / (steps.sum(axis=1, keepdims=True) + 4)
    room = np.zeros(C.CLASSES + 1)
    for of, n in table.values():
        room[of] += n + 0.5
    for of in model.ending_classes:
        room[of] += 0.5

    def score(text):
        out = 0.0
        for a, b in zip([None] + tokens(text), tokens(text)):
            out += math.log10(chance[class_of(a), class_of(b)])
            if b is not None:
                out += math.log10((count[b] + 0.5) / room[class_of(b)])
        return out

    scored = sorted(((r["doc_id"], round(r["score"], 6)) for r in C.score_texts(docs, model, vocabulary).collect()), key=repr)
    expected = sorted(((i, score(t)) for i, t in rows), key=repr)
    assert [i for i, _ in scored] == [i for i, _ in expected]
    for (_, found), (_, by_hand) in zip(sorted(scored, key=lambda r: (repr(r[0]), r[1])), sorted(expected, key=lambda r: (repr(r[0]), r[1]))):
        assert found == pytest.approx(by_hand, rel=1e-6, abs=1e-5)


def plain_likelihood(steps):
    """Of class steps, by the formula of mutual information: sum of N(a, b) log(N(a, b) / (N(a) N(b)))."""
    return sum(steps[a, b] * math.log(steps[a, b] / (steps[a].sum() * steps[:, b].sum()))
               for a in range(len(steps)) for b in range(len(steps)) if steps[a, b])


def test_exchange_never_loses_likelihood(spark):
    rng = random.Random(3)
    of_kind = [[i for i in range(1500) if i % 7 == k] for k in range(7)]  # each kind follows the one before it
    pairs = [(rng.choice(of_kind[k]), rng.choice(of_kind[(k + 1) % 7]), rng.randrange(1, 9)) for k in range(7) for _ in range(6000)]
    pairs += [(C.END, i, 3) for i in of_kind[0]] + [(i, C.END, 3) for i in of_kind[6]]
    bigrams = spark.createDataFrame(pairs, "a int, b int, n long").groupBy("a", "b").agg({"n": "sum"}).withColumnRenamed(
        "sum(n)", "n").cache()
    found = []
    for rounds in (0, 1, 2, 4):
        classes, steps = C.exchange(bigrams, rounds)
        counted = np.zeros_like(steps)
        for a, b, n in pairs:
            counted[classes[a], classes[b]] += n
        assert np.array_equal(counted, steps)
        assert C._likelihood(steps) == pytest.approx(plain_likelihood(steps))
        found.append(plain_likelihood(steps))
    assert found == sorted(found) and found[-1] > found[0]


def test_words_beyond_the_symbols_take_the_best_class(docs):
    """The class of each is that of the highest gain, recounted token by token."""
    rows = docs.select("text")
    texts = [r["text"] for r in rows.collect()]
    count = collections.Counter(t for text in texts for t in tokens(text) if t)
    first = sorted(((number_of(w)[0], n) for w, n in count.items()), key=lambda x: (-x[1], x[0]))[:50]
    order = np.argsort([w for w, _ in first])
    known = C.Words(np.array([w for w, _ in first])[order], order)
    rng = np.random.default_rng(2)
    classes = rng.integers(0, C.CLASSES, C.N_SYMBOLS)
    classes[C.END] = C.CLASSES
    steps = rng.integers(0, 30, (C.CLASSES + 1, C.CLASSES + 1)).astype(float)
    symbol = {w: i for i, (w, _) in enumerate(first)}

    def class_of(word):
        if word is None:
            return C.CLASSES
        own, ending = number_of(word)
        return classes[symbol.get(own, C.FIRST_ENDING + ending)]

    total = steps.sum(axis=0)
    chance = (steps + (total + 0.5) / (total.sum() + 0.5 * len(total))) / (steps.sum(axis=1, keepdims=True) + 1)
    gain = collections.defaultdict(lambda: np.zeros(C.CLASSES))
    kinds = {w: class_of(w) for w in [*count, None]}
    for text in texts:
        own = [None] + tokens(text)
        for before, word, after in zip(own, own[1:], own[2:]):
            gain[word] += np.array([math.log(chance[kinds[before], c]) + math.log(chance[c, kinds[after]]) - math.log(total[c] + 1)
                                    for c in range(C.CLASSES)])
    found = {r["word"]: (r["class"], r["n"]) for r in C._assigned(rows, known, classes, steps).collect()}
    rest = [w for w in count if number_of(w)[0] not in symbol]
    assert len(found) == len(rest) > 100
    for w in rest:
        own, n = found[number_of(w)[0]]
        assert n == count[w] and gain[w][own] == pytest.approx(gain[w].max())


def test_words_outside_the_broadcast_table_are_joined(docs, monkeypatch):
    monkeypatch.setattr(C, "LISTED_WORDS", 500)
    rows = [(r[0], r[1]) for r in sample_rows()]
    model, vocabulary = C.train(docs)
    assert 0 < len(model.listed) < vocabulary.count()
    check_base(C.score_texts(docs, model, vocabulary).collect(), [t for _, t in rows], rows)


def test_no_training_texts_and_empty_table(docs, empty):
    model, vocabulary = C.train(empty)
    scored = C.score_texts(docs, model, vocabulary).collect()
    assert len(scored) == len(sample_rows())
    assert all(r["n_known"] == 0 and r["train_tokens"] == 0 and r["base_score"] == 0 for r in scored)
    assert all(math.isfinite(r["score"]) for r in scored)
    assert rows_of(C.score_texts(empty, model, vocabulary)) == []


def test_a_task_passes_each_word_on_once():
    batches = [pa.RecordBatch.from_pydict({"text": ["one two TWO", None, "", "two three"]}) for _ in range(3)]
    found = [dict(zip(b.column("word").to_pylist(), b.column("n").to_pylist())) for b in C._word_counts(batches)]
    assert len(found) == 1 and sorted(found[0].values()) == [3, 3, 9]


def test_task_sums_are_passed_on_when_there_are_many(monkeypatch):
    monkeypatch.setattr(C, "HELD_ROWS", 50)
    rng, total = np.random.default_rng(1), collections.Counter()
    slices = []
    for _ in range(30):
        a, b, n = rng.integers(0, 12, 20), rng.integers(-4, 4, 20), rng.integers(1, 5, 20)
        slices.append(([a, b], n))
        for row in zip(a.tolist(), b.tolist(), n.tolist()):
            total[row[:2]] += row[2]
    got = collections.Counter()
    batches = list(C._task_sums(iter(slices), ["a", "b", "n"], [pa.int32(), pa.int64(), pa.int64()]))
    for batch in batches:
        for row in batch.to_pylist():
            got[row["a"], row["b"]] += row["n"]
    assert got == total and len(batches) > 1
    assert list(C._task_sums(iter([]), ["a", "n"], [pa.int64(), pa.int64()])) == []


def test_summed_rows_come_in_the_order_of_the_first_column():
    rng = np.random.default_rng(2)
    columns = [np.sort(rng.integers(0, 40, 5_000)), rng.integers(0, 3, 5_000), rng.integers(-2**62, 2**62, 5_000) // 2**61]
    (row, *rest), n = C._summed(columns, lead=20)
    assert (np.diff(row) >= 0).all()
    assert dict(zip(zip(row.tolist(), *(x.tolist() for x in rest)), n.tolist())) == collections.Counter(zip(*(c.tolist() for c in columns)))


@pytest.mark.parametrize("size", [0, 1, 2, 3, 1_000])
def test_places_of_hashes(size):
    rng = np.random.default_rng(size)
    keys = np.unique(np.r_[rng.integers(-2**63, 2**63, size), np.arange(size // 2)])[:size]  # some stand close together
    asked = np.r_[keys, rng.integers(-2**63, 2**63, 500), keys - 1, [-2**63, 2**63 - 1, 0]]
    where = {k: i for i, k in enumerate(keys.tolist())}
    assert C.Places(keys).find(asked).tolist() == [where.get(k, -1) for k in asked.tolist()]


def test_scoring_reads_the_texts_once(docs, monkeypatch):
    model, vocabulary = C.train(docs)
    readings, arrow_map = [], C.arrow_map
    monkeypatch.setattr(C, "arrow_map", lambda *a: readings.append(a) or arrow_map(*a))
    assert C.score_texts(docs, model, vocabulary).count() == docs.count()
    assert len(readings) == 1
