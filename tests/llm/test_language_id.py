import random
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest

from martforge.llm import language_id as L

from .conftest import rows_of, sample_rows

SYLLABLES = {"de": "sch ung ein ver keit lich", "en": "the ing tion and ness ly", "es": "ción ado que los mente ar"}


def invented(rng, lang, n):
    parts = SYLLABLES[lang].split()
    return " ".join("".join(rng.choice(parts) for _ in range(rng.randrange(1, 4))) for _ in range(n))


def test_kernel_is_that_of_ngram_sets():
    rng = random.Random(2)
    seen = np.zeros(1 << L.BITS, bool)
    for _ in range(20):
        texts = [invented(rng, lang, 8) for lang in ("de", "en")]
        sets = [{t.lower()[i:i + n] for n in range(1, L.MAX_ORDER + 1) for i in range(len(t) - n + 1)} for t in texts]
        bins = [set(L.present_bins(t, seen).tolist()) for t in texts]
        assert not seen.any()
        # hashing may join two n-grams in a bin, hardly ever
        assert len(sets[0]) - 2 <= len(bins[0]) <= len(sets[0])
        assert abs(len(bins[0] & bins[1]) - len(sets[0] & sets[1])) <= 2


def test_pieces_of_a_long_text_join(monkeypatch):
    seen, text = np.zeros(1 << L.BITS, bool), invented(random.Random(1), "en", 300)
    whole = L.present_bins(text, seen)
    monkeypatch.setattr(L, "_PIECE", 50)
    assert L.present_bins(text, seen).tolist() == whole.tolist()


def test_scores_are_the_dual_form():
    """One product with the weights equals the kernel row times the dual coefficients."""
    rng, seen = random.Random(3), np.zeros(1 << L.BITS, bool)
    labels = [lang for lang in SYLLABLES for _ in range(12)]
    texts = [invented(rng, lang, 12) for lang in labels]
    bins = [L.present_bins(t, seen) for t in texts]
    model = L.fit(bins, labels, landmarks=9)
    kernel = np.array([[len(set(a) & set(b)) / (len(a) * len(b)) ** 0.5 for b in map(tuple, bins)] for a in map(tuple, bins)])
    marks = [i for turn in range(3) for i in (turn, 12 + turn, 24 + turn)]
    targets = np.array([[float(x == y) for y in sorted(SYLLABLES)] for x in labels])
    k, of_marks = kernel[:, marks], kernel[np.ix_(marks, marks)]
    dual = np.linalg.solve(k.T @ k + L.RIDGE * len(labels) * (of_marks + 1e-8 * np.eye(9)), k.T @ targets)
    assert np.allclose(model.scores(texts), k @ dual, atol=1e-3)


def test_held_out_accuracy(spark):
    rng = random.Random(4)
    rows = [(i, invented(rng, lang, rng.randrange(3, 40)), lang) for i, lang in
            enumerate(rng.choices(list(SYLLABLES), weights=(1, 10, 2), k=600))]
    table = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = L.train(table.filter("doc_id < 400"), max_train=120)
    got = {r["doc_id"]: r for r in L.predict(table, model).collect()}
    held = [got[i]["lang_pred"] == lang for i, _, lang in rows if i >= 400]
    assert sum(held) / len(held) > 0.97
    assert all(0 <= r["score"] <= 1 for r in got.values())


def test_odd_texts(docs, clashing, empty):
    model = L.train(docs)
    assert model.languages == ["en", "fr"]
    for table in (docs, clashing):
        got = {r["doc_id"]: r for r in L.predict(table, model).collect()}
        assert {i for i, r in got.items() if r["lang_pred"] == L.UNKNOWN} == {42, 43, 44, 45}
        assert all(got[i]["score"] == 0 for i in (42, 43, 44, 45))
        assert L.predict(table, model).count() == len(sample_rows())
    assert rows_of(L.predict(empty, model)) == []
    nothing = L.train(empty)
    assert {r["lang_pred"] for r in L.predict(docs, nothing).collect()} == {L.UNKNOWN}


@pytest.mark.parametrize("seed", [1, 2])
def test_sample_is_bounded_and_even(spark, seed):
    rows = [(i, "some words here", "en" if i % 10 else "fr") for i in range(3000)]
    table = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    counts = {}
    fit = L.fit

    def spy(bins, labels, landmarks):
        counts.update({x: labels.count(x) for x in set(labels)})
        return fit(bins, labels, landmarks)

    L.fit, kept = spy, L.fit
    try:
        L.train(table, max_train=200, seed=seed)
    finally:
        L.fit = kept
    assert 60 < counts["en"] < 140 and 60 < counts["fr"] < 140


def test_the_driver_holds_the_sample_as_arrays(spark):
    """At most a few bytes for each bin of the sample: Python numbers take 36."""
    rng = random.Random(6)
    texts = ["".join(chr(rng.randrange(0x3400, 0x4DB0)) for _ in range(12_000)) for _ in range(30)]
    table = spark.createDataFrame([(i, t, ("en", "de")[i % 2]) for i, t in enumerate(texts)], "doc_id long, text string, lang string")
    seen = np.zeros(1 << L.BITS, bool)
    held = sum(len(L.present_bins(t, seen)) for t in texts)
    tracemalloc.start()
    try:
        model = L.train(table, landmarks=4)
        most = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert model.languages == ["de", "en"] and held > 1_000_000
    assert most < 24 * held


def test_the_sample_is_ordered_by_draw_label_and_bins():
    rows = [(0.5, "en", [1, 300]), (0.5, "en", [1]), (0.5, "de", [9]), (0.1, "en", [70_000, 3]), (0.5, "en", [1, 2, 5])]
    drawn = pa.table({"draw": [r[0] for r in rows], "lang": [r[1] for r in rows],
                      "bins": pa.array([r[2] for r in rows], pa.list_(pa.int32()))})
    bins, labels = L._in_order(drawn)
    assert list(zip(labels, map(np.ndarray.tolist, bins))) == [(r[1], r[2]) for r in sorted(rows)]
