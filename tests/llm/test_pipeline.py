"""Each stage on the rows its predecessor kept, and the whole run, against plain versions."""

import numpy as np
import pytest

import corpus_pipeline as P
from martforge.llm import mixing
from martforge.llm.shared import written

from .conftest import rows_of, sample_rows
from .test_line_dedup import plain_result
from .test_minhash import plain_components
from .test_packing import plain_ids


@pytest.fixture(scope="module")
def folder(spark, docs, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("tables"))
    docs.write.parquet(f"{path}/documents.parquet")
    return path


def test_stages_are_listed_in_order():
    assert [name for name, _ in P.STAGES] == ["language_id", "line_dedup", "minhash_near_dedup", "mix_sources",
                                              "pack_sequences"]


def test_stages_on_their_own_input(spark, docs, folder, tokenizer):
    stages, now = dict(P.STAGES), docs
    kept = written(stages["language_id"](spark, now, folder), "t")
    assert kept.columns == docs.columns
    gone = {r[0] for r in sample_rows()} - {r["doc_id"] for r in kept.collect()}
    assert gone >= {42, 43, 44, 45} and len(gone) <= 6  # those without a letter; at most a word or two besides

    before = [tuple(r) for r in kept.collect()]
    cut = written(stages["line_dedup"](spark, kept, folder), "t")
    expect, _ = plain_result(before)
    expect = [(d, t) for d, t in expect if t.split() or (d, t) in {(r[0], r[1]) for r in before}]
    assert rows_of(cut, "doc_id", "text") == expect
    assert all(r["n_chars"] == len(r["text"]) for r in cut.collect())

    before = [(r["doc_id"], r["text"]) for r in cut.collect()]
    single = written(stages["minhash_near_dedup"](spark, cut, folder), "t")
    keep = {r[0] for r in plain_components(before, 5) if r[3] or r[0] is None}
    assert rows_of(single, "doc_id", "text") == sorted((r for r in before if r[0] in keep), key=repr)

    mixed = written(stages["mix_sources"](spark, single, folder), "t")
    plan = mixing.mix_plan(single).collect()
    assert sum(len(r["text"].split()) for r in mixed.collect()) == sum(r["taken"] for r in plan)
    assert mixed.columns == docs.columns

    packed = stages["pack_sequences"](spark, mixed, folder).collect()
    ids = sorted(i for r in packed for i in np.frombuffer(r["ids"], "<u4").tolist())
    assert ids == sorted(i for r in mixed.collect() for i in plain_ids(tokenizer, r["text"]))


def test_near_dedup_keeps_one_row_of_an_id(spark, folder):
    long = "some words that only this one document of all of them has in this order"
    rows = [(1, long, "en", "a", 1)] * 40 + [(2, long + " x", "en", "a", 1), (3, "other words", "fr", "b", 1)] * 3 + [
        (None, "no id", "en", "a", 1)] * 2
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars int")
    left = dict(P.STAGES)["minhash_near_dedup"](spark, docs, folder)
    assert left.columns == docs.columns
    assert rows_of(left, "doc_id", "text") == sorted([(1, long), (3, "other words"), (None, "no id"), (None, "no id")], key=repr)


def test_run_takes_documents_through_all_stages(spark, folder):
    packed = P.run(spark, folder)
    assert packed.columns[:3] == ["doc_id", "start", "length"]
    assert packed.count() > 40


def test_empty_table(spark, empty, tmp_path):
    empty.write.parquet(f"{tmp_path}/documents.parquet")
    assert P.run(spark, str(tmp_path)).collect() == []
