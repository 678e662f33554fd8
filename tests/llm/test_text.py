"""The numpy helpers against plain Python."""

import re

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from martforge.llm.text import span_hashes, text_array, text_slices

WORD = re.compile(r"[^\x20\x09-\x0D]+")
TEXTS = st.lists(st.one_of(st.none(), st.text(alphabet="ab \n\t\r\x0b\x0cÄé x", max_size=30)), max_size=8)


@settings(max_examples=150, deadline=None)
@given(TEXTS)
def test_words_and_lines_are_those_of_python(texts):
    got = text_array(pa.array(texts, pa.string()))
    raw = got.data.tobytes()
    starts, ends = got.word_spans()
    found = [[] for _ in texts]
    for s, e, r in zip(starts, ends, got.row_of(starts)):
        found[r].append(raw[s:e].decode())
    assert found == [WORD.findall(t or "") for t in texts]
    begin, end = got.line_spans()
    assert [raw[s:e].decode() for s, e in zip(begin, end)] == [x for t in texts for x in (t or "").split("\n")]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(alphabet="aAbBzZéÉ", min_size=1, max_size=6), min_size=1, max_size=20))
def test_equal_words_have_equal_hashes(found):
    texts = text_array(pa.array([" ".join(found)]))
    starts, ends = texts.word_spans()
    lowered = [w.translate({i: i + 32 for i in range(65, 91)}) for w in found]
    for lower, keys in ((False, found), (True, lowered)):
        hashes = span_hashes(texts.data, starts, ends, lower=lower).tolist()
        assert len(set(hashes)) == len(set(keys))
        assert len(set(zip(hashes, keys))) == len(set(keys))


def test_hash_does_not_depend_on_place_in_long_data():
    word = "somewhere"
    texts = text_array(pa.array([word + " " + "x " * 1_200_000 + word, "y" * 3_000_000, word]))
    starts, ends = texts.word_spans()
    hashes = span_hashes(texts.data, starts, ends)
    same = [h for h, s, e in zip(hashes, starts, ends) if e - s == len(word)]
    assert len(same) == 3 and len(set(same)) == 1


def test_slices_hold_every_row_once():
    batch = pa.RecordBatch.from_arrays([pa.array(range(6)), pa.array(["a" * 10, None, "b" * 50, "", "c", "d" * 9])],
                                       names=["doc_id", "text"])
    parts = list(text_slices([batch, batch.slice(0, 0)], limit=20))
    assert [i for part, _ in parts for i in part.column("doc_id").to_pylist()] == list(range(6))
    assert all(len(t.data) <= 20 or t.rows == 1 for _, t in parts)
    assert np.concatenate([np.diff(t.offsets) for _, t in parts]).tolist() == [10, 0, 50, 0, 1, 9]
