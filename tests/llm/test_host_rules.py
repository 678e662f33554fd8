import collections
import re

from martforge.llm import host_rules as H

from .conftest import rows_of, sample_rows

WORD = re.compile(r"[^\x20\x09-\x0D]+")
COUNTS = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]


def plain(doc_id, text):
    text = text or ""
    w = WORD.findall(text)
    windows = collections.Counter(tuple(w[i:i + 8]) for i in range(len(w) - 7))
    covered = {i + k for i in range(len(w) - 7) if windows[tuple(w[i:i + 8])] > 1 for k in range(8)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return (doc_id, len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)),
            len(covered), len(w) < 20 or 100 * len(covered) > 30 * len(w))


def test_counts_are_those_of_a_plain_loop(docs, clashing):
    expect = sorted((plain(r[0], r[1]) for r in sample_rows()), key=repr)
    assert rows_of(H.judge_documents(docs), *COUNTS) == expect
    assert rows_of(H.judge_documents(clashing), *COUNTS) == expect


def test_bad_host_takes_its_documents_along_small_host_does_not(spark):
    good = " ".join(f"word{i}" for i in range(40))
    rows = [(i, good, "good") for i in range(60)]
    rows += [(100 + i, "too short" if i < 55 else good, "bad") for i in range(60)]
    rows += [(200, "too short", "tiny"), (201, good, "tiny"), (300, good, None), (301, None, None)]
    rows += [(400 + 60 * h + i, good, f"host{h}") for h in range(8) for i in range(60)]
    got = {r["doc_id"]: r for r in H.judge_documents(
        spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()}
    assert len(got) == len(rows)
    assert not got[155 + 4]["base_failed"] and got[159]["host_failed"] and not got[159]["kept"]
    assert got[201]["kept"] and not got[200]["kept"]  # one failure of two is no verdict on the host
    assert got[300]["kept"] and not got[301]["kept"]
    assert got[0]["kept"]


def test_empty_table(empty):
    assert H.judge_documents(empty).collect() == []
