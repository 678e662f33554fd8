import glob

import numpy as np
import pytest

from martforge.llm import token_files as T
from martforge.session import work_dir

from .conftest import sample_rows
from .test_packing import plain_ids


@pytest.mark.parametrize("table_name", ["docs", "clashing"])
def test_round_trip(spark, request, tokenizer, table_name):
    folder = work_dir(spark, "token-test")
    manifest = T.write_token_files(request.getfixturevalue(table_name), folder, tokenizer)
    got = sorted(T.read_token_files(spark, manifest).collect(), key=lambda r: r["start"])
    rows = sorted(sample_rows(), key=lambda r: (r[0] is not None, r[0] or 0))
    assert [r["doc_id"] for r in got] == [r[0] for r in rows]
    at = 0
    for r, (_, text, *_rest) in zip(got, rows):
        ids = plain_ids(tokenizer, text)
        assert (r["start"], r["n_tokens"]) == (at, len(ids))
        assert np.frombuffer(r["ids"], "<u4").tolist() == ids
        at += len(ids)
    path = T.local_path(folder)
    assert not glob.glob(f"{path}/*attempt*")
    ids = np.concatenate([np.fromfile(f, "<u2") for f in sorted(glob.glob(f"{path}/*.ids"))])
    assert len(ids) == at  # the files side by side are the flat array


def test_wide_ids_and_long_reads(spark, docs, tokenizer, monkeypatch):
    folder = work_dir(spark, "token-test")
    manifest = T.write_token_files(docs, folder, tokenizer, id_bytes=4)
    assert {r["width"] for r in manifest.collect()} == {4}
    assert T.read_token_files(spark, manifest).count() == len(sample_rows())


def test_empty_table_and_foreign_store(spark, docs, empty, tokenizer):
    manifest = T.write_token_files(empty, work_dir(spark, "token-test"), tokenizer)
    assert manifest.collect() == [] and T.read_token_files(spark, manifest).collect() == []
    with pytest.raises(ValueError):
        T.write_token_files(docs, "hdfs://somewhere/x", tokenizer)


def test_ids_that_do_not_fit_are_refused(spark, docs, tokenizer):
    with pytest.raises(Exception, match="does not fit 1 bytes"):
        T.write_token_files(docs, work_dir(spark, "token-test"), tokenizer, id_bytes=1)
