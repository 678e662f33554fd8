import itertools
import random

import numpy as np
import pytest

from martforge.llm import packing as P

from .conftest import sample_rows


def plain_ids(path, text):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path).encode(text or "", add_special_tokens=False).ids + [2]


@pytest.mark.parametrize("table_name", ["docs", "clashing"])
def test_every_id_lies_in_one_piece(request, tokenizer, table_name):
    pieces = P.pack_documents(request.getfixturevalue(table_name), tokenizer, capacity=512, windows=8).collect()
    expect = sorted(tuple(plain_ids(tokenizer, r[1])) for r in sample_rows())
    sequences, documents = {}, {}
    for p in pieces:
        ids = np.frombuffer(p["ids"], "<u4").tolist()
        assert len(ids) == p["length"] > 0
        sequences.setdefault(p["sequence_id"], []).append((p["offset"], p["length"]))
        documents.setdefault((p["doc_id"], p["doc_tokens"]), []).append((p["start"], ids))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 512
    got = []
    for (_, total), parts in documents.items():
        parts.sort()
        flat = list(itertools.chain.from_iterable(ids for _, ids in parts))
        copies, rest = divmod(len(flat), total)  # repeated rows come twice
        assert not rest
        got += [tuple(next(ids for s, ids in parts if s == 0) if len(parts) == copies else flat)] * copies
    assert sorted(got) == expect
    tokens = sum(p["length"] for p in pieces)
    assert tokens / (512 * len(sequences)) > 0.9


def test_differencing_is_near_equal_and_whole():
    rng = random.Random(1)
    for n, k in ((200, 16), (40, 8), (5, 8), (1, 1), (0, 3)):
        sizes = [int(rng.lognormvariate(5, 1)) + 1 for _ in range(n)]
        dealt = P.largest_differencing(sizes, k)
        assert sorted(i for items in dealt for i in items) == list(range(n))
        sums = [sum(sizes[i] for i in items) for items in dealt]
        if n >= 8 * k:
            assert max(sums) - min(sums) <= max(sizes) // 4


def test_two_windows_difference_like_the_book():
    sums = sorted(sum([8, 7, 6, 5, 4][i] for i in items) for items in P.largest_differencing([8, 7, 6, 5, 4], 2))
    assert sums == [14, 16]  # the differencing method's known result


def test_window_count_rises_when_capacity_is_exceeded():
    sizes = [60, 60, 60]  # 180 tokens would fit two windows of 100 by sum alone
    dealt = P.pack_group(sizes, 100)
    assert sorted(map(sorted, dealt)) == [[0], [1], [2]]


def test_empty_table(empty, tokenizer):
    assert P.pack_documents(empty, tokenizer).collect() == []
