"""Token ids of whole texts inside Spark tasks, with a tokenizer file of the ``tokenizers`` library.

The tokenizers used here never join characters across white space, so a text's
ids are those of its words one after another. Each distinct word of a slice is
encoded once and kept for later slices and tasks of the worker process. New
words go through the tokenizer many at a time, as one text in which a mark of a
single id stands between them: a call for each word costs more than its ids.
"""

from __future__ import annotations

import os
from dataclasses import dataclass
from functools import lru_cache

import numpy as np

from .text import Texts, span_hashes

KEEP_WORDS = 1 << 20  # distinct words that a worker keeps before it starts anew
BATCH_WORDS = 5000  # words encoded at a time
JOINED_WORDS = 64  # of these, as one text
MARK = "\x01"  # stands between the words of such a text
END_ID = 2


@dataclass
class WordEncoder:
    path: str
    end_id: int = END_ID

    def __post_init__(self):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(self.path)
        mark = self._ids([MARK])[0]
        self.mark = mark[0] if len(mark) == 1 else None  # without a mark of one id, words are encoded one by one
        self._forget()

    def _forget(self) -> None:
        self.keys = np.zeros(0, np.uint64)
        self.slots = np.zeros(0, np.int64)
        self.starts = np.zeros(0, np.int64)
        self.sizes = np.zeros(0, np.int64)
        self.ids = np.zeros(0, np.uint32)

    def _ids(self, texts: list[str]) -> list[list[int]]:
        return [x.ids for x in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _word_ids(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of some words one after another, and the number of ids of each."""
        groups = [words[at: at + JOINED_WORDS] for at in range(0, len(words), JOINED_WORDS if self.mark is not None else 1)]
        between = f" {MARK} ".encode()
        flat, sizes = [], []
        for group, found in zip(groups, self._ids([between.join(g).decode("utf-8", "replace") for g in groups])):
            ids = np.array(found, np.uint32)
            marks = np.flatnonzero(ids == self.mark) if len(group) > 1 else np.zeros(0, np.int64)
            if len(marks) != len(group) - 1:  # a word holds the mark itself
                single = self._ids([w.decode("utf-8", "replace") for w in group])
                flat += [np.array(x, np.uint32) for x in single]
                sizes += [len(x) for x in single]
                continue
            flat.append(np.delete(ids, marks))
            sizes += (np.diff(np.r_[-1, marks, len(ids)]) - 1).tolist()
        return np.concatenate([*flat, self.ids[:0]]), np.array(sizes, np.int64)

    def _learn(self, texts: Texts, keys: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> None:
        """``keys`` come in order."""
        raw = texts.data.tobytes()
        words = [raw[s:e] for s, e in zip(starts.tolist(), ends.tolist())]
        found = [self._word_ids(words[at: at + BATCH_WORDS]) for at in range(0, len(words), BATCH_WORDS)]
        sizes = np.concatenate([x for _, x in found])
        first = np.cumsum(sizes) - sizes + len(self.ids)
        slots = np.arange(len(keys)) + len(self.starts)
        self.starts, self.sizes = np.r_[self.starts, first], np.r_[self.sizes, sizes]
        self.ids = np.concatenate([self.ids, *(x for x, _ in found)])
        at = np.searchsorted(self.keys, keys)
        self.keys, self.slots = np.insert(self.keys, at, keys), np.insert(self.slots, at, slots)

    def encode(self, texts: Texts) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the rows, each row closed by the end id, and the number of ids of each row."""
        starts, ends = texts.word_spans()
        rows = texts.row_of(starts)
        keys, first, which = np.unique(span_hashes(texts.data, starts, ends), return_index=True, return_inverse=True)
        if len(self.keys) > KEEP_WORDS:
            self._forget()
        at = np.searchsorted(self.keys, keys)
        new = np.ones(len(keys), bool)
        inside = at < len(self.keys)
        new[inside] = self.keys[at[inside]] != keys[inside]
        if new.any():
            self._learn(texts, keys[new], starts[first[new]], ends[first[new]])
            at = np.searchsorted(self.keys, keys)
        slot = self.slots[at][which]
        sizes, begin = self.sizes[slot], self.starts[slot]
        of_row = np.bincount(rows, weights=sizes, minlength=texts.rows).astype(np.int64) + 1
        out = np.full(int(of_row.sum()), self.end_id, np.uint32)
        place = np.cumsum(sizes) - sizes
        inner = np.arange(int(sizes.sum())) - np.repeat(place, sizes)
        out[np.repeat(place + rows, sizes) + inner] = self.ids[np.repeat(begin, sizes) + inner]
        return out, of_row


@lru_cache(maxsize=2)
def encoder(path: str, end_id: int = END_ID) -> WordEncoder:
    """One encoder for all tasks that a worker process runs."""
    return WordEncoder(path, end_id)
