from hypothesis import given, settings
from hypothesis import strategies as st

from martforge.llm.text import text_array
from martforge.llm.tokens import END_ID, WordEncoder


def test_words_encode_like_whole_texts(tokenizer):
    import pyarrow as pa
    from tokenizers import Tokenizer

    own, whole = WordEncoder(tokenizer), Tokenizer.from_file(tokenizer)

    @settings(max_examples=120, deadline=None)
    @given(st.lists(st.one_of(st.none(), st.text(alphabet="aB '́é  \x1c\n\t12.<|endoftext>İß漢🙂", max_size=25)),
                    min_size=1, max_size=6))
    def check(texts):
        ids, sizes = own.encode(text_array(pa.array(texts, pa.string())))
        expect = [whole.encode(t or "", add_special_tokens=False).ids + [END_ID] for t in texts]
        assert sizes.tolist() == [len(x) for x in expect]
        assert ids.tolist() == [i for x in expect for i in x]

    check()


def test_new_words_are_encoded_many_at_a_time(tokenizer):
    import pyarrow as pa

    from martforge.llm.tokens import JOINED_WORDS, MARK

    own, calls = WordEncoder(tokenizer), []
    real = own.tokenizer

    class Counted:
        def encode_batch_fast(self, texts, **options):
            calls.extend(texts)
            return real.encode_batch_fast(texts, **options)

    own.tokenizer = Counted()
    plain = [f"w{i}x'{i % 7}é" for i in range(10 * JOINED_WORDS)]
    marked = [f"a{MARK}b{i}" for i in range(3)] + [MARK, "﻿", "́"]
    expect = [i for w in plain for i in real.encode(w, add_special_tokens=False).ids] + [END_ID]
    ids, sizes = own.encode(text_array(pa.array([" ".join(plain)])))
    assert ids.tolist() == expect and sizes.tolist() == [len(expect)]
    assert len(calls) == 10  # not one call for each word
    for words in (marked, plain + marked, [MARK]):
        ids, _ = WordEncoder(tokenizer).encode(text_array(pa.array([" ".join(words)])))
        assert ids.tolist() == real.encode(" ".join(words), add_special_tokens=False).ids + [END_ID]
