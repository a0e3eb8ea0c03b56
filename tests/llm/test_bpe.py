import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from aloft.llm import bpe
from aloft.llm.queries import QUERIES

RANKS = bpe.load_ranks(bpe.default_vocabulary())
REPLAY = bpe.MergeReplay(RANKS, public_tokenizers.PATTERN)
TIKTOKEN = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=RANKS,
                             special_tokens={})


def ids(text):
    return np.frombuffer(REPLAY.encode([text])[0], "<u4").tolist()


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet=st.sampled_from(list("aabething  \n1'sé日=-_<|>😀​")), max_size=80))
def test_equals_tiktoken(text):
    assert ids(text) == TIKTOKEN.encode_ordinary(text)
    assert REPLAY.decode(REPLAY.encode([text])[0]) == text.encode()


@pytest.mark.parametrize("text", ["a" * 3000, " " * 999 + "x", "=-" * 700, "aaab" * 500, "<|endoftext|>"])
def test_long_pieces(text):
    assert ids(text) == TIKTOKEN.encode_ordinary(text)


def test_lower_rank_made_by_a_merge():
    # "ab" has a higher rank than "abc", and "abc" can only be made through it
    ranks = {bytes([b]): b for b in range(256)} | {b"abc": 256, b"ab": 257, b"cd": 258, b"abcab": 259}
    own = bpe.MergeReplay(ranks, r"\S+|\s+")
    enc = tiktoken.Encoding("x", pat_str=r"\S+|\s+", mergeable_ranks=ranks, special_tokens={})
    for t in ("abcabcabc", "ababcd", "abcdabcdab", "cdabab", "aabcbcd"):
        assert np.frombuffer(own.encode([t])[0], "<u4").tolist() == enc.encode_ordinary(t)


def test_odd_rows(odd_docs, no_docs):
    want = sorted((str(r.doc_id), len(e := TIKTOKEN.encode_ordinary(r.text or "")),
                   hashlib.sha256(np.array(e, "<u4").tobytes()).hexdigest(),
                   hashlib.sha256((r.text or "").encode()).hexdigest())
                  for r in odd_docs.select("doc_id", "text").collect())
    got = bpe.encode_decode(odd_docs).collect()
    assert sorted((str(r.doc_id), r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in got) == want
    assert all(len(r.ids) == 4 * r.n_tokens for r in got)
    assert bpe.encode_decode(no_docs).count() == 0


def test_query(spark, sf, documents):
    got = {r.doc_id: r for r in QUERIES["op9_byte_bpe"](spark, sf).collect()}
    for r in documents.collect():
        e = TIKTOKEN.encode_ordinary(r.text)
        assert got[r.doc_id].n_tokens == len(e)
        assert got[r.doc_id].ids_sha256 == hashlib.sha256(np.array(e, "<u4").tobytes()).hexdigest()


def test_pieces_are_replayed_all_at_once(monkeypatch):
    """No piece of usual length goes through the index in Python; lengths about the bound, many alphabets."""
    r = random.Random(5)
    own = bpe.MergeReplay(RANKS, public_tokenizers.PATTERN)
    words = ["".join(r.choice(a) for _ in range(r.randint(1, 70))) for a in ("ab", "abcdefghij", "étüß", "日本語の", "=-<>", "0123")
             for _ in range(300)]
    monkeypatch.setattr(bpe, "CHAIN_PIECES", 50, raising=False)
    index, long = own.replay, []
    monkeypatch.setattr(own, "replay", lambda pieces: long.extend(pieces) or index(pieces))
    coded = own.encode(words)
    assert [np.frombuffer(c, "<u4").tolist() for c in coded] == [TIKTOKEN.encode_ordinary(w) for w in words]
    assert long and all(len(p) > 64 for p in long)
