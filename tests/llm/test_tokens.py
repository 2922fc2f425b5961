"""Token counts and BPE streams against the tokenizers library."""

import random
from hashlib import sha256

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tests.llm.corpora import edge_documents, edge_texts, empty_documents
from tidemark.llm import bpe_stream, token_counts
from tidemark.llm.pretokens import sufficient_lookahead, vocabulary

PATH = public_tokenizers.path("byte_bpe_50k.json")
LIBRARY = Tokenizer.from_file(PATH)
PIECES = (
    "a|b|the|  |\n| |\t|'s|'re|'|ll|é|日|1|23|!!|<|endoftext|>|<|end|\xa0|　|Thing |"
    "\U0001f600|힣|՘|\U0003d001|́|aaaa|\x0b|\x85"
).split("|") + ["<|endoftext|>", "|"]
TEXTS = st.lists(st.sampled_from(PIECES), max_size=40).map("".join) | st.text(max_size=60)


def ids(text):
    return LIBRARY.encode(text, add_special_tokens=False).ids


def streamed(text, size):
    return np.concatenate([*bpe_stream.encode_stream(bpe_stream.chunks(text, size), PATH)]).tolist()


@settings(max_examples=150, deadline=None)
@given(st.lists(TEXTS, max_size=5))
def test_counts_of_any_text(texts):
    sizes, counts = token_counts.counter(PATH)(texts)
    assert counts == [len(ids(t)) for t in texts]
    assert sizes == [len(t.encode()) for t in texts]


@settings(max_examples=150, deadline=None)
@given(TEXTS, st.integers(1, 9))
def test_stream_of_any_text(text, size):
    assert streamed(text, size) == ids(text)


LONG = {
    "one letter": "a" * 9000,
    "two letters": "ab" * 5000,
    "blanks": " " * 5000,
    "blanks before a word": "\n" * 3000 + "x",
    "blanks between": "x" + " " * 2500 + "y",
    "digits": "1" * 3000,
    "signs then a contraction": "!" * 1500 + "'s",
    "letters": "".join(random.Random(1).choice("etaoinsrhldu") for _ in range(12_000)),
    "wide characters": "日本語" * 3000,
    "special strings": "<|endoftext|>" * 400,
    "runs at the window": ("a" * 1030 + "  ") * 5 + "\n",
}


@pytest.mark.parametrize("name", LONG)
def test_long_runs(name):
    text = LONG[name]
    want = ids(text)
    for size in (300, 1 << 16):
        assert streamed(text, size) == want
    assert token_counts.counter(PATH)([text])[1] == [len(want)]


def test_state_is_bounded():
    encoder = bpe_stream.Encoder(bpe_stream.codec(PATH))
    most = 0
    for _ in range(200):
        encoder.feed("abcdefghij" * 30)  # one pre-token without end
        most = max(most, len(encoder.text) + len(encoder.open) + len(encoder.piece))
    assert most < 4 * bpe_stream.WINDOW


def test_lookahead_settles_tokens():
    """What follows a prefix by more than the lookahead leaves its tokens alone."""
    codec, rng = bpe_stream.codec(PATH), random.Random(3)
    ahead = sufficient_lookahead(vocabulary(PATH).merges)
    assert codec.lookahead == ahead < 1000
    for _ in range(30):
        text = bytes(rng.choice(b"etaoins ") for _ in range(ahead + 200))
        whole = codec.tokens(text + bytes(rng.choice(b"etaoins ") for _ in range(50)))
        done, settled = 0, []
        for token in codec.tokens(text):
            done += len(token)
            if done <= len(text) - ahead:
                settled.append(token)
        assert whole[: len(settled)] == settled


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(0, 50256), max_size=30), st.integers(1, 5))
def test_decoding_any_ids(tokens, size):
    parts = [np.array(tokens[i : i + size]) for i in range(0, len(tokens), size)]
    assert "".join(bpe_stream.decode_stream(parts, PATH)) == LIBRARY.decode(
        tokens, skip_special_tokens=False
    )


def test_counts_table(spark):
    documents = edge_documents(spark)
    rows = token_counts.token_counts(documents, PATH, 512).collect()
    texts = [t or "" for t in edge_texts()]
    want = [(len(t.encode()), len(ids(t))) for t in texts]
    got = sorted(tuple(r) for r in rows if r.doc_id is not None)
    assert got == sorted((i, b, n, n > 512) for i, (b, n) in enumerate(want) for _ in "ab")
    assert sorted((r.n_bytes, r.n_tokens) for r in rows if r.doc_id is None) == sorted(want)
    assert token_counts.token_counts(empty_documents(spark), PATH, 512).count() == 0


def test_round_trip_table(spark):
    rows = bpe_stream.round_trip(edge_documents(spark), PATH).collect()
    want = []
    for number, text in enumerate(t or "" for t in edge_texts()):
        found = ids(text)
        digest = sha256(np.array(found, "<u4").tobytes()).hexdigest()
        plain = sha256(LIBRARY.decode(found, skip_special_tokens=False).encode()).hexdigest()
        want.append((number, len(found), digest, plain))
    assert sorted(tuple(r) for r in rows if r.doc_id is not None) == sorted([*want, *want])
    nameless = sorted(tuple(r)[1:] for r in rows if r.doc_id is None)
    assert nameless == sorted(w[1:] for w in want)
    assert bpe_stream.round_trip(empty_documents(spark), PATH).count() == 0
    lists = bpe_stream.encode(edge_documents(spark, ["a b", None]), PATH).collect()
    assert sorted(len(r.ids) for r in lists) == [0, 0, 0, 2, 2, 2]
