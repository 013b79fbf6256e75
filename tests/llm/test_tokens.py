from __future__ import annotations

import base64
import random
import time

import numpy as np
import public_tokenizers as P
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from starloom.llm import byte_bpe, token_counts

RANKS = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(byte_bpe.RANKS, "rb"))}
REFERENCE = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=RANKS, special_tokens={})


def encoded(texts):
    ids, offsets = byte_bpe.encode_texts(texts, byte_bpe.RANKS, P.PATTERN)
    return [ids[a:b].tolist() for a, b in zip(offsets, offsets[1:])]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(max_size=200), max_size=5))
def test_any_text_has_the_ids_of_the_public_encoder(texts):
    assert encoded(texts) == [REFERENCE.encode_ordinary(t) for t in texts]


@pytest.mark.parametrize("letters", ["a", "ab", "abc", "the", "aeinrst", "é€x"])
def test_very_long_pre_tokens(letters):
    rng = random.Random(letters)
    text = "".join(rng.choice(letters) for _ in range(20_000))
    assert encoded([text]) == [REFERENCE.encode_ordinary(text)]


@pytest.mark.parametrize("letters", ["ple", "an", "st", "il", "the", "en", "aaab"])
@pytest.mark.parametrize("size", [byte_bpe.LONG - 1, byte_bpe.LONG + 1, 6_001])
def test_long_runs_of_ranks_that_make_lower_ones(letters, size):
    text = (letters * size)[:size]
    assert encoded([f"x {text}", text, "y"]) == [REFERENCE.encode_ordinary(t) for t in (f"x {text}", text, "y")]


@pytest.mark.parametrize("letters", ["ple", "an", None])
def test_time_is_linear_in_a_pre_token(letters):
    book, rng = byte_bpe.vocabulary(byte_bpe.RANKS), random.Random(1)
    def spent(size):
        piece = (letters * size if letters else "".join(rng.choices("etaoinshrdlu", k=size)))[:size].encode()
        begin = time.process_time()
        book.encode([piece])
        return time.process_time() - begin
    spent(1_000)
    assert spent(240_000) < 3.5 * spent(120_000) + 0.3


def test_queue_returns_ranks_in_order_and_all_positions():
    queue = byte_bpe.RankQueue(50_000)
    rng = np.random.default_rng(1)
    ranks = rng.integers(0, 50_000, 2_000)
    for i, r in enumerate(ranks):
        queue.push(int(r), np.array([i]))
    seen = []
    while (got := queue.pop()) is not None:
        seen += [(got[0], p) for p in got[1].tolist()]
    assert sorted(seen) == sorted(zip(ranks.tolist(), range(2_000)))
    assert [r for r, _ in seen] == sorted(r for r, _ in seen)


def test_round_trip_of_odd_rows(odd, nothing):
    rows = byte_bpe.decode(byte_bpe.encode(odd)).select("text", "ids", "decoded").collect()
    assert len(rows) == odd.count()
    for row in rows:
        assert row.ids == REFERENCE.encode_ordinary(row.text or "")
        assert bytes(row.decoded) == (row.text or "").encode()
    assert byte_bpe.encode(nothing).count() == 0


MODEL = token_counts.counter(token_counts.MODEL)
ALPHABETS = ["abc de", "a ", " \n\t", "ab▁ ", "é€ x", "etaoin shrdlu " * 2, "abcdefgh" * 20 + " "]


@pytest.mark.parametrize("alphabet", ALPHABETS)
@pytest.mark.parametrize(("chunk", "overlap"), [(50, 4), (300, 16), (1000, 64)])
def test_spliced_counts_are_those_of_the_whole_text(alphabet, chunk, overlap):
    rng = random.Random(alphabet)
    for size in (chunk + 1, 3 * chunk, 10 * chunk + 7):
        text = "".join(rng.choice(alphabet) for _ in range(size))
        assert MODEL.count(text, chunk, overlap) == len(MODEL.model.encode(text))


def test_places_that_no_piece_crosses():
    assert MODEL.stable("word and", 0, 8) == 4 and MODEL.stable("theword", 0, 7) is None
    pieces = [MODEL.model.id_to_piece(i).replace("▁", " ") for i in range(300, 3_000)]
    assert all(MODEL.stable(p, 0, len(p)) is None for p in pieces)


@pytest.mark.parametrize("alphabet", ["etaoinshrdlu", "日本語学校東京都人大小中国一二三", "an", "ABCDEFabcdef0123456789+/"])
def test_texts_without_spaces_take_linear_time(alphabet):
    rng = random.Random(alphabet)
    text = "".join(rng.choices(alphabet, k=400_000))
    assert MODEL.count(text[:100_000], 3_000, 64) == len(MODEL.model.encode(text[:100_000]))
    def spent(size):
        begin = time.process_time()
        MODEL.count(text[:size])
        return time.process_time() - begin
    spent(1_000)
    assert spent(400_000) < 3.5 * spent(200_000) + 0.3


def test_counts_of_odd_rows(odd, nothing):
    rows = token_counts.count_tokens(odd, chunk=200, overlap=8).select("text", "n_tokens").collect()
    assert len(rows) == odd.count()
    assert all(r.n_tokens == len(MODEL.model.encode(r.text or "")) for r in rows)
    assert token_counts.count_tokens(nothing).count() == 0
