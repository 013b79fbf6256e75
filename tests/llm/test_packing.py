from __future__ import annotations

import collections
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from starloom.llm import packing, units
from starloom.llm.frames import Scratch

LIBRARY = units.library(packing.TOKENIZER)


def ids_of(text):
    return [*LIBRARY([text or ""])[0].tolist(), packing.END]


WORDS = [
    "The", "WORD,", "end.", "...", "<|endoftext|>", "<|ENDOFTEXT|>", "x<|startoftext|>,", "don't", "it's.", "'s", "Σ", "ΑΣ.", "é", "é,",
    "naïve!?", "12,5", "3.", "a" * 90, "日本語", "İ.", "K,", "\x1c", "a\x1fb.", "\xa0x", "x　y.", "A.B.", "á.", "<|.",
]


@pytest.mark.parametrize("bite", [8 << 20, 40])
def test_ids_are_those_of_the_library(monkeypatch, bite):
    monkeypatch.setattr(packing, "BITE", bite)
    rng = random.Random(bite)
    texts = ["", " ", "\n a ", *(" ".join(rng.choice(WORDS) + rng.choice(["", " ", "\n\n", "\t"]) for _ in range(rng.randint(1, 60))) for _ in range(80))]
    made = collections.defaultdict(list)
    for row, piece, start, own in packing.documents(texts, packing.TOKENIZER, packing.END, 16):
        assert (piece, start) == (len(made[row]) // 16, len(made[row])) and 0 < len(own) <= 16
        made[row] += own.tolist()
    assert [made[row] for row in range(len(texts))] == [ids_of(t) for t in texts]


def fewest(lengths, capacity):
    """Sequences of best fit decreasing."""
    gaps, opened = collections.Counter(), 0
    for length in sorted(lengths, reverse=True):
        gap = next((g for g in range(length, capacity) if gaps[g]), None)
        if gap is None:
            opened, gap = opened + 1, capacity
        else:
            gaps[gap] -= 1
        gaps[gap - length] += 1
    return opened


def sized(spark, lengths):
    return spark.createDataFrame(list(enumerate(lengths)), "item long, length long")


rng = np.random.default_rng(5)
CASES = {
    "mixed": np.minimum(np.exp(rng.normal(4, 1.2, 900)).astype(int) + 1, 128).tolist(),
    "equal": [45] * 300,
    "tiny": [1] * 500 + [2] * 300,
    "one": [7],
}


@pytest.mark.parametrize("case", CASES)
def test_rounds_fill_sequences(spark, case):
    lengths = CASES[case]
    places, _ = packing.rounds(sized(spark, lengths), 128, Scratch(spark))
    rows = places.collect()
    assert sorted(r["item"] for r in rows) == list(range(len(lengths)))
    used = collections.Counter()
    for r in rows:
        assert r["length"] == lengths[r["item"]]
        used[r["sequence_id"]] += r["length"]
    assert max(used.values()) <= 128
    assert len(used) <= 1.03 * fewest(lengths, 128) + 1


def test_ranges_link_last_in_first_out():
    over = [(0, packing.ROOM, None, 3), (1, packing.ALONE, 9, 1), (1, packing.ALONE, 8, 1), (1, packing.ROOM, None, 1), (2, packing.ALONE, 5, 4)]
    links, rest = packing.link_ranges(over)
    assert links == [(1, 0, 2, 0, 2), (2, 0, 1, 1, 0), (2, 1, 1, 0, 0)]
    assert rest == {5: 2}


def check(rows, texts):
    """Pieces are whole and in order, and places gapless from 0."""
    by_text, by_sequence = collections.defaultdict(list), collections.defaultdict(list)
    for r in rows:
        by_text[r.doc_id].append(r)
        by_sequence[r.sequence_id].append(r)
    for doc_id, own in by_text.items():
        wanted = collections.Counter()
        for text in texts[doc_id]:
            ids = ids_of(text)
            for piece, start in enumerate(range(0, len(ids), packing.CAPACITY)):
                part = np.array(ids[start : start + packing.CAPACITY], "<u4")
                wanted[piece, start, len(part), zlib.crc32(part.tobytes())] += 1
        assert collections.Counter((r.piece, r.start, r.length, r.ids_crc32) for r in own) == wanted
    for own in by_sequence.values():
        at = 0
        for r in sorted(own, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= packing.CAPACITY
    assert by_text.keys() == texts.keys()


def test_pack_odd_rows_and_the_given_table(spark, small, odd, nothing):
    for df in (odd.withColumn("item", F.lit("x")).withColumn("Offset", F.lit("x")), small):
        texts = collections.defaultdict(list)
        for r in df.select("doc_id", "text").collect():
            texts[r.doc_id].append(r.text)
        packed = packing.pack(df)
        rows = packed.collect()
        assert ("item" in packed.columns) == ("item" in df.columns) and packed.columns.count("offset") == 1
        check(rows, texts)
        assert all(zlib.crc32(np.array(r.ids, "<u4").tobytes()) == r.ids_crc32 for r in rows)
    assert packing.pack(nothing).count() == 0
