from __future__ import annotations

import collections
import hashlib
import random

import numpy as np
import pytest

from starloom.llm import alignment as al
from starloom.llm import units

ODD_TEXTS = [
    "", " ", "  a  b ", "a\n b\t c", "▁x y", "<|endoftext|> <s> </s> <unk> <0x41>", "é́ ñ  \x00x", "tab\t tab \n\n x",
    "\xa0 a\xa0 b", "a 　 b", " lead", "trail ", "日本語 テキスト", "\x85 x\x85 y", "\x1c x\x1c y",
    "don't 's ' s", "a" * 300, "word, and Word\n more " * 400, "x  " * 500,
]


def brute(text):
    """n_a, n_b, groups, links, hash and pair counts from the libraries' ids of the whole text."""
    first, second = al.byte_level(al.BYTE_LEVEL), al.piece_level(al.PIECES)
    a = units.library(al.BYTE_LEVEL, True)([" " + (text or "")])[0].tolist() if text else []
    b = al._model(al.PIECES).encode(text) if text else []
    want = (" " + (text or "")).encode()
    if not text or first.joined(np.array(a)).tobytes() != want or second.joined(np.array(b)).tobytes() != want:
        return 0, 0, 0, 0, "", {}
    ends_a, ends_b = np.cumsum(first.width[a]).tolist(), np.cumsum(second.width[b]).tolist()
    groups, pairs, i, j = [], collections.Counter(), 0, 0
    for end in sorted(set(ends_a) & set(ends_b)):
        k, m = ends_a.index(end) + 1, ends_b.index(end) + 1
        groups.append(",".join(map(str, a[i:k])) + "|" + ",".join(map(str, b[j:m])))
        pairs[a[k - 1], b[m - 1]] += 1
        i, j = k, m
    sha = hashlib.sha256(";".join(groups).encode()).hexdigest()
    return len(a), len(b), len(groups), len(groups), sha, dict(pairs)


def plain(found):
    return *found[1:6], {(a, b): n for a, b, n in found[6].T.tolist()}


@pytest.mark.parametrize("bite", [1 << 20, 50])
def test_documents_equal_brute_force(monkeypatch, bite):
    """Also in stretches, as very long texts are taken."""
    monkeypatch.setattr(al, "BITE", bite)
    rng = random.Random(bite)
    texts = [*ODD_TEXTS, *("".join(rng.choice("ab ,.\n\té▁ ") for _ in range(60)) for _ in range(60))]
    for found in al.documents(texts, al.BYTE_LEVEL, al.PIECES):
        assert plain(found) == brute(texts[found[0]]), texts[found[0]][:40]


def test_widths_add_up_for_every_id():
    book = al.byte_level(al.BYTE_LEVEL)
    assert sorted(book.width)[0] > 0 and al.byte_of()["Ġ"] == 32
    assert set(al.byte_of().values()) == set(range(256))


def expected(rows):
    """Results for (doc_id, text) rows: counts of pairs over all rows."""
    found = [(doc_id, brute(text)) for doc_id, text in rows]
    total = collections.Counter()
    for _, (*_, pairs) in found:
        total.update(pairs)
    top = collections.Counter()
    for (_, b), n in total.items():
        top[b] = max(top[b], n)
    return sorted(
        (
            (doc_id, *counts[:4], sum(n for p, n in pairs.items() if total[p] == top[p[1]]),
             sum(n * total[p] for p, n in pairs.items()), counts[4])
            for doc_id, (*counts, pairs) in found
        ),
        key=str,
    ), total


@pytest.mark.parametrize("bound", [al.BROADCAST_PAIRS, 0])
def test_compare_equals_brute_force(spark, small, odd, bound):
    """Broadcast and joined pairs alike; repeated rows, nulls and clashing columns included."""
    for df in (small, odd):
        rows = [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]
        wanted, total = expected(rows)
        found, pairs = al.compare(df.withColumn("number", al.F.lit(1)).withColumn("Pairs", al.F.lit(2)), broadcast_pairs=bound)
        assert "number" in found.columns and found.columns.count("n_a") == 1
        got = found.select("doc_id", *al._OUT).collect()
        assert sorted((tuple(r) for r in got), key=str) == wanted
        assert {(r.a, r.b): r.links for r in pairs.collect()} == dict(total)


def test_an_empty_table_has_no_rows(nothing):
    for bound in (al.BROADCAST_PAIRS, 0):
        assert al.compare(nothing, broadcast_pairs=bound)[0].count() == 0
