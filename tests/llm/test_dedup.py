from __future__ import annotations

import os
import random
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from documents import make_documents

from starloom.llm import anchors, near_dedup, suffix_dedup, suffix_sort
from starloom.llm.frames import buffer


def covered(rows, length):
    """Removed bytes of each (id, text), by brute force; equal rows are one place."""
    seen, out = set(), {}
    for key in sorted(set(rows), key=lambda r: (r[0] is not None, r[0] or 0)):
        raw = (key[1] or "").encode()
        gone = bytearray(len(raw))
        for i in range(len(raw) - length + 1):
            window = raw[i : i + length]
            if window in seen:
                gone[i : i + length] = b"\1" * length
            seen.add(window)
        out[key] = bytes(gone)
    return out


def check_removal(docs, rows, length, **options):
    want = covered(rows, length)
    got = suffix_dedup.deduplicate(docs, length=length, **options).collect()
    assert len(got) == len(rows)
    for row in got:
        gone = want[row.doc_id, row.text]
        raw = (row.text or "").encode()
        mark = bytearray(len(raw))
        for span in row.removed_spans:
            mark[span.start : span.stop] = b"\1" * (span.stop - span.start)
        assert bytes(mark) == gone, row.doc_id
        assert bytes(row.kept_bytes) == bytes(b for b, g in zip(raw, gone) if not g)


def test_suffix_order_is_that_of_the_strings():
    rng = np.random.default_rng(0)
    for _ in range(150):
        data = rng.integers(0, rng.choice([1, 2, 3, 256]), rng.integers(1, 300)).astype(np.uint8)
        if rng.random() < 0.5:
            data = np.tile(data[: rng.integers(1, 60)], 8)
        n = rng.integers(1, 50)
        starts = rng.integers(0, len(data), n)
        lengths = np.minimum(rng.choice([5, 40, 100]), len(data) - starts)
        groups = rng.integers(0, 3, n)
        order, lcp = suffix_sort.order(data, starts, lengths, groups)
        strings = [(int(groups[i]), data[starts[i] : starts[i] + lengths[i]].tobytes()) for i in order]
        assert strings == sorted(strings)
        for i, (group, own) in enumerate(strings):
            if i == 0 or strings[i - 1][0] != group:
                assert lcp[i] == -1
            else:
                assert lcp[i] == len(os.path.commonprefix([own, strings[i - 1][1]]))


def test_every_window_has_an_anchor_and_equal_windows_have_equal_ones():
    rng = random.Random(5)
    texts = ["".join(rng.choice("ab") for _ in range(rng.randint(0, 400))) for _ in range(20)]
    texts += [texts[3][:150] + "x" + texts[3][100:]]
    raw, offsets = buffer(pa.array(texts, pa.large_string()))
    found = anchors.find(raw, offsets, 60, 20)
    place = {}
    for text, at, span, anchor in zip(found.text, found.at, found.span, found.place):
        for start in range(at, at + span + 1):
            assert (text, start) not in place
            place[text, start] = at + anchor - start
    assert len(place) == sum(max(0, len(t) - 59) for t in texts)
    by_window = defaultdict(set)
    for (text, start), anchor in place.items():
        by_window[texts[text][start : start + 60]].add(anchor)
    assert all(len(x) == 1 for x in by_window.values())


def random_texts(seed, alphabet, n, size):
    rng = random.Random(seed)
    base = ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, size))) for _ in range(n)]
    for i in range(0, n, 3):  # copied passages at any place
        other = base[rng.randrange(n)]
        cut = rng.randint(0, max(0, len(other) - 1))
        base[i] = base[i][: len(base[i]) // 2] + other[cut : cut + rng.randint(10, 200)] + base[i][len(base[i]) // 2 :]
    return [(i, t) for i, t in enumerate(base)]


@pytest.mark.parametrize(("alphabet", "options"), [("ab", {}), ("abcdé ", {}), ("a", {}), ("abc", {"group": 2})])
def test_removed_bytes_are_those_of_brute_force(spark, alphabet, options):
    rows = random_texts(alphabet, alphabet, 40, 300)
    check_removal(make_documents(spark, rows), rows, 40, gram=12, **options)


def test_removal_on_given_documents(small):
    rows = [(r.doc_id, r.text) for r in small.collect()]
    check_removal(small.select("doc_id", "text"), rows, 100)


def test_removal_of_odd_rows(odd, nothing):
    once = suffix_dedup.deduplicate(odd).collect()
    assert len(once) == odd.count()
    twice = [r for r in once if r.doc_id == 5]
    assert len(twice) == 2 and twice[0].removed_spans == twice[1].removed_spans == []
    assert suffix_dedup.deduplicate(nothing).count() == 0
    assert suffix_dedup.apply(odd).columns == odd.columns


def test_cut_texts_hold_whole_characters(spark):
    rng = random.Random(4)
    passage = "".join(rng.choice("éàü€ñçß") for _ in range(200))
    rows = [(1, "x" + passage + "y"), (2, "zz" + passage + "é")]
    texts = {r.doc_id: r.text for r in suffix_dedup.apply(make_documents(spark, rows)).collect()}
    assert texts[1] == rows[0][1]
    assert texts[2].startswith("zz") and texts[2].endswith("é") and len(texts[2]) < 10


def brute_classes(rows):
    """Smallest id of the class of each row: equal texts, and exact similarities of all pairs of texts."""
    texts = sorted({t or "" for _, t in rows})
    row, key, count = near_dedup.shingles(pa.array([t or "" for _, t in rows], pa.large_string()))
    frequencies = np.bincount(near_dedup._bucket(key, near_dedup.DF_BUCKETS), minlength=near_dedup.DF_BUCKETS)
    idf = near_dedup.inverse(frequencies, len(rows))
    row, key, count = near_dedup.shingles(pa.array(texts, pa.large_string()))
    sets = [Counter() for _ in texts]
    for r, k, c in zip(row.tolist(), key.tolist(), count.tolist()):
        sets[r][k] = c * float(idf[(k >> 40) % near_dedup.DF_BUCKETS])
    parent = list(range(len(texts)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(texts)):
        for b in range(a):
            shared = sum((sets[a] & sets[b]).values())
            total = sum(sets[a].values()) + sum(sets[b].values()) - shared
            if total and shared >= near_dedup.SIMILARITY * total:
                parent[root(a)] = root(b)
    number = {t: root(i) for i, t in enumerate(texts)}
    first = defaultdict(list)
    for doc_id, text in rows:
        first[number[text or ""]].append(doc_id)
    return {d: min(ids) for ids in first.values() for d in ids}


def near_copies(seed, groups, copies, words):
    rng = random.Random(seed)
    rows = []
    for _ in range(groups):
        text = [f"w{rng.randrange(500)}" for _ in range(words)]
        for _ in range(copies):
            own = list(text)
            for _ in range(rng.randint(0, words // 40)):
                own[rng.randrange(words)] = f"e{rng.randrange(10_000)}"
            rows.append((len(rows), " ".join(own)))
    return rows


def agreement(got, want):
    return sum(got[d] == c for d, c in want.items()) / len(want)


@pytest.mark.parametrize("large", [near_dedup.LARGE, 4])
def test_classes_are_those_of_brute_force(spark, large):
    rows = near_copies(3, 6, 15, 120) + [(1000, "one two"), (1001, "one two"), (1002, "short")]
    found = near_dedup.classes(make_documents(spark, rows), large=large).collect()
    got = {r.doc_id: r.class_id for r in found}
    assert agreement(got, brute_classes(rows)) >= 0.97
    assert Counter(r.class_id for r in found if r.representative) == Counter(set(got.values()))


def test_classes_of_given_documents(small):
    rows = [(r.doc_id, r.text) for r in small.collect()]
    got = {r.doc_id: r.class_id for r in near_dedup.classes(small).collect()}
    assert got == brute_classes(rows)


def test_samples_agree_as_often_as_texts_are_similar():
    rng = random.Random(9)
    base = [f"w{i}" for i in range(300)]
    other = [w if rng.random() > 0.02 else f"x{i}" for i, w in enumerate(base)]
    texts = pa.array([" ".join(base), " ".join(other)], pa.large_string())
    idf = np.ones(near_dedup.DF_BUCKETS, np.float32)
    row, key, count = near_dedup.shingles(texts)
    similarity = near_dedup.similarities(texts[:1], texts[1:], idf)[0]
    drawn = [near_dedup.samples(row, key, count.astype(np.float32), 2, k) for k in range(64)]
    assert abs(np.mean([a == b for a, b in drawn]) - similarity) < 0.17


def test_blocks_of_a_bucket_find_the_same_links(spark, monkeypatch):
    rows = near_copies(8, 1, 40, 80)
    docs = make_documents(spark, rows)
    whole = {r.doc_id: r.class_id for r in near_dedup.classes(docs).collect()}
    monkeypatch.setattr(near_dedup, "BLOCK_TEXTS", 7)
    assert {r.doc_id: r.class_id for r in near_dedup.classes(docs).collect()} == whole


def test_near_dedup_of_odd_rows(odd, nothing):
    found = near_dedup.classes(odd).collect()
    assert len(found) == odd.count()
    kept = near_dedup.keep_one(odd)
    assert kept.columns == odd.columns
    texts = [r.text for r in kept.collect()]
    assert texts.count("the same text twice, row for row, and long enough to be found as a repeated string of bytes, yes") == 1
    assert near_dedup.classes(nothing).count() == near_dedup.keep_one(nothing).count() == 0


def test_a_text_can_repeat_itself(spark):
    rows = [(1, "a" * 150), (2, "b" + "a" * 120)]
    kept = {r.doc_id: bytes(r.kept_bytes) for r in suffix_dedup.deduplicate(make_documents(spark, rows)).collect()}
    assert kept == {1: b"a", 2: b"b"}


def test_classes_of_a_table_with_every_row_twice(spark):
    rng = random.Random(12)
    rows = []
    for i in range(12):  # pairs of texts of the same size, so that only the members tell the buckets apart
        own = ["".join(rng.choices("abcdefgh", k=6)) for _ in range(61)]
        rows += [(2 * i, " ".join(own[:60])), (2 * i + 1, " ".join([*own[:59], own[60]]))]
    docs = make_documents(spark, rows)
    found = near_dedup.classes(docs.union(docs)).collect()
    assert len(found) == 48
    assert all(r.class_id == r.doc_id // 2 * 2 and r.class_size == 4 for r in found)
    assert near_dedup.keep_one(docs.union(docs)).count() == 12
