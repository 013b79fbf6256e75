from __future__ import annotations

import random

import numpy as np
import pyarrow as pa
import pytest
from documents import make_documents

import corpus_pipeline
from starloom.llm import decontaminate, near_dedup, queries
from starloom.llm.frames import table

BENCHMARK = "item_id long, text string"


def lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        last = 0
        for j, y in enumerate(b):
            last, row[j + 1] = row[j + 1], last + 1 if x == y else max(row[j + 1], row[j])
    return row[-1]


def test_common_subsequence():
    rng = np.random.default_rng(2)
    for _ in range(200):
        a, b = (rng.integers(0, 5, rng.integers(1, 70)).astype(np.uint64) for _ in range(2))
        assert decontaminate.common_subsequence(a, b) == lcs(a.tolist(), b.tolist())


def words(rng, n, vocabulary="v", size=20_000):
    common = ["the", "of", "and", "to", "in", "is"]
    return [rng.choice(common) if rng.random() < 0.4 else f"{vocabulary}{rng.randrange(size)}" for _ in range(n)]


def test_copies_and_paraphrases_are_found_and_clean_texts_left(spark):
    rng = random.Random(6)
    items = [(i, " ".join(words(rng, rng.randint(15, 60), "b"))) for i in range(30)]
    rows, leaking = [], set()
    for i in range(120):
        text = words(rng, rng.randint(30, 900))
        kind = i % 3
        if kind:
            item = items[i % 30][1].split()
            if kind == 2:  # a paraphrase: every sixth word another one, the end as it was
                item = [w if k % 6 or k > len(item) - 8 else f"p{k}" for k, w in enumerate(item)]
            cut = rng.randrange(len(text))
            text[cut:cut] = item
            leaking.add((i, items[i % 30][0]))
        rows.append((i, " ".join(text)))
    docs, benchmark = make_documents(spark, rows), spark.createDataFrame(items, BENCHMARK)
    found = {(r.doc_id, x.item_id) for r in decontaminate.with_leaks(docs, benchmark).collect() for x in r.leaks}
    assert len(found & leaking) / len(leaking) >= 0.95 and not found - leaking


def tf_idf(words, queries_, idf):
    rows = np.zeros((len(words), len(queries_.vocabulary)))
    for row, own in zip(rows, words):
        np.add.at(row, np.searchsorted(queries_.vocabulary, own), 1)
    return np.sqrt(rows) * idf


def topics(rng, n, words_of, topic=None):
    """n words of a topic, each of its 12 meanings in a form that ``words_of`` picks, among words of its own."""
    topic = rng.randrange(120) if topic is None else topic
    return [f"t{topic}m{rng.randrange(12)}{words_of(rng)}" if rng.random() < 0.7 else f"z{rng.randrange(40_000)}" for _ in range(n)]


def test_paraphrases_in_other_words_are_candidates(spark, monkeypatch):
    """Queries in one form of each word, passages in the other: no word in common, but the same latent place."""
    monkeypatch.setattr(decontaminate, "STOP_SHARE", 0.5)
    rng = random.Random(4)
    both, one, other = (lambda r: r.choice("ab")), (lambda r: "a"), (lambda r: "b")
    rows = [(i, " ".join(topics(rng, 80, both))) for i in range(4_000)]
    planted = [(5_000 + t, " ".join(topics(rng, 64, other, t))) for t in range(120)]
    items = [(t, " ".join(topics(rng, 60, one, t))) for t in range(120)]
    docs = make_documents(spark, rows + planted)
    frequency, n = decontaminate.frequencies(docs, "text")
    idf = decontaminate.idf_of(frequency, n)
    sample = decontaminate.sample_passages(docs, "text", idf, n, decontaminate.Scratch(spark))
    basis = decontaminate.latent_basis(sample)
    assert basis.shape[1] == decontaminate.RANK < sample.count() // 4
    assert np.abs(basis.T @ basis - np.eye(basis.shape[1])).max() < 1e-3
    # The space is that of a full decomposition: the same directions down to the size of the noise.
    dense = np.zeros((sample.count(), decontaminate.LATENT_BUCKETS), np.float32)
    for row, r in zip(dense, sample.collect()):
        row[r.buckets] = r.weights
    _, values, exact = np.linalg.svd(dense[:, dense.any(0)], full_matrices=False)
    kept = np.linalg.norm(dense @ basis) ** 2 / (values[: basis.shape[1]] ** 2).sum()
    assert 0.85 <= kept <= 1 + 1e-4
    queries_ = decontaminate.Queries.of(*map(list, zip(*items)), [None] * len(items))
    space = decontaminate.build_space(queries_, idf, basis)
    hashes, before = decontaminate.word_hashes(pa.array([t for _, t in planted], pa.large_string()))
    first, last, query, score = decontaminate.latent_candidates(hashes, before, queries_, space)
    owner = np.searchsorted(before, first, "right") - 1
    got = set(zip(owner.tolist(), query.tolist()))
    # Brute force: every passage and query projected on the leading directions of the full decomposition.
    full = np.zeros((decontaminate.LATENT_BUCKETS, basis.shape[1]))
    full[dense.any(0)] = exact[: basis.shape[1]].T

    def placed(words):
        vector = (full[decontaminate._latent_bucket(words)] * idf[decontaminate._bucket(words)][:, None]).sum(0)
        return vector / np.linalg.norm(vector)

    parts = [placed(hashes[a:b]) for a, b in zip(before, before[1:])]
    limit = decontaminate.LATENT_COSINE
    want = {(i, j) for i, p in enumerate(parts) for j, w in enumerate(queries_.words) if p @ placed(w) >= limit}
    paraphrases = {(t, t) for t in range(120)}
    assert len(want & paraphrases) >= 100 and len(got & want) / len(want) >= 0.9
    assert len(got - paraphrases) <= 60
    plain = decontaminate.candidates(hashes, before, queries_, space, 0.35)
    assert not len(plain[0])


def test_search_recall_against_brute_force(spark):
    """Plain candidates against exact TF-IDF cosines of all passages."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = docs.select("text").collect()
    items = spark.read.parquet("/root/testdata/sf0.01/benchmark.parquet").orderBy("item_id").collect()
    queries_ = decontaminate.Queries.of([r.item_id for r in items], [r.text for r in items], [None] * len(items))
    frequency, n = decontaminate.frequencies(docs, "text")
    assert n == len(rows)
    space = decontaminate.build_space(queries_, decontaminate.idf_of(frequency, n), np.zeros((decontaminate.LATENT_BUCKETS, 1), np.float32))
    hashes, before = decontaminate.word_hashes(pa.array([r.text for r in rows], pa.large_string()))
    first, last, query, _ = decontaminate.candidates(hashes, before, queries_, space)
    got = set(zip(first.tolist(), last.tolist(), query.tolist()))
    own = space.idf[decontaminate._bucket(queries_.vocabulary)]
    bench = tf_idf(queries_.words, queries_, own)
    bench /= np.linalg.norm(bench, axis=1, keepdims=True)
    lengths = np.array([len(w) for w in queries_.words])
    want = set()
    for scale, (size, step) in enumerate(decontaminate.SCALES):
        chosen = np.flatnonzero((lengths <= decontaminate.SHORT) == (scale == 0))
        for a, b in zip(before[:-1].tolist(), before[1:].tolist()):
            starts = [s for s in range(a, b, step) if s == a or s - step + size < b]
            for start in starts:
                part = hashes[start : min(start + size, b)]
                known = part[np.isin(part, queries_.vocabulary)]
                norm = np.sqrt((space.idf[decontaminate._bucket(part)].astype(float) ** 2).sum())
                if not norm or not len(known):
                    continue
                scores = bench[chosen] @ tf_idf([known], queries_, own)[0] / norm
                want |= {(start, min(start + size, b), int(q)) for q in chosen[scores >= decontaminate.COSINE + 1e-3]}
    assert want and len(got & want) / len(want) >= 0.98


def test_blocks_of_the_benchmark(spark, monkeypatch):
    folder = "/root/testdata/sf0.001"
    docs, benchmark = table(spark, folder, "documents"), table(spark, folder, "benchmark")
    whole = {r.doc_id: sorted(x.item_id for x in r.leaks) for r in decontaminate.with_leaks(docs, benchmark).collect()}
    monkeypatch.setattr(decontaminate, "BLOCK", 7)
    parts = {r.doc_id: sorted(x.item_id for x in r.leaks) for r in decontaminate.with_leaks(docs, benchmark).collect()}
    assert whole == parts and any(whole.values())


def test_short_items_among_rarer_words_are_found(spark):
    items = [(5, "alpha beta gamma delta epsilon"), (10, " ".join(f"k{i}" for i in range(10)))]
    rng = random.Random(3)
    rows, leaking = [], set()
    for i in range(200):
        text = [f"u{i}x{k}" for k in range(80)]
        own = (items[0][1] + " " + items[1][1]).split()
        rng.shuffle(own)
        if i < 20:  # exact copies
            own = items[i % 2][1].split()
            leaking.add((i, items[i % 2][0]))
        elif i < 30:  # one word is another
            own = items[1][1].replace("k4", f"v{i}").split()
            leaking.add((i, 10))
        elif i >= 60:
            own = []
        step = 1 if i < 30 else 5
        for k, word in enumerate(own):
            text.insert(20 + i % 12 + k * step, word)
        rows.append((i, " ".join(text)))
    docs, benchmark = make_documents(spark, rows), spark.createDataFrame(items, BENCHMARK)
    found = {(r.doc_id, x.item_id) for r in decontaminate.with_leaks(docs, benchmark).collect() for x in r.leaks}
    assert found == leaking


def test_texts_that_share_words_only_with_queries_of_another_scale(spark):
    """No word of their passages is one of the queries that are searched with passages of that size."""
    items = {1: [f"s{k}" for k in range(12)], 2: [f"l{k}" for k in range(50)]}
    benchmark = spark.createDataFrame([(i, " ".join(x)) for i, x in items.items()], BENCHMARK)
    for item, own in items.items():
        docs = make_documents(spark, [(5, " ".join(own))])
        (row,) = decontaminate.with_leaks(docs, benchmark).collect()
        assert [x.item_id for x in row.leaks] == [item]


def test_many_queries_are_searched_in_one_pass(spark):
    """Exact copies of thousands of queries have a plain cosine of 1, and a benchmark of them is one block."""
    rng = random.Random(8)
    items = [(i, " ".join(words(rng, 130, "b"))) for i in range(2_500)]
    (block,) = decontaminate._blocks(spark.createDataFrame(items, BENCHMARK), "item_id", "text", None)
    assert len(block.words) == 5_000
    none = np.zeros((decontaminate.LATENT_BUCKETS, 1), np.float32)
    space = decontaminate.build_space(block, np.ones(decontaminate.DF_BUCKETS, np.float32), none)
    assert np.bincount(space.query, space.weight**2) == pytest.approx(1)
    some = block.words[::50]
    before = np.concatenate([[0], np.cumsum([len(w) for w in some])])
    first, _, query, score = decontaminate.candidates(np.concatenate(some), before, block, space)
    best = {int(f): (int(q), s) for f, q, s in sorted(zip(first, query, score), key=lambda x: x[2])}
    assert [best[int(b)][0] for b in before[:-1]] == list(range(0, 5_000, 50))


def test_an_item_of_many_queries_is_reported_once(spark, monkeypatch):
    monkeypatch.setattr(decontaminate, "BLOCK_QUERIES", 100)
    item = [f"w{i}" for i in range(16_000)]
    rows = [(1, " ".join(item[64:192] + [f"x{i}" for i in range(300)] + item[15_872:15_936])), (2, "y " * 100)]
    benchmark = spark.createDataFrame([(7, " ".join(item)), (8, "z " * 30)], BENCHMARK)
    assert len(list(decontaminate._blocks(benchmark, "item_id", "text", None))) > 1
    found = {r.doc_id: r.leaks for r in decontaminate.with_leaks(make_documents(spark, rows), benchmark).collect()}
    assert [(x.item_id, x.lcs_share) for x in found[1]] == [(7, 1.0)] and found[2] == []


def test_leaks_of_odd_rows(spark, odd, nothing):
    benchmark = spark.createDataFrame(
        [(1, None), (2, ""), (3, "!!!"), (4, "the same text twice, row for row, and long enough"), (4, "the same text twice"), (None, "x y z")],
        BENCHMARK,
    )
    found = decontaminate.with_leaks(odd, benchmark)
    assert set(found.columns) == set(odd.columns)
    rows = found.collect()
    assert len(rows) == odd.count()
    assert [len(r.leaks) for r in rows if r.doc_id == 5] == [1, 1]
    assert decontaminate.with_leaks(nothing, benchmark).count() == 0
    assert all(r.leaks == [] for r in decontaminate.with_leaks(odd, benchmark.limit(0)).collect())


def test_pipeline_on_given_documents(spark):
    folder = "/root/testdata/sf0.001"
    docs = table(spark, folder, "documents")
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES:
        before = docs.count()
        docs = near_dedup.materialise(stage(spark, docs, folder), "test-stage")
        assert 0 < docs.count() <= before, name
        if name != corpus_pipeline.STAGES[-1][0]:
            assert docs.columns == columns
        assert docs.where("n_chars <> length(text)").count() == 0
    assert docs.groupBy("doc_id").count().where("count > 1").count() == 0
    assert "ids" in docs.columns


def test_pipeline_on_odd_rows(spark, odd, nothing, monkeypatch):
    folder = "/root/testdata/sf0.001"
    for docs in (odd, nothing):
        for _, stage in corpus_pipeline.STAGES:
            docs = near_dedup.materialise(stage(spark, docs, folder), "test-stage")
        assert docs.count() <= odd.count()


def test_every_dealt_operator_has_a_query(spark):
    names = {n.split("_")[0] for n in queries.queries()}
    assert names == {f"op{i}" for i in range(1, 14)}


def test_the_latent_space_is_made_of_every_passage_of_every_distinct_text(spark):
    """Words that only the end of one long text among many has, and a text in many copies."""
    rng = random.Random(9)
    long = [f"w{rng.randrange(3000)}" for _ in range(64 * 40)] + ["last"] * 20
    rows = [(i, " ".join(words(rng, 200))) for i in range(20_000)] + [(30_000, " ".join(long))]
    copy = " ".join(f"c{k}" for k in range(64))
    docs = make_documents(spark, rows + [(40_000 + i, copy) for i in range(500)]).repartition(7)
    frequency, n = decontaminate.frequencies(docs, "text")
    idf = np.ones_like(decontaminate.idf_of(frequency, n))
    scratch = decontaminate.Scratch(spark)
    passages = decontaminate.every_passage(docs, "text", idf, n, scratch)
    own = {w: int(decontaminate._latent_bucket(decontaminate.word_hashes(pa.array([w], pa.large_string()))[0])[0]) for w in ("last", "c7")}
    found = passages.toArrow()
    # 200 words are three passages, the last one with eight words more; 2580 are 40, the last with 20 more.
    assert found.num_rows == 20_000 * 3 + 40 + 1
    weights = [dict(zip(b.as_py(), w.as_py())) for b, w in zip(found.column("buckets"), found.column("weights"))]
    assert max(w.get(own["last"], 0) for w in weights) > 0.9
    assert np.allclose([sum(x * x for x in w.values()) for w in weights[::1000]], 1, atol=1e-2)
    scratch.clear()
