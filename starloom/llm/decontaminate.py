"""Benchmark decontamination by latent semantic retrieval and longest common subsequences.

Texts are sequences of plain words (runs of letters and digits, lower-case). A passage is a window
of words with a TF-IDF vector, idf counted over all documents in a table of ``DF_BUCKETS`` hashed
buckets. Words in more than ``STOP_SHARE`` of the documents (and ``STOP_LEAST`` documents) weigh nothing,
except those of items that have hardly any others.

1. One pass over all documents counts document frequencies.
2. A randomised SVD of the corpus' passages gives a latent space in which words that stand in the same
   passages are close. It is fitted on all passages of all distinct texts, over ``LATENT_BUCKETS`` hashed
   words: tasks add up Y = A'(A O) for a random O by bucket, the sums are grouped by bucket, one power
   iteration does the same with the orthonormal Y, and a Nystrom step rotates and cuts the basis to ``RANK``
   columns. A task takes about ``TASK_PASSAGES``, so what the tasks write is a fixed share of the corpus.
3. One more pass over all documents finds candidates in three ways: passages and items whose latent vectors
   have a cosine of ``LATENT_COSINE`` (also those without a word in common), those whose plain TF-IDF
   vectors have one of ``COSINE`` (by an inverted index of the items; the norm over words of the benchmark
   rules most passages out by two running sums, without loss), and exact copies of items of up to
   ``SHORT`` words, whatever stands around them. Queries of up to ``TINY`` words are searched with passages of
   their own size as well.
4. Candidates are checked on their words: the longest common subsequence with the item, and for
   paraphrases also the words of the item's answer.

A benchmark is searched in one pass up to ``BLOCK`` items and ``BLOCK_QUERIES`` queries, which bounds what
is broadcast; a larger one in blocks of that size.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom.llm import hashing
from starloom.llm.frames import Scratch, bites, buffer, free, key_blocks, map_batches, spread, utf8, with_columns

DF_BUCKETS = 1 << 17
#: Words of a passage and between the starts of passages; short items are searched with short passages.
SCALES = ((24, 12), (64, 32))
#: Items of up to so many words are searched at the first scale.
SHORT = 28
#: Passages for queries of up to ``TINY`` words, which are searched at the first scale as well.
TINY_SCALE = (12, 3)
TINY = 14
#: Items are cut into queries of at most so many words.
QUERY = 64
STOP_SHARE = 0.01
STOP_LEAST = 50
#: Rarer words that an item must have for its stop words to weigh nothing.
RARE_WORDS = 4
#: Hashed words that the latent space spans, its columns, and columns more while it is made.
LATENT_BUCKETS = 1 << 15
RANK, EXTRA = 128, 8
#: Passages of a task that makes the space: each task writes up to a whole basis of partial sums.
TASK_PASSAGES = 150_000
#: Words of a passage and between passages in the latent search.
LATENT_SCALE = (64, 32)
LATENT_COSINE = 0.8
COSINE = 0.35
COPY = 0.8
PARAPHRASE = 0.6
ANSWER = 0.6
BLOCK = 20_000
BLOCK_QUERIES = 50_000

LEAKS = T.ArrayType(
    T.StructType(
        [
            T.StructField("item_id", T.LongType()),
            T.StructField("cosine", T.DoubleType()),
            T.StructField("lcs_share", T.DoubleType()),
            T.StructField("answer_share", T.DoubleType()),
            T.StructField("first_word", T.IntegerType()),
            T.StructField("words", T.IntegerType()),
        ]
    )
)
_LEAK_TYPE = pa.list_(
    pa.struct(
        [("item_id", pa.int64()), ("cosine", pa.float64()), ("lcs_share", pa.float64()), ("answer_share", pa.float64()),
         ("first_word", pa.int32()), ("words", pa.int32())]
    )
)


#: Places of words of a vocabulary, and their numbers in it.
Places = tuple[np.ndarray, np.ndarray]


def word_hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of all texts, and the number of words before each text."""
    raw, offsets = buffer(pc.utf8_lower(texts))
    begin, end, before = hashing.words(raw, offsets, hashing.IS_PLAIN)
    return hashing.Prefix(raw).of(begin, end), before


def _bucket(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> np.uint64(64 - 17)).astype(np.int64)


@dataclass
class Queries:
    """A block of the benchmark: queries of at most ``QUERY`` words over a vocabulary of their own."""

    item_id: np.ndarray
    words: list[np.ndarray]
    answers: list[np.ndarray]
    vocabulary: np.ndarray  # sorted hashes
    some: np.ndarray  # whether a bucket has a word of the vocabulary

    @classmethod
    def of(cls, item_ids: list[int], texts: list[str], answers: list[str | None]) -> Queries | None:
        return next(cls.blocks_of(item_ids, texts, answers, None), None)

    @classmethod
    def blocks_of(
        cls, item_ids: list[int], texts: list[str], answers: list[str | None], most: int | None
    ) -> Iterator[Queries]:
        """The items in blocks of at most ``most`` queries; a long item may be spread over several."""
        ids, words, own_answers = [], [], []
        for item, text, answer in zip(item_ids, texts, answers):
            hashes, _ = word_hashes(pa.array([text], pa.large_string()))
            wanted, _ = word_hashes(pa.array([answer_of(text) if answer is None else answer], pa.large_string()))
            for at in range(0, len(hashes), QUERY):
                # What is left behind the last full query is joined to it, so that no query is a stub.
                if at and len(hashes) - at < QUERY // 2:
                    words[-1] = np.concatenate([words[-1], hashes[at:]])
                    continue
                ids.append(item)
                words.append(hashes[at : at + QUERY])
                own_answers.append(np.unique(wanted))
        for at in range(0, len(ids), most or max(len(ids), 1)):
            part = slice(at, at + most if most else None)
            vocabulary = np.unique(np.concatenate(words[part]))
            some = np.zeros(DF_BUCKETS, bool)
            some[_bucket(vocabulary)] = True
            yield cls(np.array(ids[part], np.int64), words[part], own_answers[part], vocabulary, some)

    def look_up(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places in ``hashes`` of words of the vocabulary, and their numbers."""
        maybe = np.flatnonzero(self.some[_bucket(hashes)])
        at = np.minimum(np.searchsorted(self.vocabulary, hashes[maybe]), len(self.vocabulary) - 1)
        hit = self.vocabulary[at] == hashes[maybe]
        return maybe[hit], at[hit]


def answer_of(text: str) -> str:
    """The last sentence, or the last five words if it has fewer than three."""
    sentences = [s for s in re.split(r"[.!?\n]+", text) if s.strip()]
    last = sentences[-1].split() if sentences else []
    return " ".join(last if len(last) >= 3 else text.split()[-5:])


def _sums(rows: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sum of the rows of each key; keys ascend."""
    heads = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    return keys[heads], np.add.reduceat(rows, heads, axis=0)


def _sorted_set(numbers: np.ndarray) -> np.ndarray:
    """As ``np.unique``, by a sort, which is faster here than its hash table."""
    numbers = np.sort(numbers)
    return numbers[np.concatenate([[True], numbers[1:] != numbers[:-1]])] if len(numbers) else numbers


def frequencies(docs: DataFrame, text: str) -> tuple[np.ndarray, int]:
    """Document frequencies by bucket, and the number of documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frequency, n = np.zeros(DF_BUCKETS, np.int64), 0
        for batch in batches:
            for part in bites(batch, text):
                hashes, before = word_hashes(utf8(part.column(text)))
                owner = np.repeat(np.arange(len(before) - 1), np.diff(before))
                cells = owner * DF_BUCKETS + _bucket(hashes)
                if part.num_rows <= 2**32 // DF_BUCKETS:
                    cells = cells.astype(np.uint32)  # sorted several times as fast
                frequency += np.bincount(_sorted_set(cells) % DF_BUCKETS, minlength=DF_BUCKETS)
                n += part.num_rows
        some = np.flatnonzero(frequency)
        places, values = np.concatenate([[-1], some]), np.concatenate([[n], frequency[some]])
        yield pa.RecordBatch.from_arrays([pa.array(places), pa.array(values)], ["place", "value"])

    summed = map_batches(docs.select(f"`{text}`"), run, "place long, value long").groupBy("place").agg(F.sum("value").alias("v"))
    found = summed.toArrow()  # one row a bucket
    cells = np.zeros(DF_BUCKETS + 1, np.int64)
    cells[found.column("place").to_numpy()] = found.column("v").to_numpy()  # place -1 is the last cell
    return cells[:-1], int(cells[-1])


def idf_of(frequency: np.ndarray, documents: int) -> np.ndarray:
    """Weight of each bucket; 0 for words of too many documents."""
    idf = np.log1p((documents + 1) / (frequency + 1)).astype(np.float32)
    idf[frequency > max(STOP_LEAST, STOP_SHARE * documents)] = 0
    return idf


def _latent_bucket(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> np.uint64(64 - 15)).astype(np.int64)


def _unseen(batch: pa.RecordBatch, seen: set[int]) -> pa.RecordBatch:
    """The rows whose ``key`` has not come before."""
    fresh = []
    for key in batch.column("key").to_pylist():
        fresh.append(key not in seen)
        seen.add(key)
    return batch if all(fresh) else batch.filter(pa.array(fresh))


def _lists(sizes: np.ndarray, values: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)), pa.array(values))


def _vectors(hashes: np.ndarray, before: np.ndarray, idf: np.ndarray) -> tuple[np.ndarray, ...]:
    """The passages of each text, side by side: of each passage its text and entries, of each entry bucket and weight."""
    size, n = LATENT_SCALE[0], np.diff(before)
    # What is left behind the last full passage is joined to it if it is short, so that no passage is a stub.
    count = np.where(n > 0, np.maximum(1, n // size + (n % size >= size // 2)), 0)
    index = np.arange(len(hashes)) - np.repeat(before[:-1], n)
    passage = np.repeat(np.cumsum(count) - count, n) + np.minimum(index // size, np.repeat(count, n) - 1)
    weight = idf[_bucket(hashes)]
    heavy = weight > 0
    cell, at = np.unique(passage[heavy] * LATENT_BUCKETS + _latent_bucket(hashes[heavy]), return_inverse=True)
    value, owner = np.bincount(at, weight[heavy], len(cell)), cell // LATENT_BUCKETS
    value = value / np.sqrt(np.bincount(owner, value**2, count.sum()))[owner]
    entries = np.bincount(owner, minlength=count.sum())
    some = entries > 0
    # Half the bits of a float are enough for a weight, and files and shuffles pack what is left of it.
    rounded = value.astype(np.float16).astype(np.float32)
    return np.repeat(np.arange(len(n)), count)[some], entries[some], (cell % LATENT_BUCKETS).astype(np.int32), rounded


def every_passage(docs: DataFrame, text: str, idf: np.ndarray, documents: int, scratch: Scratch) -> DataFrame:
    """TF-IDF vectors of unit length (buckets, weights) of all passages of all distinct texts, written."""
    shared = docs.sparkSession.sparkContext.broadcast(idf)

    def of_texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            for part in bites(batch, "text"):
                part = _unseen(part, seen)
                owner, entries, buckets, weights = _vectors(*word_hashes(utf8(part.column("text"))), shared.value)
                held = np.bincount(owner, entries, part.num_rows).astype(np.int64)
                lists = (np.bincount(owner, minlength=part.num_rows), entries.astype(np.int32)), (held, buckets), (held, weights)
                columns = [part.column("key"), *(_lists(*x) for x in lists)]
                yield pa.RecordBatch.from_arrays(columns, ["key", "entries", "buckets", "weights"]).filter(pa.array(held > 0))

    def distinct(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            part = _unseen(batch, seen)
            entries, *values = (part.column(c).flatten().to_numpy() for c in ("entries", "buckets", "weights"))
            yield pa.RecordBatch.from_arrays([_lists(entries, v) for v in values], ["buckets", "weights"])

    own = docs.select(F.xxhash64(F.col(f"`{text}`")).alias("key"), F.col(f"`{text}`").alias("text"))
    texts = map_batches(own, of_texts, "key long, entries array<int>, buckets array<int>, weights array<float>")
    passages = map_batches(texts.repartition("key"), distinct, "buckets array<int>, weights array<float>")
    written = scratch.write(passages, "latent-passages")
    shared.destroy()
    return written


#: The name of :func:`every_passage` from when it took some of them.
sample_passages = every_passage


def _blocks_of(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The buckets of a few passages at a time, and the passages as rows over them."""
    buckets, weights = (batch.column(c).flatten().to_numpy() for c in ("buckets", "weights"))
    starts = np.concatenate([[0], np.cumsum(batch.column("buckets").value_lengths().to_numpy())])
    passage, places = np.repeat(np.arange(batch.num_rows), np.diff(starts)) % 16, np.empty(LATENT_BUCKETS, np.int64)
    for at in range(0, batch.num_rows, 16):
        edges = starts[at : at + 17]
        part = slice(edges[0], edges[-1])
        own = _sorted_set(buckets[part])
        places[own] = np.arange(len(own))
        rows = np.zeros((len(edges) - 1, len(own)), np.float32)
        rows[passage[part], places[buckets[part]]] = weights[part]
        yield own, rows


def _products(passages: DataFrame, basis: np.ndarray | int) -> np.ndarray:
    """A'(A basis) of the passages A, summed by bucket; a number is the seed of a random basis, which tasks draw."""
    shared = None if isinstance(basis, int) else passages.sparkSession.sparkContext.broadcast(basis)
    names, width = ["bucket", "sums"], RANK + EXTRA

    def emit(buckets: np.ndarray, sums: np.ndarray) -> Iterator[pa.RecordBatch]:
        for at in range(0, len(buckets), 4096):
            some = sums[at : at + 4096].astype(np.float32)
            yield pa.RecordBatch.from_arrays(
                [pa.array(buckets[at : at + 4096].astype(np.int32)), _lists(np.full(len(some), width), some.ravel())], names
            )

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = random_basis(basis) if shared is None else shared.value.astype(np.float32)
        sums = np.zeros(own.shape, np.float32)
        seen = np.zeros(len(sums), bool)
        for batch in batches:
            for buckets, rows in _blocks_of(batch):
                sums[buckets] += rows.T @ (rows @ own[buckets])
                seen[buckets] = True
        yield from emit(np.flatnonzero(seen), sums[seen])

    def total(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in key_blocks(batches, "bucket", 4 << 20):
            rows = block.column("sums").flatten().to_numpy().reshape(-1, width)
            yield from emit(*_sums(rows, block.column("bucket").to_numpy()))

    schema = "bucket int, sums array<float>"
    grouped = map_batches(passages, partial, schema).repartition("bucket").sortWithinPartitions("bucket")
    found = map_batches(grouped, total, schema).toArrow().combine_chunks()  # one row a bucket
    if shared is not None:
        shared.destroy()  # nothing reads it again: the basis would stay on the disk of every executor
    out = np.zeros((LATENT_BUCKETS, width), np.float32)
    if found.num_rows:
        out[found.column("bucket").to_numpy()] = found.column("sums").combine_chunks().flatten().to_numpy().reshape(-1, width)
    return out


def random_basis(seed: int) -> np.ndarray:
    return np.random.default_rng(seed).standard_normal((LATENT_BUCKETS, RANK + EXTRA), np.float32)


def latent_basis(passages: DataFrame, seed: int = 11) -> np.ndarray:
    """The leading right singular vectors of all passages: buckets times at most ``RANK``."""
    rows = passages.count()
    rank = max(1, min(RANK, rows // 4))  # well below the passages, or the space would be the whole one
    passages = passages.coalesce(max(1, -(-rows // TASK_PASSAGES)))
    # The range of the passages, then one power iteration, both over all of them.
    basis = np.linalg.qr(_products(passages, seed))[0].astype(np.float16)
    products = _products(passages, basis).astype(float)
    # With the products Y = A'A Q the Gram matrix is Q'Y, and A'A is near Y (Q'Y)^-1 Y' (Nystrom).
    gram = basis.astype(float).T @ products
    values, vectors = np.linalg.eigh((gram + gram.T) / 2)
    sure = values > 1e-6 * max(values[-1], 1e-30)
    if not sure.any():
        return np.zeros((LATENT_BUCKETS, 1), np.float32)
    leading = np.linalg.svd(products @ (vectors[:, sure] / np.sqrt(values[sure])), full_matrices=False)[0]
    return leading[:, :rank].astype(np.float32)


@dataclass
class Space:
    """What a block of queries is searched by."""

    idf: np.ndarray  # by bucket
    starts: np.ndarray  # postings of each word of the vocabulary
    query: np.ndarray
    weight: np.ndarray  # queries of unit norm in the space of all words
    basis: np.ndarray  # latent space
    latent: np.ndarray  # queries in it, of unit norm; zeros for those without a weight


def build_space(queries: Queries, idf: np.ndarray, basis: np.ndarray, documents_idf: np.ndarray | None = None) -> Space:
    """``documents_idf``: weights without stop words, for queries that have hardly any other words."""
    idf = idf.copy()
    if documents_idf is not None:
        for words in queries.words:
            buckets = np.unique(_bucket(words))
            if (idf[buckets] > 0).sum() < RARE_WORDS:
                idf[buckets] = documents_idf[buckets]
    word, query, weight = [], [], []
    latent = np.zeros((len(queries.words), basis.shape[1]), np.float32)
    for number, words in enumerate(queries.words):
        own, tf = np.unique(np.searchsorted(queries.vocabulary, words), return_counts=True)
        value = np.sqrt(tf) * idf[_bucket(queries.vocabulary[own])]
        value /= max(float(np.linalg.norm(value)), 1e-9)
        word.append(own)
        query.append(np.full(len(own), number))
        weight.append(value)
        vector = (basis[_latent_bucket(words)] * idf[_bucket(words)][:, None]).sum(0)
        latent[number] = vector / max(float(np.linalg.norm(vector)), 1e-9)
    word, query, weight = (np.concatenate(x) for x in (word, query, weight))
    order = np.argsort(word, kind="stable")
    starts = np.searchsorted(word[order], np.arange(len(queries.vocabulary) + 1))
    return Space(idf, starts, query[order], weight[order], basis, latent)


def _projected(buckets: np.ndarray, weights: np.ndarray, row: np.ndarray, rows: int, basis: np.ndarray) -> np.ndarray:
    """The sums of the weighted basis vectors of each row; rows ascend. Few rows at a time, dense over their own buckets."""
    sums, places = np.zeros((rows, basis.shape[1]), np.float32), np.empty(len(basis), np.int64)
    edges = np.searchsorted(row, np.arange(0, rows + 32, 32))
    for nth, (start, end) in enumerate(zip(edges.tolist(), edges[1:].tolist())):
        if start == end:
            continue
        part, first = slice(start, end), 32 * nth
        own = _sorted_set(buckets[part])
        places[own] = np.arange(len(own))
        cells = (row[part] - first) * len(own) + places[buckets[part]]
        dense = np.bincount(cells, weights[part], min(32, rows - first) * len(own))
        sums[first : first + 32] = dense.reshape(-1, len(own)).astype(np.float32) @ basis[own]
    return sums


def latent_candidates(
    hashes: np.ndarray, before: np.ndarray, queries: Queries, space: Space, cosine: float = LATENT_COSINE
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Passages and queries whose latent vectors have ``cosine`` or more, as :func:`candidates`.

    Words are projected once: a passage is the sum of two neighbouring steps.
    """
    size, step = LATENT_SCALE
    n = np.diff(before)
    steps = -(-n // step)
    owner = np.repeat(np.arange(len(n)), steps)
    index = np.arange(len(owner)) - np.repeat(np.cumsum(steps) - steps, steps)
    first = before[owner] + index * step
    last = np.minimum(first + step, before[owner + 1])
    found = [(np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0))]
    for at in range(0, len(first), 1024):
        a, b = first[at : at + 1025], last[at : at + 1025]  # one more, for the last pair
        own = hashes[a[0] : b[-1]]  # steps follow one another without a gap
        weight = space.idf[_bucket(own)]
        heavy = np.flatnonzero(weight)
        sums = _projected(
            _latent_bucket(own[heavy]), weight[heavy], np.repeat(np.arange(len(a)), b - a)[heavy], len(a), space.basis
        )
        texts = owner[at : at + 1025]
        pair = np.flatnonzero(texts[1:] == texts[:-1])
        alone = np.flatnonzero(steps[texts[:1024]] == 1)
        vectors = np.concatenate([sums[pair] + sums[pair + 1], sums[alone]])
        begin, end = np.concatenate([a[pair], a[alone]]), np.concatenate([b[pair + 1], b[alone]])
        norm = np.linalg.norm(vectors, axis=1)
        for some in range(0, len(space.latent), 4096):
            scores = vectors @ space.latent[some : some + 4096].T
            least = np.where(norm > 1e-6, cosine * norm, np.inf).astype(np.float32)
            hit, query = np.divmod(np.flatnonzero(scores >= least[:, None]), scores.shape[1])
            found.append((begin[hit], end[hit], query + some, scores[hit, query] / norm[hit]))
    return tuple(np.concatenate(x) for x in zip(*found))


def candidates(
    hashes: np.ndarray, before: np.ndarray, queries: Queries, space: Space, cosine: float = COSINE, known: Places | None = None
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Passages and queries at ``cosine`` or more: first and last word (in all), query, cosine."""
    empty = np.empty(0, np.int64)
    if not len(hashes):
        return empty, empty, empty, np.empty(0)
    idf = space.idf[_bucket(hashes)].astype(float)
    at, number = known or queries.look_up(hashes)
    heavy = idf[at] > 0
    at, number = at[heavy], number[heavy]
    inside = np.zeros(len(hashes))
    inside[at] = idf[at] ** 2
    mass, shared = (np.concatenate([[0.0], np.cumsum(x)]) for x in (idf**2, inside))
    of_place = np.full(len(hashes), -1, np.int64)
    of_place[at] = number
    lengths = np.array([len(w) for w in queries.words])
    found = []
    searched = [(*scale, (lengths <= SHORT) == (nth == 0)) for nth, scale in enumerate(SCALES)]
    for size, step, of_scale in [*searched, (*TINY_SCALE, lengths <= TINY)]:
        chosen = np.flatnonzero(of_scale)
        if not len(chosen):
            continue
        n = np.diff(before)
        counts = np.where(n > 0, np.maximum(0, -(-(n - size) // step)) + 1, 0)
        owner = np.repeat(np.arange(len(n)), counts)
        index = np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)
        first = before[owner] + index * step
        last = np.minimum(first + size, before[owner + 1])
        norm = mass[last] - mass[first]
        within = shared[last] - shared[first]
        left = np.flatnonzero((within > 1e-9) & (within >= cosine**2 * norm - 1e-9))
        first, last, norm = first[left], last[left], norm[left]
        for block in range(0, len(first), 4096):
            a, b, total = first[block : block + 4096], last[block : block + 4096], norm[block : block + 4096]
            places = np.repeat(a, b - a) + np.arange((b - a).sum()) - np.repeat(np.cumsum(b - a) - (b - a), b - a)
            row = np.repeat(np.arange(len(a)), b - a)
            real = of_place[places] >= 0
            cell = row[real] * len(queries.vocabulary) + of_place[places[real]]
            cell, tf = np.unique(cell, return_counts=True)
            if not len(cell):
                continue
            row, word = cell // len(queries.vocabulary), cell % len(queries.vocabulary)
            weight = (np.sqrt(tf) * space.idf[_bucket(queries.vocabulary[word])]).astype(np.float32)
            many = space.starts[word + 1] - space.starts[word]
            posting = spread(space.starts[word], many)
            pair = np.repeat(row, many) * len(queries.words) + space.query[posting]
            mine = of_scale[space.query[posting]]
            pair, at_pair = np.unique(pair[mine], return_inverse=True)
            if not len(pair):  # all shared words are those of queries of another scale
                continue
            scores = np.bincount(at_pair, (np.repeat(weight, many) * space.weight[posting])[mine], len(pair))
            row, query = pair // len(queries.words), pair % len(queries.words)
            scores /= np.sqrt(total[row])
            hit = scores >= cosine
            found.append((a[row[hit]], b[row[hit]], query[hit], scores[hit]))
    if not found:
        return empty, empty, empty, np.empty(0)
    return tuple(np.concatenate(x) for x in zip(*found))


def exact_copies(
    hashes: np.ndarray, before: np.ndarray, queries: Queries, space: Space, known: Places | None = None
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The first exact copy of each query of up to ``SHORT`` words in each text, as :func:`candidates`."""
    found = [(np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.int64))]
    at, number = known or queries.look_up(hashes)
    order = np.argsort(number, kind="stable")
    at, number = at[order], number[order]
    for query, words in enumerate(queries.words):
        if len(words) > SHORT:
            continue
        rarest = int(np.argmax(space.idf[_bucket(words)]))
        word = np.searchsorted(queries.vocabulary, words[rarest])
        a, b = np.searchsorted(number, [word, word + 1])
        first = at[a:b] - rarest
        first = first[(first >= 0) & (first + len(words) <= len(hashes))]
        for place in range(len(words)):
            if not len(first):
                break
            first = first[hashes[first + place] == words[place]]
        owner = np.searchsorted(before, first, "right") - 1
        inside = first + len(words) <= before[owner + 1]
        _, one = np.unique(owner[inside], return_index=True)
        first = first[inside][one]
        found.append((first, first + len(words), np.full(len(first), query)))
    first, last, query = (np.concatenate(x) for x in zip(*found))
    return first, last, query, np.ones(len(first))


def common_subsequence(item: np.ndarray, passage: np.ndarray) -> int:
    """Length of the longest common subsequence, bit-parallel."""
    masks: dict[int, int] = {}
    for i, word in enumerate(item.tolist()):
        masks[word] = masks.get(word, 0) | 1 << i
    full = (1 << len(item)) - 1
    row = full
    for word in passage.tolist():
        match = masks.get(word)
        if match:
            step = row & match
            row = ((row + step) | (row - step)) & full
    return len(item) - row.bit_count()


def leaks_of(texts: pa.Array, queries: Queries, space: Space) -> list[list[dict]]:
    """The leaks of each text, one for each item."""
    hashes, before = word_hashes(texts)
    best: dict[tuple[int, int], dict] = {}
    known = queries.look_up(hashes)
    near, exact = candidates(hashes, before, queries, space, known=known), exact_copies(hashes, before, queries, space, known)
    first, last, query, cosine = (np.concatenate(x) for x in zip(near, exact, latent_candidates(hashes, before, queries, space)))
    # What the plain search has found is reported as it was found.
    order = [*np.argsort(-near[-1], kind="stable").tolist(), *range(len(near[0]), len(first))]
    owner = np.searchsorted(before, first, "right") - 1
    seen = set()
    for at in order:
        text, q = int(owner[at]), int(query[at])
        item = queries.words[q]
        a = max(int(before[text]), int(first[at]) - len(item))
        b = min(int(before[text + 1]), int(last[at]) + len(item))
        key = (text, int(queries.item_id[q]))
        if (text, q, a, b) in seen or best.get(key, {}).get("lcs_share") == 1.0:
            continue
        seen.add((text, q, a, b))
        passage = hashes[a:b]
        share = common_subsequence(item, passage) / len(item)
        if share < PARAPHRASE:
            continue
        answer = queries.answers[q]
        answered = float(np.isin(answer, passage).mean()) if len(answer) else 1.0
        if share < COPY and answered < ANSWER:
            continue
        if key not in best or share > best[key]["lcs_share"]:
            best[key] = {
                "item_id": key[1], "cosine": float(cosine[at]), "lcs_share": share, "answer_share": answered,
                "first_word": int(first[at] - before[text]), "words": int(last[at] - first[at]),
            }
    out: list[list[dict]] = [[] for _ in range(len(before) - 1)]
    for (text, _), leak in sorted(best.items()):
        out[text].append(leak)
    return out


def _blocks(benchmark: DataFrame, item_id: str, text: str, answer: str | None) -> Iterator[Queries]:
    """The benchmark, read by ``BLOCK`` rows, in blocks of at most ``BLOCK_QUERIES`` queries."""
    columns = [F.col(item_id).cast("long").alias("item_id"), F.coalesce(F.col(text), F.lit("")).alias("text")]
    columns.append((F.col(answer) if answer else F.lit(None)).cast("string").alias("answer"))
    held = []
    rows = benchmark.select(*columns).where("item_id IS NOT NULL").orderBy("item_id", "text")
    for row in rows.toLocalIterator():
        held.append(row)
        if len(held) == BLOCK:
            yield from Queries.blocks_of(*map(list, zip(*held)), BLOCK_QUERIES)
            held = []
    if held:
        yield from Queries.blocks_of(*map(list, zip(*held)), BLOCK_QUERIES)


def _merged(parts: list[str]):
    """The leaks of all blocks by item, of each item the one with the highest share."""
    if len(parts) == 1:
        return F.col(parts[0])
    ranked = F.array_sort(
        F.transform(
            F.concat(*parts), lambda x: F.struct(x["item_id"], -x["lcs_share"], -x["cosine"], x["first_word"], x.alias("leak"))
        )
    )
    every = F.transform(ranked, lambda x: x["leak"])
    return F.filter(every, lambda x, i: (i == 0) | (x["item_id"] != F.get(every, i - 1)["item_id"]))


def with_leaks(
    docs: DataFrame,
    benchmark: DataFrame,
    text: str = "text",
    out: str = "leaks",
    item_id: str = "item_id",
    item_text: str = "text",
    answer: str | None = None,
    keep: list[str] | None = None,
) -> DataFrame:
    """``docs`` with the items of ``benchmark`` that leak into each text, whole texts searched.

    Null and empty texts, on either side, and items without words or id have no leaks. Without an
    ``answer`` column the last sentence of an item is its answer. Repeated rows get equal leaks, as
    do items with one id, which are reported once. Empty tables give empty results or no leaks. A
    column already named ``out`` is replaced. Texts of any length are searched whole.
    """
    spark = docs.sparkSession
    blocks = list(_blocks(benchmark, item_id, item_text, answer))
    names = [c for c in (docs.columns if keep is None else keep) if c.lower() != out.lower()]
    if not blocks:
        return docs.select(*[f"`{c}`" for c in names], F.array().cast(LEAKS).alias(out))
    frequency, documents = frequencies(docs, text)
    idf = idf_of(frequency, documents)
    scratch = Scratch(spark)
    basis = latent_basis(every_passage(docs, text, idf, documents, scratch))
    scratch.clear()
    every = np.log1p((documents + 1) / (frequency + 1)).astype(np.float32)
    spaces = [(queries, build_space(queries, idf, basis, every)) for queries in blocks]
    parts = []
    found = docs if text in names else docs.select(*[f"`{c}`" for c in names], f"`{text}`")
    for number, pair in enumerate(spaces):
        shared = spark.sparkContext.broadcast(pair)

        def make(batch: pa.RecordBatch, shared=shared) -> list:
            return [pa.array(leaks_of(utf8(batch.column(text)), *shared.value), _LEAK_TYPE)]

        parts.append(free(f"leaks_{number}", [*docs.columns, out]))
        found = with_columns(found, text, [T.StructField(parts[-1], LEAKS)], make)
    return found.select(*[f"`{c}`" for c in names], _merged(parts).alias(out))
