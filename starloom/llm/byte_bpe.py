"""Byte-level BPE encoding and decoding with a hierarchical-bitmap rank queue.

All distinct pre-tokens of a bite form one linked list with a wall between neighbours, so merges
never cross pre-tokens. A bucket per merge rank holds positions of the list; a three-level bitmap
of 64-bit words tells which buckets are filled, and find-first-set on each level picks the lowest
rank. An entry is stale if the pair at its position has another rank by now, and is skipped.

Taking a whole bucket at a time equals taking its leftmost entry at a time, because merging rank r
cannot create a pair of a lower rank, except for ranks that the vocabulary itself shows
(``Vocabulary.unsafe``, about a sixth of them); of those only the leftmost entry of each pre-token is
taken at a time. That is repeated as often as the longest pre-token has such entries, so pre-tokens of more
than ``LONG`` bytes go one by one through a queue whose buckets are heaps of positions: there each of
the at most n merges costs the logarithm of a bucket, whatever the ranks.
"""

from __future__ import annotations

import base64
import heapq
from functools import cached_property, lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from starloom.llm.frames import map_batches, spread, utf8, with_columns

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
NO_RANK = np.int32(2**31 - 1)
#: Pre-tokens remembered by a Python worker between bites; then it starts afresh.
REMEMBERED = 400_000
REMEMBERED_BYTES = 64 << 20
ENCODE_BITE = 6 << 20
#: Longer pre-tokens are merged one entry at a time.
LONG = 256


class RankQueue:
    """Buckets by rank under a three-level bitmap."""

    def __init__(self, ranks: int):
        self.buckets: dict[int, list[np.ndarray]] = {}
        self.low = [0] * ((ranks >> 6) + 1)
        self.mid = [0] * ((ranks >> 12) + 1)
        self.top = 0

    def push(self, rank: int, positions: np.ndarray | int) -> None:
        bucket = self.buckets.get(rank)
        if bucket is None:
            self.buckets[rank] = [positions]
            self.low[rank >> 6] |= 1 << (rank & 63)
            self.mid[rank >> 12] |= 1 << (rank >> 6 & 63)
            self.top |= 1 << (rank >> 12)
        else:
            bucket.append(positions)

    def pop(self) -> tuple[int, np.ndarray] | None:
        """The lowest filled bucket, emptied."""
        if not self.top:
            return None
        i = (self.top & -self.top).bit_length() - 1
        j = i << 6 | (self.mid[i] & -self.mid[i]).bit_length() - 1
        rank = j << 6 | (self.low[j] & -self.low[j]).bit_length() - 1
        self.low[j] &= self.low[j] - 1
        if not self.low[j]:
            self.mid[i] &= self.mid[i] - 1
            if not self.mid[i]:
                self.top &= self.top - 1
        parts = self.buckets.pop(rank)
        return rank, parts[0] if len(parts) == 1 else np.concatenate(parts)


class HeapQueue(RankQueue):
    """The same with a heap of positions in each bucket, the leftmost on top."""

    def put(self, rank: int, position: int) -> None:
        bucket = self.buckets.get(rank)
        if bucket is None:
            self.push(rank, position)
        else:
            heapq.heappush(bucket, position)

    def take(self) -> tuple[int, int] | None:
        """The leftmost position of the lowest filled bucket."""
        if not self.top:
            return None
        i = (self.top & -self.top).bit_length() - 1
        j = i << 6 | (self.mid[i] & -self.mid[i]).bit_length() - 1
        rank = j << 6 | (self.low[j] & -self.low[j]).bit_length() - 1
        bucket = self.buckets[rank]
        if len(bucket) == 1:
            return rank, self.pop()[1]
        return rank, heapq.heappop(bucket)


class Vocabulary:
    """Ranks of a tiktoken file with what encoding and decoding look up."""

    def __init__(self, path: str):
        with open(path, "rb") as lines:
            self.ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in lines if line.strip())}
        self.size = max(self.ranks.values()) + 1
        pieces = [b""] * self.size
        for piece, rank in self.ranks.items():
            pieces[rank] = piece
        self.lengths = np.array([len(p) for p in pieces], np.int64)
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.bytes = np.frombuffer(b"".join(pieces), np.uint8)
        self.of_byte = np.array([self.ranks[bytes([b])] for b in range(256)], np.int32)
        keys, merged, unsafe = [], [], set()
        for piece, rank in self.ranks.items():
            for cut in range(1, len(piece)):
                left, right = self.ranks.get(piece[:cut]), self.ranks.get(piece[cut:])
                if left is not None and right is not None:
                    keys.append(left * self.size + right)
                    merged.append(rank)
                    unsafe.update(part for part in (left, right) if part > rank)
        order = np.argsort(keys)
        self.keys = np.array(keys, np.int64)[order]
        self.merged = np.array(merged, np.int32)[order]
        self.unsafe = unsafe
        self.byte_pairs = self._search(
            np.repeat(self.of_byte, 256).astype(np.int64), np.tile(self.of_byte, 256).astype(np.int64)
        ).reshape(256, 256)

    def _search(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = left * self.size + right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where((self.keys[at] == key) & (left >= 0) & (right >= 0), self.merged[at], NO_RANK)

    def encode(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all pieces one after another, and the number of ids of each piece."""
        long = [n for n, p in enumerate(pieces) if len(p) > LONG]
        if not long:
            return self.merge_all(pieces)
        ids, counts = self.merge_all([b"" if len(p) > LONG else p for p in pieces])
        parts, ends, at = [], np.cumsum(counts), 0
        for n in long:
            own = self.merge_one(pieces[n])
            parts += [ids[at : ends[n]], own]
            at, counts[n] = ends[n], len(own)
        return np.concatenate([*parts, ids[at:]]), counts

    def merge_one(self, piece: bytes) -> np.ndarray:
        """Ids of one pre-token of any length, by the queue of heaps."""
        raw = np.frombuffer(piece, np.uint8)
        n = len(raw)
        rank = self.byte_pairs[raw[:-1], raw[1:]]
        token = self.of_byte[raw].tolist()
        queue = HeapQueue(self.size)
        order = np.argsort(rank, kind="stable")
        ranks = rank[order]
        cuts = [0, *(np.flatnonzero(ranks[1:] != ranks[:-1]) + 1).tolist(), len(ranks)]
        for a, b in zip(cuts, cuts[1:]):
            if a < b and ranks[a] != NO_RANK:
                queue.push(int(ranks[a]), 0)
                queue.buckets[int(ranks[a])] = order[a:b].tolist()  # ascending: a heap
        none = int(NO_RANK)
        rank = [*rank.tolist(), none]
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        known, size = self.pairs, self.size
        while (lowest := queue.take()) is not None:
            r, at = lowest
            if rank[at] != r:
                continue  # stale
            gone = after[at]
            follow = after[gone]
            token[at], rank[gone], token[gone], after[at] = r, none, -1, follow
            if follow < n:
                before[follow] = at
                rank[at] = known.get(r * size + token[follow], none)
                if rank[at] != none:
                    queue.put(rank[at], at)
            else:
                rank[at] = none
            lead = before[at]
            if lead >= 0:
                rank[lead] = known.get(token[lead] * size + r, none)
                if rank[lead] != none:
                    queue.put(rank[lead], lead)
        return np.array([t for t in token if t >= 0], np.int32)

    @cached_property
    def pairs(self) -> dict[int, int]:
        return dict(zip(self.keys.tolist(), self.merged.tolist()))

    def merge_all(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """As :meth:`encode`, all pieces at once."""
        lengths = np.array([len(p) for p in pieces], np.int64)
        raw = np.frombuffer(b"".join(pieces), np.uint8)
        n = len(raw)
        if not n:
            return np.empty(0, np.int32), lengths
        word = np.repeat(np.arange(len(pieces), dtype=np.int32), lengths)
        token = self.of_byte[raw]
        # Node n is the wall at either end; a wall between pieces is a neighbour of another word.
        after = np.arange(1, n + 1, dtype=np.int32)
        before = np.arange(-1, n, dtype=np.int32)[:n]
        rank = np.full(n + 1, NO_RANK, np.int32)
        inside = word[:-1] == word[1:]
        rank[: n - 1] = np.where(inside, self.byte_pairs[raw[:-1], raw[1:]], NO_RANK)
        alive = np.ones(n, bool)
        queue = RankQueue(self.size)

        def push(positions: np.ndarray) -> None:
            ranks = rank[positions]
            order = np.argsort(ranks, kind="stable")
            positions, ranks = positions[order], ranks[order]
            end = int(np.searchsorted(ranks, NO_RANK))
            if not end:
                return
            cuts = np.flatnonzero(ranks[1:end] != ranks[: end - 1]) + 1
            bounds = [0, *cuts.tolist(), end]
            for a, b in zip(bounds, bounds[1:]):
                queue.push(int(ranks[a]), positions[a:b])

        push(np.arange(n, dtype=np.int32))
        while (lowest := queue.pop()) is not None:
            r, at = lowest
            at = np.unique(at[rank[at] == r])  # stale entries go
            if not len(at):
                continue
            if len(at) > 1:
                if r in self.unsafe:
                    first = np.ones(len(at), bool)
                    first[1:] = word[at[1:]] != word[at[:-1]]
                    if not first.all():
                        queue.push(r, at[~first])
                        at = at[first]
                else:  # in a run of overlapping pairs every second one merges, from the left
                    chained = np.zeros(len(at), bool)
                    chained[1:] = after[at[:-1]] == at[1:]
                    if chained.any():
                        index = np.arange(len(at))
                        start = np.maximum.accumulate(np.where(chained, 0, index))
                        at = at[(index - start) % 2 == 0]
            gone = after[at]
            follow = after[gone]
            token[at] = r
            alive[gone] = False
            rank[gone] = NO_RANK
            after[at] = follow
            linked = follow < n
            before[follow[linked]] = at[linked]
            self._rerank(rank, token, word, at, follow, n)
            lead = before[at]
            ok = lead >= 0
            lead = lead[ok]
            self._rerank(rank, token, word, lead, after[lead], n)
            push(np.concatenate([at, lead]))
        return token[alive], np.bincount(word[alive], minlength=len(pieces)).astype(np.int64)

    def _rerank(self, rank, token, word, left, right, n) -> None:
        there = np.minimum(right, n - 1)
        same = (right < n) & (word[left] == word[there])
        rank[left] = np.where(same, self._search(token[left].astype(np.int64), token[there].astype(np.int64)), NO_RANK)

    def decode(self, ids: np.ndarray) -> np.ndarray:
        return self.bytes[spread(self.starts[ids], self.lengths[ids])]


class Memory(dict):
    """Numbers pre-tokens as they come; ids of number k are flat[starts[k] : starts[k] + counts[k]]."""

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = vocabulary
        self.known = self.bytes = 0
        self.flat = np.empty(0, np.int32)
        self.starts = self.counts = np.empty(0, np.int32)

    def __missing__(self, piece: str) -> int:
        number = self[piece] = len(self)
        self.bytes += len(piece)
        return number

    def learn(self) -> None:
        """Encode the pre-tokens numbered since the last call."""
        if self.known == len(self):
            return
        fresh = [p.encode() for p in list(self)[self.known :]]
        whole = np.array([self.vocabulary.ranks.get(p, -1) for p in fresh], np.int64)
        rest = np.flatnonzero(whole < 0)
        ids, sizes = self.vocabulary.encode([fresh[i] for i in rest.tolist()])
        counts = np.ones(len(fresh), np.int64)
        counts[rest] = sizes
        flat = np.repeat(whole, counts).astype(np.int32)
        flat[flat < 0] = ids
        counts = counts.astype(np.int32)
        starts = np.cumsum(counts, dtype=np.int32) - counts + np.int32(len(self.flat))
        self.flat = np.concatenate([self.flat, flat])
        self.starts = np.concatenate([self.starts, starts])
        self.counts = np.concatenate([self.counts, counts])
        self.known = len(self)


@lru_cache(maxsize=2)
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


_memory: dict[str, Memory] = {}


def remembered(path: str) -> Memory:
    memory = _memory.get(path)
    if memory is None or len(memory) > REMEMBERED or memory.bytes > REMEMBERED_BYTES:
        memory = _memory[path] = Memory(vocabulary(path))
    return memory


def encode_texts(texts: list[str], path: str, pattern: str) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all texts one after another, and the offsets of each text in them."""
    memory = remembered(path)
    split, number = regex.compile(pattern).findall, memory.__getitem__
    numbers = [np.fromiter(map(number, split(text)), np.int32) for text in texts]
    memory.learn()
    sizes = np.array([len(x) for x in numbers], np.int64)
    every = np.concatenate(numbers) if numbers else np.empty(0, np.int32)
    del numbers
    counts = memory.counts[every]
    ids = memory.flat[spread(memory.starts[every], counts)]
    totals = np.concatenate([[0], np.cumsum(counts, dtype=np.int64)])
    return ids, totals[np.concatenate([[0], np.cumsum(sizes)])]


def encode(
    df: DataFrame,
    text: str = "text",
    out: str = "ids",
    ranks: str = RANKS,
    pattern: str = public_tokenizers.PATTERN,
    keep: list[str] | None = None,
) -> DataFrame:
    """``df`` with the token ids of each text as ``array<int>``.

    Null and empty texts have no ids (an empty array). Repeated rows keep their multiplicity, an
    empty table stays empty, and a column already named ``out`` is replaced.
    """

    def make(batch: pa.RecordBatch) -> list:
        ids, offsets = encode_texts(utf8(batch.column(text)).to_pylist(), ranks, pattern)
        return [pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(ids))]

    return with_columns(df, text, [T.StructField(out, T.ArrayType(T.IntegerType()))], make, keep, ENCODE_BITE)


def decode(df: DataFrame, ids: str = "ids", out: str = "decoded", ranks: str = RANKS) -> DataFrame:
    """``df`` with ``ids`` decoded to bytes in ``out`` (binary). Null ids decode to no bytes."""
    kept = [c for c in df.columns if c.lower() != out.lower()]
    schema = T.StructType([df.schema[c] for c in kept] + [T.StructField(out, T.BinaryType())])

    def run(batches):
        book = vocabulary(ranks)
        for batch in batches:
            lists = batch.column(ids)
            sizes = np.array([0 if x is None else x for x in lists.value_lengths().to_pylist()], np.int64)
            values = lists.flatten().to_numpy(zero_copy_only=False)
            ends = np.cumsum(sizes)
            start = 0
            while start < len(sizes):  # about a million ids at a time
                base = ends[start - 1] if start else 0
                stop = max(start + 1, int(np.searchsorted(ends, base + 1_000_000, "right")))
                part = values[base : ends[stop - 1]]
                raw = book.decode(part)
                marks = np.concatenate([[0], np.cumsum(book.lengths[part])])
                offsets = marks[np.concatenate([[0], ends[start:stop] - base])].astype(np.int32)
                done = pa.Array.from_buffers(
                    pa.binary(), stop - start, [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(raw.tobytes())]
                )
                piece = batch.slice(start, stop - start)
                yield pa.RecordBatch.from_arrays([piece.column(c) for c in kept] + [done], schema.fieldNames())
                start = stop

    return map_batches(df, run, schema)
