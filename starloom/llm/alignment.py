"""Tokens of two tokenizers over the same text, aligned where both end.

A task works on Arrow arrays from end to end: the token lists of all texts of a bite are flattened with
their parent indices, segmented cumulative sums of the token widths give the byte where each token
ends, an Acero hash join on (document, end) finds the ends both tokenizers share, and
``Table.group_by`` counts the id pairs linked there. Spark sums these partial counts over the corpus.
A second pass looks up the sums for the distinct pairs of each text.

Tokens come from the libraries, each distinct unit of text once: a text is cut at every space behind
something that is not white space. There the pattern of the byte-level tokenizer starts a new
word, and no piece of the other vocabulary holds a space behind another character (checked when it is
loaded), so the tokens on the two sides do not depend on each other.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom.llm import units
from starloom.llm.frames import Scratch, free, map_batches, release, spread, utf8

BYTE_LEVEL = public_tokenizers.path("byte_bpe_50k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")
#: Characters of text that a task aligns at a time.
BITE = 1 << 20
#: Distinct id pairs, with their counts, that are broadcast (16 bytes each); more are joined by a shuffle.
BROADCAST_PAIRS = 4_000_000
SPACE = "▁"
BYTE = re.compile(r"<0x([0-9A-F]{2})>")

#: Fixed: the byte behind each character of a byte-level vocabulary. Printable bytes stand for
#: themselves, the others for the characters from 256 on, in order.
PRINTABLE = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]


def byte_of() -> dict[str, int]:
    others = [b for b in range(256) if b not in set(PRINTABLE)]
    return {**{chr(b): b for b in PRINTABLE}, **{chr(256 + n): b for n, b in enumerate(others)}}


class Book:
    """The bytes of each id of a vocabulary."""

    def __init__(self, pieces: list[bytes]):
        self.width = np.array([len(p) for p in pieces], np.int64)
        self.starts = np.cumsum(self.width) - self.width
        self.bytes = np.frombuffer(b"".join(pieces), np.uint8)

    def joined(self, ids: np.ndarray) -> np.ndarray:
        return self.bytes[spread(self.starts[ids], self.width[ids])]


@lru_cache(maxsize=2)
def byte_level(path: str) -> Book:
    book = units.tokenizer(path, True)
    table = byte_of()
    pieces = [b""] * (max(book.get_vocab().values()) + 1)
    for token, i in book.get_vocab().items():
        pieces[i] = bytes(table[c] for c in token) if all(c in table for c in token) else token.encode()
    return Book(pieces)


@lru_cache(maxsize=2)
def _model(path: str) -> sentencepiece.SentencePieceProcessor:
    return sentencepiece.SentencePieceProcessor(model_file=path)


@lru_cache(maxsize=2)
def piece_level(path: str) -> Book:
    model = _model(path)
    names = [model.id_to_piece(i) for i in range(model.get_piece_size())]
    if any(SPACE in name.lstrip(SPACE) for name in names):
        raise ValueError("a piece of the model holds a space behind another character")
    found = [BYTE.fullmatch(name) if model.is_byte(i) else None for i, name in enumerate(names)]
    return Book([bytes([int(b[1], 16)]) if b else name.replace(SPACE, " ").encode() for b, name in zip(found, names)])


def _encoders(a: str, b: str) -> list[units.Encode]:
    spaced = units.library(a, plain_specials=True)
    model = _model(b)
    space = [model.piece_to_id(SPACE)]  # of a space with nothing behind it, which the model itself only gives inside a text
    return [
        lambda parts: spaced([" " + part for part in parts]),
        lambda parts: units.flatten([ids or space for ids in model.encode(parts, num_threads=1)]),
    ]


_CUT = re.compile(r"(?<=[^\s\x1c-\x1f\x85]) ")
#: A space behind one of these is no cut.
_WHITE = [c + " " for c in map(chr, range(0x3001)) if c.isspace()]


def _cut(text: str, at: int) -> int:
    found = _CUT.search(text, max(at, 1))
    return found.start() if found and found.end() < len(text) else len(text)


def _units(texts: list[str]) -> tuple[list[str], np.ndarray]:
    """Units of all texts without the space in front of each, and how many each text has."""
    parts = [_CUT.split(text) if text[:1] == " " or any(map(text.__contains__, _WHITE)) else text.split(" ") for text in texts]
    sizes = np.fromiter(map(len, parts), np.int64, len(parts))
    return [unit for own in parts for unit in own], sizes


def _flat(ids: np.ndarray, per_text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Values and parents of the token lists."""
    ends = np.concatenate([[0], np.cumsum(per_text)])
    lists = pa.LargeListArray.from_arrays(pa.array(ends), pa.array(ids))
    return lists.flatten(), pc.list_parent_indices(lists)


def _ends(values: pa.Array, parents: pa.Array, width: np.ndarray, texts: int) -> pa.Array:
    """Where each token ends in its own text: a cumulative sum that starts afresh with every text."""
    widths = pc.take(pa.array(width), values)
    running = pc.cumulative_sum(widths)
    total = np.bincount(parents.to_numpy(), weights=widths.to_numpy(), minlength=texts).astype(np.int64)
    before = pa.array(np.cumsum(total) - total)
    return pc.subtract(running, pc.take(before, parents))


def align(texts: list[str], a: str = BYTE_LEVEL, b: str = PIECES) -> tuple[pa.Table, pa.Table, pa.Table]:
    """Tokens of both sides (doc, id, end, in order) and links (doc, end, a, b) of texts, given by row.

    A text whose joined bytes are not those of a space and the text has no rows.
    """
    memory = units.memory(("pair", a, b), lambda: _encoders(a, b))
    memory.tidy()
    parts, sizes = _units(texts)
    found = pa.array(parts, pa.large_string()).dictionary_encode()
    numbers = memory.numbers(found.dictionary.to_numpy(zero_copy_only=False).tolist())
    numbers = numbers[found.indices.to_numpy(zero_copy_only=False)]
    first = np.concatenate([[0], np.cumsum(sizes)])
    raw = [b" " + t.encode() if t else b"" for t in texts]
    lengths = np.fromiter(map(len, raw), np.int64, len(raw))
    bounds = np.concatenate([[0], np.cumsum(lengths)])
    whole = np.frombuffer(b"".join(raw), np.uint8)
    good = lengths > 0
    sides = []
    for side, book in enumerate((byte_level(a), piece_level(b))):
        ids, counts = memory.ids(numbers, side)
        per_text = np.diff(np.concatenate([[0], np.cumsum(counts)])[first])
        joined = book.joined(ids)
        made = np.concatenate([[0], np.cumsum(book.width[ids])])[np.concatenate([[0], np.cumsum(per_text)])]
        if len(joined) == len(whole) and np.array_equal(made, bounds):  # nearly always: compare all texts at once
            wrong = np.flatnonzero(joined != whole)
            good[np.unique(np.searchsorted(bounds, wrong, "right") - 1)] = False
        else:
            good &= [np.array_equal(joined[p:q], whole[r:s]) for p, q, r, s in zip(made, made[1:], bounds, bounds[1:])]
        sides.append((ids, per_text, book))
    tables = []
    for ids, per_text, book in sides:
        keep = np.repeat(good, per_text)
        values, parents = _flat(ids[keep], np.where(good, per_text, 0))
        ends = _ends(values, parents, book.width, len(texts))
        tables.append(pa.table({"doc": parents, "end": ends, "id": values}))
    left, right = (t.rename_columns(["doc", "end", name]) for t, name in zip(tables, "ab"))
    links = left.join(right, keys=["doc", "end"], join_type="inner", use_threads=False)
    return tables[0], tables[1], links


@lru_cache(maxsize=1)
def _digits(n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Decimal digits of 0 to n - 1 one after another, where each starts and how many there are."""
    text = [str(i) for i in range(n)]
    width = np.array([len(t) for t in text], np.int64)
    return np.frombuffer("".join(text).encode(), np.uint8), np.cumsum(width) - width, width


def group_texts(left: pa.Table, right: pa.Table, links: pa.Table, texts: int) -> tuple[np.ndarray, np.ndarray]:
    """All texts' groups ``a1,a2|b1;a3|b2;``, one after another, and the offset of each text in them."""
    sides = [[t.column(c).to_numpy() for c in ("doc", "end", "id")] for t in (left, right)]
    width = max([int(s[1].max()) for s in sides if len(s[1])] + [0]) + 1
    shared = np.sort(links.column("doc").to_numpy().astype(np.int64) * width + links.column("end").to_numpy())
    order, ids, marks, docs = [], [], [], []
    for side, (doc, end, own) in enumerate(sides):
        key = doc.astype(np.int64) * width + end
        group = np.searchsorted(shared, key)  # the first shared end at or behind the token's own
        last = shared[np.minimum(group, len(shared) - 1)] == key if len(shared) else np.zeros(len(key), bool)
        order.append(group * 2 + side)
        ids.append(own)
        docs.append(doc)
        marks.append(np.where(last, ord("|") if side == 0 else ord(";"), ord(",")).astype(np.uint8))
    place = np.argsort(np.concatenate(order), kind="stable")
    ids, marks, docs = (np.concatenate(x)[place] for x in (ids, marks, docs))
    digits, starts, sizes = _digits(1 << 17)
    sizes = sizes[ids]
    out = np.empty(int(sizes.sum()) + len(ids), np.uint8)
    stops = np.cumsum(sizes + 1)
    is_mark = np.zeros(len(out), bool)
    is_mark[stops - 1] = True
    out[is_mark] = marks
    out[~is_mark] = digits[spread(starts[ids], sizes)]
    per_text = np.bincount(docs, weights=sizes + 1, minlength=texts).astype(np.int64)
    return out, np.concatenate([[0], np.cumsum(per_text)])


_PAIRS = T.ArrayType(T.StructType([T.StructField(c, T.IntegerType()) for c in ("a", "b", "n")]))
_COUNTS = ("n_a", "n_b", "n_groups", "n_links")
_OUT = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


class _Document:
    """Sums over the stretches of one text."""

    def __init__(self):
        self.counts = [0, 0, 0]
        self.sha = hashlib.sha256()
        self.pairs: list[np.ndarray] = []
        self.good, self.going = True, False

    def add(self, counts: list[int], groups: bytes, pairs: np.ndarray, good: bool) -> None:
        self.good, self.going = self.good and good, True
        if self.counts[0] and counts[0]:
            self.sha.update(b";")
        self.sha.update(groups[:-1])
        self.counts = [x + y for x, y in zip(self.counts, counts)]
        self.pairs.append(pairs)
        if len(self.pairs) > 64:
            self.pairs = [_summed(self.pairs)]

    def row(self) -> tuple:
        if not self.good or not self.counts[0]:
            return 0, 0, 0, 0, "", np.empty((3, 0), np.int64)
        n_a, n_b, n = self.counts
        return n_a, n_b, n, n, self.sha.hexdigest(), _summed(self.pairs)


def _summed(pairs: list[np.ndarray]) -> np.ndarray:
    """Distinct pairs (a, b, n) of the stretches of a text."""
    if len(pairs) == 1:
        return pairs[0]
    a, b, n = np.concatenate(pairs, 1)
    keys, at = np.unique(a << 32 | b, return_inverse=True)
    return np.stack([keys >> 32, keys & 0xFFFFFFFF, np.bincount(at, weights=n).astype(np.int64)])


def documents(texts: list[str], a: str, b: str) -> Iterator[tuple]:
    """(row, n_a, n_b, n_groups, n_links, sha256, distinct pairs as rows a, b and n of an array) of each text."""
    own = _Document()
    for stretch in units.stretches(texts, BITE, _cut):
        parts = [t for _, t, _ in stretch]
        if own.going:  # behind a cut a stretch begins with the space that every unit has in front
            parts[0] = parts[0][1:]
        left, right, links = align(parts, a, b)
        groups, at = group_texts(left, right, links, len(parts))
        n_a, n_b, n_links = (np.bincount(t.column("doc").to_numpy(), minlength=len(parts)) for t in (left, right, links))
        counted = links.group_by(["doc", "a", "b"], use_threads=False).aggregate([([], "count_all")])
        doc = counted.column("doc").to_numpy()
        order = np.argsort(doc, kind="stable")
        marks = np.searchsorted(doc[order], np.arange(len(parts) + 1))
        pairs = np.stack([counted.column(c).to_numpy()[order].astype(np.int64) for c in ("a", "b", "count_all")])
        raw = groups.tobytes()
        for n, (row, text, last) in enumerate(stretch):
            own_pairs = pairs[:, marks[n] : marks[n + 1]]
            counts = [int(n_a[n]), int(n_b[n]), int(n_links[n])]
            own.add(counts, raw[at[n] : at[n + 1]], own_pairs, bool(counts[0]) or not parts[n])
            if last:
                yield row, *own.row()
                own = _Document()


def aligned(df: DataFrame, text: str, keep: list[str], a: str, b: str) -> DataFrame:
    """``keep``, the counts, ``groups_sha256`` and the distinct linked id pairs of each text."""
    fields = [T.StructField(c, T.LongType()) for c in _COUNTS]
    fields += [T.StructField("groups_sha256", T.StringType()), T.StructField("pairs", _PAIRS)]
    schema = T.StructType([df.schema[c] for c in keep] + fields)
    from pyspark.sql.pandas.types import to_arrow_type

    kinds = [to_arrow_type(f.dataType) for f in fields[:-1]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = utf8(batch.column(text)).to_numpy(zero_copy_only=False).tolist()
            held, weight = [], 0
            for found in documents(texts, a, b):
                held.append(found)
                weight += found[-1].shape[1]
                if weight > 200_000:
                    yield emit(batch, held)
                    held, weight = [], 0
            if held:
                yield emit(batch, held)

    def emit(batch: pa.RecordBatch, held: list[tuple]) -> pa.RecordBatch:
        rows, *columns, pairs = zip(*held)
        made = [pa.array(c, kind) for c, kind in zip(columns, kinds)]
        offsets = np.concatenate([[0], np.cumsum([p.shape[1] for p in pairs])]).astype(np.int32)
        values = [pa.array(x.astype(np.int32)) for x in np.concatenate(pairs, 1)]
        made.append(pa.ListArray.from_arrays(pa.array(offsets), pa.StructArray.from_arrays(values, ["a", "b", "n"])))
        return pa.RecordBatch.from_arrays([batch.column(c).take(pa.array(rows)) for c in keep] + made, schema.fieldNames())

    return map_batches(df.select(*[f"`{c}`" for c in dict.fromkeys([*keep, text])]), run, schema)


def _scored(table: tuple[np.ndarray, np.ndarray, np.ndarray], schema: T.StructType, keep: list[str]):
    """Sums over each text's pairs by binary search in the sorted pairs of the corpus."""
    keys, totals, best = table

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own_keys, own_totals, own_best = (x.value for x in (keys, totals, best))
        for batch in batches:
            lists = batch.column("pairs")
            parents = pc.list_parent_indices(lists).to_numpy()
            a, b, n = (x.to_numpy().astype(np.int64) for x in lists.flatten().flatten())
            at = np.searchsorted(own_keys, a << 32 | b)
            sums = [np.bincount(parents, weights=w, minlength=batch.num_rows) for w in (n * own_best[at], n * own_totals[at])]
            made = [pa.array(s.astype(np.int64)) for s in sums]
            columns = {"n_best": made[0], "count_sum": made[1]}
            yield pa.RecordBatch.from_arrays(
                [columns[f.name] if f.name in columns else batch.column(f.name) for f in schema], schema.fieldNames()
            )

    return run


def compare(
    df: DataFrame,
    text: str = "text",
    keep: list[str] | None = None,
    a: str = BYTE_LEVEL,
    b: str = PIECES,
    broadcast_pairs: int = BROADCAST_PAIRS,
) -> tuple[DataFrame, DataFrame]:
    """Alignment of each text, and the corpus-wide count of each linked id pair (a, b, links).

    The first has the columns ``keep`` (default: all) and ``n_a``, ``n_b``, ``n_groups``, ``n_links``,
    ``n_best`` (links whose pair is the most frequent of its b, ties included), ``count_sum`` and
    ``groups_sha256``. Null and empty texts, and texts that a tokenizer does not give back byte for byte,
    have zeros and an empty hash. Repeated rows count as often as they stand; an empty table has no rows.
    Columns named like a new one are replaced. A very long text is taken in stretches that end at a
    space; a run without spaces is held whole, as the libraries do. Pairs that fit the bound are
    broadcast, more are joined.
    """
    scratch = Scratch(df.sparkSession)
    spark = df.sparkSession
    new = {*_OUT, "pairs"}
    kept = [c for c in (df.columns if keep is None else keep) if c.lower() not in new]
    rows = scratch.write(aligned(df, text, kept, a, b), "aligned")
    counts = rows.select(F.explode("pairs").alias("pair")).groupBy("pair.a", "pair.b").agg(F.sum("pair.n").alias("links"))
    counts = scratch.write(counts, "aligned-pairs")
    top = counts.groupBy(F.col("b").alias("of")).agg(F.max("links").alias("top"))
    ranked = counts.join(top, counts["b"] == top["of"]).select("a", "b", "links", (F.col("links") == F.col("top")).alias("best"))
    size = counts.count()
    release(spark)
    base = [F.col(f"`{c}`") for c in kept]
    if size <= broadcast_pairs:
        table = ranked.toArrow()
        pair = table.column("a").to_numpy().astype(np.int64) << 32 | table.column("b").to_numpy()
        order = np.argsort(pair)
        best = table.column("best").to_numpy(zero_copy_only=False)[order].astype(np.int64)
        values = (pair[order], table.column("links").to_numpy()[order], best)
        shared = tuple(spark.sparkContext.broadcast(x) for x in values)
        kinds = {f: T.StringType() if f == "groups_sha256" else T.LongType() for f in _OUT}
        schema = T.StructType([rows.schema[c] for c in kept] + [T.StructField(c, kind) for c, kind in kinds.items()])
        return map_batches(rows, _scored(shared, schema, kept), schema), counts
    number = free("number", [*kept, *new])
    numbered = scratch.write(rows.withColumn(number, F.monotonically_increasing_id()), "aligned-rows")
    pairs = numbered.select(number, F.explode("pairs").alias("pair")).select(number, "pair.*")
    sums = pairs.join(ranked, ["a", "b"]).groupBy(number).agg(
        F.sum(F.when(F.col("best"), F.col("n")).otherwise(0)).cast("long").alias("n_best"),
        F.sum(F.col("n") * F.col("links")).alias("count_sum"),
    )
    zero = F.lit(0).cast("long")
    joined = numbered.join(sums, number, "left")
    out = [F.coalesce(F.col(c), zero).alias(c) if c in ("n_best", "count_sum") else F.col(c) for c in _OUT]
    return joined.select(*base, *out), counts
