"""Exact removal of byte strings that start earlier in the corpus, by a sparse suffix array.

A byte goes if it is covered by a string of ``length`` bytes that also starts earlier (in a row
with a smaller id, or in the same text). Rows with equal ids are ordered by the hash of their text;
equal rows are one and the same place, so they lose the same bytes.

1. Anchors (anchors.py) sample about one suffix in thirty so that every window of ``length`` bytes
   meets one. Anchor strings that occur once in the corpus are out: two narrow shuffles of hashes.
2. Occurrences with equal hulls have equal windows. The earliest stays, the others lose all their
   windows. This collapses copies by partial aggregation, however large their group.
3. Where an anchor string has several hulls, the suffixes of those hulls are put in order by
   deep-shallow sorting (suffix_sort.py): first from the anchor to the right and to the left, which
   bounds the windows another hull can share; then the windows left. Runs with a common prefix of
   ``length`` bytes are equal windows, of which the earliest stays. An anchor string with more than
   ``group`` hulls is not given to one task: its windows are dealt by their own bytes and their
   first starts found by grouped aggregation.
4. The removed windows join their texts.

Hashes are of 64 bits for anchor strings (a collision costs work, not correctness, because windows
are compared in step 3) and 128 for hulls together with their anchor strings.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom.llm import anchors, suffix_sort
from starloom.llm.frames import BITE, Scratch, buffer, free, key_blocks, map_batches, release, rows_from, utf8, with_columns
from starloom.session import materialise

LENGTH = 100
GRAM = 32
#: Hulls of one anchor string that a task sorts at most.
GROUP = 20_000

SPANS = T.ArrayType(T.StructType([T.StructField("start", T.IntegerType()), T.StructField("stop", T.IntegerType())]))


def _find(batch: pa.RecordBatch, length: int, gram: int) -> anchors.Anchors:
    return anchors.find(*buffer(utf8(batch.column("text"))), length, gram)


def _occurrences(base: DataFrame, length: int, gram: int, scratch: Scratch) -> DataFrame:
    """Every anchor of every text whose string occurs more than once in the corpus."""

    bits = length.bit_length()

    def strings(batch: pa.RecordBatch) -> pa.RecordBatch:
        values, counts = np.unique(_find(batch, length, gram).gram, return_counts=True)
        return pa.RecordBatch.from_arrays([pa.array(values.view(np.int64)), pa.array(counts)], ["gram", "n"])

    def places(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = _find(batch, length, gram)
        rows = pa.array(found.text)
        return pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id").take(rows),
                batch.column("text_key").take(rows),
                # One number instead of three: this is the widest shuffle.
                pa.array((found.at << 2 * bits) | (found.span << bits) | found.place),
                *(pa.array(x.view(np.int64)) for x in (found.gram, found.hull)),
            ],
            ["doc_id", "text_key", "shape", "gram", "hull"],
        )

    counted = rows_from(base.select("text"), "text", "gram long, n long", strings)
    repeated = scratch.write(
        counted.groupBy("gram").agg(F.sum("n").alias("n")).where("n > 1").select("gram"), "repeated"
    )
    release(base.sparkSession)
    schema = T.StructType(
        [base.schema["doc_id"]] + [T.StructField(c, T.LongType()) for c in ("text_key", "shape", "gram", "hull")]
    )
    found = rows_from(base, "text", schema, places).join(repeated, "gram", "left_semi")
    mask = (1 << bits) - 1
    shape = F.col("shape")
    found = scratch.write(
        found.select(
            "doc_id",
            "text_key",
            F.shiftright(shape, 2 * bits).cast("int").alias("at"),
            F.shiftright(shape, bits).bitwiseAND(F.lit(mask)).cast("int").alias("span"),
            shape.bitwiseAND(F.lit(mask)).cast("int").alias("place"),
            "gram",
            "hull",
        ),
        "occurrences",
    )
    release(base.sparkSession)
    return found


def _with_hulls(base: DataFrame, wanted: DataFrame, length: int) -> DataFrame:
    """``wanted`` anchors with the bytes of their hulls."""
    lists = wanted.groupBy("doc_id", "text_key").agg(
        F.collect_list(F.struct("at", "span", "place", "gram", "kinds")).alias("anchors")
    )
    texts, marks = base.alias("t"), lists.alias("m")
    same = F.col("t.doc_id").eqNullSafe(F.col("m.doc_id")) & (F.col("t.text_key") == F.col("m.text_key"))
    joined = texts.join(marks, same).select("t.*", "m.anchors")

    def cut(batch: pa.RecordBatch) -> pa.RecordBatch:
        raw, offsets = buffer(utf8(batch.column("text")))
        lists = batch.column("anchors")
        sizes = pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
        flat = lists.flatten()
        at, span = (flat.field(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("at", "span"))
        rows = np.repeat(np.arange(len(sizes)), sizes)
        starts = offsets[rows] + at
        data = raw.tobytes()
        hulls = [data[a:b] for a, b in zip(starts.tolist(), (starts + span + length).tolist())]
        return pa.RecordBatch.from_arrays(
            [batch.column(c).take(pa.array(rows)) for c in ("doc_id", "text_key")]
            + [flat.field(c) for c in ("at", "span", "place", "gram", "kinds")]
            + [pa.array(hulls, pa.binary())],
            ["doc_id", "text_key", "at", "span", "place", "gram", "kinds", "bytes"],
        )

    schema = T.StructType(
        [wanted.schema[c] for c in ("doc_id", "text_key", "at", "span", "place", "gram", "kinds")]
        + [T.StructField("bytes", T.BinaryType())]
    )
    return rows_from(joined, "text", schema, cut)


def later_windows(batch: pa.RecordBatch, length: int) -> pa.RecordBatch:
    """The windows of the hulls that start earlier too, as runs of starts; anchor strings are complete here."""
    raw, offsets = _binary(batch.column("bytes"))
    at, span, place = (batch.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("at", "span", "place"))
    _, groups = np.unique(batch.column("gram").to_numpy(zero_copy_only=False), return_inverse=True)
    n = len(at)

    def reach(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """The longest prefix each suffix shares with another one of its group."""
        order, lcp = suffix_sort.order(data, starts, lengths, groups)
        both = np.zeros(n, np.int64)
        both[order] = np.maximum(lcp, np.concatenate([lcp[1:], [-1]]))
        return np.maximum(both, 0)

    right = reach(raw, offsets[:-1] + place, np.minimum(offsets[1:] - offsets[:-1] - place, length))
    size = len(raw)
    left = reach(raw[::-1].copy(), size - offsets[:-1] - place, place)
    low = np.maximum(place - left, 0)
    high = np.minimum(span, place - length + right)
    counts = np.maximum(high - low + 1, 0)
    owner = np.repeat(np.arange(n), counts)
    window = low[owner] + np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)
    order, lcp = suffix_sort.order(
        raw, offsets[owner] + window, np.full(len(owner), length, np.int64), groups[owner]
    )
    run = np.cumsum(lcp < length)
    doc = pc.rank(batch.column("doc_id"), "ascending", null_placement="at_start", tiebreaker="dense").to_numpy()
    key = batch.column("text_key").to_numpy(zero_copy_only=False)
    own, start = owner[order], at[owner[order]] + window[order]
    by = np.lexsort((start, key[own], doc[own], run))
    own, start, run = own[by], start[by], run[by]
    first = np.ones(len(run), bool)
    first[1:] = run[1:] != run[:-1]
    leader = np.maximum.accumulate(np.where(first, np.arange(len(run)), 0))
    same_place = (doc[own] == doc[own[leader]]) & (key[own] == key[own[leader]]) & (start == start[leader])
    own, start = own[~same_place], start[~same_place]
    by = np.lexsort((start, own))
    own, start = own[by], start[by]
    begins = np.ones(len(own), bool)
    begins[1:] = (own[1:] != own[:-1]) | (start[1:] != start[:-1] + 1)
    heads = np.flatnonzero(begins)
    tails = np.concatenate([heads[1:], [len(own)]]) - 1 if len(own) else heads
    rows = pa.array(own[heads])
    return pa.RecordBatch.from_arrays(
        [batch.column(c).take(rows) for c in ("doc_id", "text_key")]
        + [pa.array(x.astype(np.int32)) for x in (start[heads], start[tails] - start[heads])],
        ["doc_id", "text_key", "at", "span"],
    )


def _binary(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    return buffer(column.cast(pa.large_binary()))


def removed_windows(
    docs: DataFrame, scratch: Scratch, length: int = LENGTH, gram: int = GRAM, group: int = GROUP
) -> DataFrame:
    """Runs of window starts that go, for ``docs`` with doc_id, text_key and text."""
    found = _occurrences(docs, length, gram, scratch)
    place = F.struct("doc_id", "text_key", "at")
    classes = scratch.write(
        found.groupBy("gram", "hull").agg(
            F.min(place).alias("first"), F.max("span").alias("span"), F.max("place").alias("place"),
            F.count("*").alias("n"),
        ),
        "hulls",
    )
    release(docs.sparkSession)
    copies = (
        found.select("gram", "hull", "doc_id", "text_key", "at", "span")
        .join(classes.where("n > 1").select("gram", "hull", "first"), ["gram", "hull"])
        .where(~(place.eqNullSafe(F.col("first"))))
        .select("doc_id", "text_key", "at", "span")
    )
    several = classes.groupBy("gram").agg(F.count("*").alias("kinds")).where("kinds > 1")
    wanted = classes.join(several, "gram").select("first.*", "span", "place", "gram", "kinds")
    hulls = scratch.write(_with_hulls(docs, wanted, length), "hull-bytes")
    release(docs.sparkSession)

    out = T.StructType([found.schema[c] for c in ("doc_id", "text_key", "at", "span")])

    def sort(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in key_blocks(batches, "gram", 4 << 20):
            yield later_windows(block, length)

    dealt = hulls.where(F.col("kinds") <= group).repartition("gram").sortWithinPartitions("gram")
    sorted_windows = map_batches(dealt, sort, out)

    # Anchor strings with very many hulls: every window by its own bytes.
    windows = hulls.where(F.col("kinds") > group).select(
        "doc_id", "text_key", "gram", F.col("at"), "bytes", F.explode(F.sequence(F.lit(0), "span")).alias("shift")
    )
    windows = windows.select(
        "doc_id", "text_key", "gram", (F.col("at") + F.col("shift")).alias("at"),
        F.unhex(F.md5(F.substring("bytes", F.col("shift") + 1, F.lit(length)))).alias("window"),
    )
    earliest = windows.groupBy("gram", "window").agg(F.min(place).alias("first"), F.count("*").alias("n"))
    dealt_windows = (
        windows.join(earliest.where("n > 1").select("gram", "window", "first"), ["gram", "window"])
        .where(~(place.eqNullSafe(F.col("first"))))
        .select("doc_id", "text_key", "at", F.lit(0).alias("span"))
    )
    return copies.unionByName(sorted_windows).unionByName(dealt_windows)


def _union(at: np.ndarray, stop: np.ndarray) -> tuple[list[int], list[int]]:
    """The maximal runs covered by the intervals."""
    by = np.argsort(at, kind="stable")
    at, reach = at[by], np.maximum.accumulate(stop[by])
    begins = np.ones(len(at), bool)
    begins[1:] = at[1:] > reach[:-1]
    heads = np.flatnonzero(begins)
    return at[heads].tolist(), reach[np.concatenate([heads[1:], [len(at)]]) - 1].tolist()


def _with_removed(
    docs: DataFrame, doc_id: str, text: str, length: int, gram: int, group: int, out: str
) -> DataFrame:
    """``docs`` with the removed windows of each text in ``out``."""
    base = docs.select(
        F.col(doc_id).alias("doc_id"), F.xxhash64(F.col(text)).alias("text_key"), F.col(text).alias("text")
    )
    scratch = Scratch(docs.sparkSession)
    gone = materialise(
        removed_windows(base, scratch, length, gram, group)
        .groupBy("doc_id", "text_key")
        .agg(F.collect_list(F.struct("at", "span")).alias(out)),
        "gone",
    )
    scratch.clear()
    d, m = docs.alias("d"), gone.alias("m")
    same = F.col(f"d.`{doc_id}`").eqNullSafe(F.col("m.doc_id")) & (
        F.xxhash64(F.col(f"d.`{text}`")) == F.col("m.text_key")
    )
    return d.join(m, same, "left").select(*[F.col(f"d.`{c}`") for c in docs.columns], f"m.{out}")


def _texts_and_spans(batch: pa.RecordBatch, text: str, length: int, gone: str) -> Iterator[tuple[bytes, list[int], list[int]]]:
    """The bytes of each text, and begin and end of its removed spans."""
    raw, offsets = buffer(utf8(batch.column(text)))
    lists = batch.column(gone)
    sizes = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    ends = np.cumsum(sizes)
    flat = lists.flatten()
    at = flat.field("at").to_numpy(zero_copy_only=False)
    stop = at + flat.field("span").to_numpy(zero_copy_only=False) + length
    for row, (start, end) in enumerate(zip((ends - sizes).tolist(), ends.tolist())):
        own = raw[offsets[row] : offsets[row + 1]].tobytes()
        begins, stops = _union(at[start:end], stop[start:end]) if start < end else ([], [])
        yield own, begins, stops


def _cut(raw: bytes, begins: list[int], stops: list[int]) -> bytes:
    edges = [0, *(x for pair in zip(begins, stops) for x in pair), len(raw)]
    return b"".join(raw[a:b] for a, b in zip(edges[::2], edges[1::2]))


def deduplicate(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    length: int = LENGTH,
    gram: int = GRAM,
    group: int = GROUP,
) -> DataFrame:
    """``docs`` with ``removed_spans`` (byte offsets, maximal runs) and ``kept_bytes``, what is left of the text.

    Null and empty texts lose nothing and keep no bytes. Texts shorter than ``length`` bytes lose
    nothing. Null ids come before all others. Equal rows lose the same bytes; rows with one id and
    different texts are ordered by a hash of the text. An empty table stays empty. Columns that
    have the names of the two new ones are replaced.
    """
    gone = free("gone", docs.columns)
    kind = pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32())]))

    def make(batch: pa.RecordBatch) -> list:
        spans, kept = [], []
        for raw, begins, stops in _texts_and_spans(batch, text, length, gone):
            spans.append([{"start": a, "stop": b} for a, b in zip(begins, stops)])
            kept.append(_cut(raw, begins, stops))
        return [pa.array(spans, kind), pa.array(kept, pa.binary())]

    fields = [T.StructField("removed_spans", SPANS), T.StructField("kept_bytes", T.BinaryType())]
    joined = _with_removed(docs, doc_id, text, length, gram, group, gone)
    return with_columns(joined, text, fields, make, docs.columns, BITE, (gone,))


def _whole_characters(raw: bytes, start: int, stop: int) -> tuple[int, int]:
    """The span without the characters it holds only in part."""
    while start < stop and raw[start] & 0xC0 == 0x80:
        start += 1
    while stop > start and stop < len(raw) and raw[stop] & 0xC0 == 0x80:
        stop -= 1
    return start, stop


def apply(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", length: int = LENGTH) -> DataFrame:
    """``docs``, all rows and columns, with the removed spans cut out of the text, whole characters only.

    See :func:`deduplicate` for empty and short texts and repeated rows; a null text stays null.
    """

    gone, left = free("gone", docs.columns), free("left", docs.columns)

    def make(batch: pa.RecordBatch) -> list:
        there = batch.column(text).is_valid().to_pylist()
        out = []
        for valid, (raw, begins, stops) in zip(there, _texts_and_spans(batch, text, length, gone)):
            whole = [_whole_characters(raw, a, b) for a, b in zip(begins, stops)]
            out.append(_cut(raw, [a for a, _ in whole], [b for _, b in whole]).decode() if valid else None)
        return [pa.array(out, pa.string())]

    names = docs.columns
    cut = with_columns(
        _with_removed(docs, doc_id, text, length, GRAM, GROUP, gone), text, [T.StructField(left, T.StringType())], make,
        [c for c in names if c != text], uses=(gone,),
    )
    return cut.select(*[F.col(left).alias(text) if c == text else F.col(f"`{c}`") for c in names])
