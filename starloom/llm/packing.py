"""Documents packed into sequences of bounded length by bulk-synchronous best fit.

Texts become token ids, long ones are cut into pieces of the capacity, and the pieces are packed in
rounds. A round takes the longest open pieces (down to half of the longest) and the sequences with room
for them. Pieces and gaps are range-sorted together by falling size, and every range is swept by one
task: a gap goes on a stack, a piece takes the gap on top, which is the smallest one left that holds it.
What finds no partner inside its range is numbered there; a last-in first-out match of these ranks over
the ranges, of which only the two counts of each range are needed, gives every remaining piece its
gap, so that no two pieces ever claim the same one. Gaps are updated, and the next round begins. A gap
that holds several pieces of the round's size takes part with as many slots.

A round whose slots are fewer than its pieces opens sequences, at most those that all open pieces need
beyond the gaps there are; only if no gap fits any more does it open some regardless. The driver sees
histograms of sizes (as many rows as the capacity) and the sizes left over in each range.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom.llm import units
from starloom.llm.frames import Scratch, buffer, free, map_batches, release, spread, utf8

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
CAPACITY = 2048
#: The id behind every document.
END = 0
#: Characters of text that a task encodes at a time.
BITE = 8 << 20
#: Sizes up to this one are packed together: a gap offers them few slots too many.
SMALL = 32

#: Marks that are cut off behind a letter: no token holds both.
MARKS = ".,;:!?"

_GAP = re.compile(r"[\x20\x09-\x0D]")

PIECE = [
    T.StructField("piece", T.IntegerType()),
    T.StructField("start", T.LongType()),
    T.StructField("length", T.LongType()),
    T.StructField("ids_crc32", T.LongType()),
    T.StructField("ids", T.ArrayType(T.IntegerType())),
]
PLACE = ("sequence_id", "offset")


def _cut(text: str, at: int) -> int:
    """ASCII white space bounds the words, and no token of this vocabulary holds any."""
    found = _GAP.search(text, at)
    return found.start() if found else len(text)


@lru_cache(maxsize=2)
def _encoder(path: str) -> units.Encode:
    """The library's ids of words; words of letters alone go to it many in one text.

    Every token that ends a word is marked in the vocabulary, and a word of letters is one word of it.
    """
    plain = units.library(path)
    book = units.tokenizer(path)
    ends = np.zeros(book.get_vocab_size(), bool)
    ends[[i for token, i in book.get_vocab().items() if token.endswith("</w>")]] = True

    def encode(words: list[str]) -> units.Ids:
        alone = np.fromiter((not w.isalpha() for w in words), bool, len(words))
        letters = [w for w, other in zip(words, alone.tolist()) if not other]
        ids = plain([" ".join(letters)])[0]
        stops = np.flatnonzero(ends[ids]) + 1
        if len(stops) != len(letters):
            return plain(words)
        other, sizes = plain([w for w, o in zip(words, alone.tolist()) if o])
        counts = np.empty(len(words), np.int64)
        counts[~alone], counts[alone] = np.diff(stops, prepend=0), sizes
        flat = np.empty(len(ids) + len(other), np.int32)
        of_letters = np.repeat(~alone, counts)
        flat[of_letters], flat[~of_letters] = ids, other
        return flat, counts

    return encode


def _word_ids(words: pa.Array, path: str) -> units.Ids:
    """Ids of each word. Marks behind a word's last letter are units of their own, whose tokens do not depend on it.

    A word that may hold the string of a special token stays as it is, as those are found before any cut.
    """
    memory = units.memory(("words", path), lambda: [_encoder(path)])
    memory.tidy()
    found = words.dictionary_encode()
    distinct = found.dictionary
    trimmed = pc.utf8_rtrim(distinct, MARKS)
    raw, offsets = buffer(trimmed)
    last = raw[np.maximum(offsets[1:] - 1, 0)] if len(raw) else np.zeros(len(trimmed), np.uint8)
    letter = (np.diff(offsets) > 0) & (((last | 32) >= ord("a")) & ((last | 32) <= ord("z")))
    special = pc.match_substring(distinct, "<|").to_numpy(zero_copy_only=False)
    cut = letter & ~special
    body = pc.if_else(pa.array(cut), pc.ascii_lower(trimmed), distinct)
    bodies = memory.numbers(body.to_numpy(zero_copy_only=False).tolist())
    sizes = pc.binary_length(distinct).to_numpy(zero_copy_only=False)
    marked = np.flatnonzero(cut & (sizes > np.diff(offsets)))
    keep = np.diff(offsets)[marked].tolist()
    tails = memory.numbers([w.encode()[n:].decode() for w, n in zip(distinct.take(marked).to_numpy(zero_copy_only=False), keep)])
    parts = np.ones(len(distinct), np.int64)
    parts[marked] = 2
    first = np.cumsum(parts) - parts
    both = np.empty(int(parts.sum()), np.int64)
    both[first], both[first[marked] + 1] = bodies, tails
    flat, counts = memory.ids(both)
    per_word = np.add.reduceat(counts, first) if len(first) else counts
    starts = np.cumsum(per_word) - per_word
    at = found.indices.to_numpy(zero_copy_only=False)
    return flat[spread(starts[at], per_word[at])], per_word[at]


def documents(texts: list[str], path: str, end: int, capacity: int) -> Iterator[tuple[int, int, int, np.ndarray]]:
    """(row, piece, start, ids) for each piece of each text, in order."""
    held, piece = np.empty(0, np.int32), 0
    for stretch in units.stretches(texts, BITE, _cut):
        words = pc.ascii_split_whitespace(pa.array([t for _, t, _ in stretch], pa.large_string()))
        flat = words.flatten()
        sizes = words.value_lengths().to_numpy(zero_copy_only=False)
        inked = pc.greater(pc.binary_length(flat), 0)  # white space at either end makes empty words
        if not pc.all(inked, min_count=0).as_py():
            parents = np.repeat(np.arange(len(sizes)), sizes)
            keep = inked.to_numpy(zero_copy_only=False)
            sizes = np.bincount(parents[keep], minlength=len(sizes))
            flat = flat.filter(inked)
        ids, counts = _word_ids(flat, path)
        ends = np.concatenate([[0], np.cumsum(counts)])[np.concatenate([[0], np.cumsum(sizes)])]
        for (row, _, last), a, b in zip(stretch, ends.tolist(), ends[1:].tolist()):
            own = np.concatenate([held, ids[a:b], [end]] if last else [held, ids[a:b]]).astype(np.int32)
            at = 0
            while len(own) - at > capacity or (last and at < len(own)):
                yield row, piece, piece * capacity, own[at : at + capacity]
                at, piece = at + capacity, piece + 1
            held = own[at:].copy()
            if last:
                held, piece = np.empty(0, np.int32), 0


def pieces(
    df: DataFrame,
    text: str = "text",
    keep: list[str] | None = None,
    tokenizer: str = TOKENIZER,
    capacity: int = CAPACITY,
    end: int = END,
    ids: bool = True,
    item: str = "item",
) -> DataFrame:
    """The pieces of each text behind the columns ``keep`` (default: all), numbered by ``item``.

    A text's ids end in ``end``. Null and empty texts have that id alone. Repeated rows have pieces each,
    an empty table has none. Columns named like a new one are replaced. Numbers are distinct, and fixed
    only once the result is written. A very long text is encoded in stretches and its pieces leave the
    task as they fill; a word (a run without white space) is held whole.
    """
    fields = [f for f in PIECE if ids or f.name != "ids"]
    new = {item.lower(), *(f.name for f in PIECE)}
    kept = [c for c in (df.columns if keep is None else keep) if c.lower() not in new]
    schema = T.StructType([df.schema[c] for c in kept] + [T.StructField(item, T.LongType())] + fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 40
        for batch in batches:
            rows, made, weight = [], [], 0
            found = documents(utf8(batch.column(text)).to_pylist(), tokenizer, end, capacity)
            for row, piece, start, own in found:
                rows.append(row)
                made.append((number, piece, start, len(own), zlib.crc32(own.astype("<u4").tobytes()), own if ids else None))
                number += 1
                weight += len(own) if ids else 16
                if weight > 1 << 20:
                    yield emit(batch, rows, made)
                    rows, made, weight = [], [], 0
            if rows:
                yield emit(batch, rows, made)

    def emit(batch: pa.RecordBatch, rows: list[int], made: list[tuple]) -> pa.RecordBatch:
        columns = [batch.column(c).take(pa.array(rows)) for c in kept]
        numbers, piece, start, length, crc, own = zip(*made)
        columns += [pa.array(numbers, pa.int64()), pa.array(piece, pa.int32()), pa.array(start, pa.int64())]
        columns += [pa.array(length, pa.int64()), pa.array(crc, pa.int64())]
        if ids:
            offsets = np.concatenate([[0], np.cumsum(length)]).astype(np.int32)
            columns.append(pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(own))))
        return pa.RecordBatch.from_arrays(columns, schema.fieldNames())

    wanted = list(dict.fromkeys([*kept, text]))
    return map_batches(df.select(*[f"`{c}`" for c in wanted]), run, schema)


SWEPT = "kind int, id long, size long, bin long, part int, rank long"
#: Kinds of swept rows: a matched piece, a piece without a gap, a gap without a piece.
MATCHED, ALONE, ROOM = 0, 1, 2


def _sweep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One range of slots and pieces by falling size: last-in first-out, partners inside the range."""
    part = TaskContext.get().partitionId()
    stack: list[int] = []
    alone = 0

    def rows(kind, ids, sizes, bins, ranks) -> pa.RecordBatch:
        n = len(ids)
        return pa.RecordBatch.from_arrays(
            [
                pa.array(np.full(n, kind, np.int32)), pa.array(ids, pa.int64()), pa.array(sizes, pa.int64()),
                pa.array(bins, pa.int64()), pa.array(np.full(n, part, np.int32)), pa.array(ranks, pa.int64()),
            ],
            ["kind", "id", "size", "bin", "part", "rank"],
        )

    for batch in batches:
        matched: tuple[list, list, list] = ([], [], [])
        waiting: tuple[list, list] = ([], [])
        sizes, pieces_, ids = (batch.column(c).to_pylist() for c in ("size", "is_piece", "id"))
        for size, is_piece, own in zip(sizes, pieces_, ids):
            if not is_piece:
                stack.append(own)
            elif stack:
                for column, value in zip(matched, (own, size, stack.pop())):
                    column.append(value)
            else:
                waiting[0].append(own)
                waiting[1].append(size)
        if matched[0]:
            yield rows(MATCHED, *matched, [None] * len(matched[0]))
        if waiting[0]:
            n = len(waiting[0])
            yield rows(ALONE, *waiting, [None] * n, range(alone, alone + n))
            alone += n
    for at in range(0, len(stack), 1 << 16):
        held = stack[at : at + (1 << 16)]
        yield rows(ROOM, held, [None] * len(held), held, range(at, at + len(held)))


Link = tuple[int, int, int, int, int]


def link_ranges(over: list[tuple[int, int, int | None, int]]) -> tuple[list[Link], dict[int, int]]:
    """Partners across ranges, and the sizes of the pieces that have none.

    ``over`` counts what is left in each range as (range, kind, size, rows); a range holds few sizes, so
    these are no more rows than ranges and sizes. A link is (range, first piece rank, pieces, gap range,
    rank of its last gap). Ranges come by falling size, so the pieces of a range take the gaps of earlier
    ones, last gap first, and the longest pieces come first.
    """
    stack: list[list[int]] = []
    links: list[Link] = []
    rest: dict[int, int] = {}
    for part in sorted({row[0] for row in over}):
        own = [row for row in over if row[0] == part]
        alone = sorted(((size, n) for _, kind, size, n in own if kind == ALONE), reverse=True)
        waiting, taken = sum(n for _, n in alone), 0
        while taken < waiting and stack:
            top = stack[-1]
            n = min(waiting - taken, top[1])
            links.append((part, taken, n, top[0], top[1] - 1))
            taken += n
            top[1] -= n
            if not top[1]:
                stack.pop()
        for size, n in alone:
            gone = min(n, taken)
            taken -= gone
            if n > gone:
                rest[size] = rest.get(size, 0) + n - gone
        room = sum(n for _, kind, _, n in own if kind == ROOM)
        if room:
            stack.append([part, room])
    return links, rest


LINKED = "id long, size long, gap_part int, gap_rank long"


def _linked(links: list[Link]):
    """Adds the place of its gap to each piece that is left; those beyond all gaps have none."""
    table = np.array(links, np.int64).reshape(-1, 5)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            part = batch.column("part").to_numpy(zero_copy_only=False).astype(np.int64)
            rank = batch.column("rank").to_numpy(zero_copy_only=False)
            at = np.searchsorted(table[:, 0] * (1 << 40) + table[:, 1], part * (1 << 40) + rank, "right") - 1
            row = table[np.maximum(at, 0)] if len(table) else np.zeros((len(part), 5), np.int64)
            ok = (at >= 0) & (row[:, 0] == part) & (rank < row[:, 1] + row[:, 2])
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("id"), batch.column("size"),
                    pa.array(row[:, 3].astype(np.int32), mask=~ok),
                    pa.array(row[:, 4] - (rank - row[:, 1]), mask=~ok),
                ],
                ["id", "size", "gap_part", "gap_rank"],
            )

    return run


def _histogram(df: DataFrame, size: str) -> dict[int, int]:
    """Rows of each size, at most as many as the capacity."""
    return {r[0]: r[1] for r in df.groupBy(size).count().collect()}


def _tokens(sizes: dict[int, int]) -> int:
    return sum(size * n for size, n in sizes.items())


def rounds(open_: DataFrame, capacity: int, scratch: Scratch) -> tuple[DataFrame, int]:
    """Places (item, sequence_id, turn) for pieces (item, length) up to the capacity; also the number of rounds."""
    spark = open_.sparkSession
    opener = open_.where(F.col("length") * 2 > capacity)
    places = [opener.select("item", "length", F.col("item").alias("sequence_id"), F.lit(0).alias("turn"))]
    bins = opener.select(F.col("item").alias("bin"), (capacity - F.col("length")).alias("gap")).where("gap > 0")
    open_ = open_.where(F.col("length") * 2 <= capacity)
    left, gaps = _histogram(open_, "length"), _histogram(bins, "gap")
    rest, floor, turn, made, barren = None, capacity, 0, 0, False
    while left:
        turn += 1
        longest = max(left)
        low = longest // 2 if longest > SMALL else 0
        taking = {size: n for size, n in left.items() if size > low}
        shortest, count = min(taking), sum(taking.values())
        slots = sum(max(1, gap // longest) * n for gap, n in gaps.items() if gap >= shortest)
        if barren or slots < count:
            enough = -(-max(1, count - slots) // (capacity // longest))
            n = max(0, min(enough, -((_tokens(gaps) - _tokens(left)) // capacity)))
            if not n and (barren or not slots):  # there is room, but none that fits
                n = -(-_tokens(taking) // capacity)
            empty = spark.range(made, made + n).select((-1 - F.col("id")).alias("bin"), F.lit(capacity).cast("long").alias("gap"))
            bins, made = bins.unionByName(empty), made + n

        # Pieces that took part in an earlier round and are left, and those shorter than any that did.
        fresh = open_.where((F.col("length") <= floor) & (F.col("length") > low)).select(F.col("item").alias("id"), F.col("length").alias("size"))
        waiting = fresh if rest is None else fresh.unionByName(rest)
        floor = min(floor, low)
        swept = scratch.write(_swept(waiting, bins, longest, shortest), "packing-swept")
        over = swept.where(F.col("kind") != MATCHED).groupBy("part", "kind", "size").count().collect()
        links, stay = link_ranges([(r["part"], r["kind"], r["size"], r["count"]) for r in over])
        alone = swept.where(F.col("kind") == ALONE).select("id", "size", "part", "rank")
        alone = map_batches(alone, _linked(links), LINKED)
        room = swept.where(F.col("kind") == ROOM).select(F.col("part").alias("gap_part"), F.col("rank").alias("gap_rank"), "bin")
        far = alone.where("gap_part IS NOT NULL").join(room, ["gap_part", "gap_rank"])
        matched = swept.where(F.col("kind") == MATCHED).select("id", "size", "bin")
        matched = matched.unionByName(far.select("id", "size", "bin")) if links else matched
        placed = scratch.write(matched.withColumnsRenamed({"id": "item", "size": "length"}), "packing-placed")
        places.append(placed.select("item", "length", F.col("bin").alias("sequence_id"), F.lit(turn).alias("turn")))
        used = placed.groupBy("bin").agg(F.sum("length").alias("used"))
        after = bins.join(used, "bin", "left").select("bin", (F.col("gap") - F.coalesce("used", F.lit(0))).alias("gap"))
        bins = scratch.write(after.where("gap > 0"), "packing-gaps")
        rest = alone.where("gap_part IS NULL").select("id", "size")
        barren = sum(stay.values()) == count
        left = {size: n for size, n in left.items() if size <= low}
        for size, n in stay.items():
            left[size] = left.get(size, 0) + n
        gaps = _histogram(bins, "gap") if left else {}
    whole = places[0]
    for more in places[1:]:
        whole = whole.unionByName(more)
    return whole, turn


def _swept(waiting: DataFrame, bins: DataFrame, longest: int, shortest: int) -> DataFrame:
    """Slots and pieces by falling size, a slot before the pieces of its own size, each range swept."""
    roomy = bins.where(F.col("gap") >= shortest).withColumn("slots", F.greatest(F.lit(1), F.floor(F.col("gap") / longest)))
    slot = F.explode(F.sequence(F.lit(1), F.col("slots").cast("int")))
    # All slots of a gap but the first have the size of the round's longest piece.
    size = F.when(F.col("slot") == 1, F.col("gap") - (F.col("slots") - 1) * longest).otherwise(F.lit(longest))
    slots = roomy.withColumn("slot", slot).select(
        size.cast("long").alias("size"), F.lit(False).alias("is_piece"), F.col("bin").alias("id"), "slot"
    )
    events = slots.unionByName(waiting.select("size", F.lit(True).alias("is_piece"), "id", F.lit(0).alias("slot")))
    order: list[Column] = [F.desc("size"), F.asc("is_piece"), F.asc("id"), F.asc("slot")]
    return map_batches(events.repartitionByRange(*order).sortWithinPartitions(*order), _sweep, SWEPT)


def pack(
    df: DataFrame,
    text: str = "text",
    keep: list[str] | None = None,
    tokenizer: str = TOKENIZER,
    capacity: int = CAPACITY,
    end: int = END,
    ids: bool = True,
) -> DataFrame:
    """The pieces of each text with their place: ``sequence_id``, and ``offset`` in it, gapless from 0.

    One row for each piece, behind the columns ``keep`` (default: all); see :func:`pieces` for texts that
    are null, empty, repeated or very long. A column named like a new one is replaced. Pieces of equal
    length are told apart by their number, so ties and copies pack like any others.
    """
    spark: SparkSession = df.sparkSession
    scratch = Scratch(spark)
    columns = [c for c in (df.columns if keep is None else keep) if c.lower() not in PLACE]
    item = free("item", columns)
    cut = scratch.write(pieces(df, text, columns, tokenizer, capacity, end, ids, item), "packing-pieces")
    places, _ = rounds(cut.select(F.col(f"`{item}`").alias("item"), "length"), capacity, scratch)
    before = Window.partitionBy("sequence_id").orderBy("turn", "item").rowsBetween(Window.unboundedPreceding, -1)
    placed = places.select(
        F.col("item").alias(item), "sequence_id", F.coalesce(F.sum("length").over(before), F.lit(0)).alias("offset")
    )
    release(spark)
    return cut.join(placed, item).drop(item)
