"""Quality rules with line frequency across documents.

Each document is described once (word counts, repeated windows, hashes of its normalised lines).
Lines are counted per host over its distinct documents: texts are told apart by their normalised lines,
and texts that are near duplicates of each other (word shingles of five words, similarity 0.8 or more)
are one document with many copies. A line in more than ``limit`` documents of a host is removed, and a
document with less than ``least_left`` of its words left is depleted, however much of it the host's
documents share. Documents that fail the base rules or are depleted are rejected.

Only texts with a line in more than ``limit`` texts of their host need to be compared. Similarity is the
share of equal places in two sketches of ``SKETCH`` hashes (one permutation, empty places filled from
the next, a byte of each hash; standard error 0.04, and 1 in 256 of the places that differ look equal). Sketches are banded, the texts of a host that share a band are compared
with one of them, and links are connected. A copy that meets none of its group counts by itself.

A line is normalised by dropping white space and digits and lowering ASCII letters.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom.llm import hashing, near_dedup
from starloom.llm.frames import Scratch, buffer, free, utf8, with_columns
from starloom.session import materialise

WINDOW = 8
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
#: A line in more classes of texts of a host is removed from all of its texts.
LINE_LIMIT = 10
#: Words of a shingle, and the similarity from which texts are copies of one document.
SHINGLE = 5
SIMILAR = 0.8
#: Hashes of a sketch, and of a band of it: pairs at the limit share a band with a probability of 0.998.
SKETCH, BAND = 120, 6
#: Share of the words that must be left.
LEAST_LEFT = 0.3

COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
_LINES = T.ArrayType(T.StructType([T.StructField("line", T.LongType()), T.StructField("words", T.IntegerType())]))
FIELDS = [
    *(T.StructField(c, T.LongType()) for c in COUNTS),
    T.StructField("identity", T.LongType()),
    T.StructField("lines", _LINES),
    T.StructField("sketch", T.ArrayType(T.ByteType())),
]

_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32
_DROPPED = hashing.IS_SPACE.copy()
_DROPPED[ord("0") : ord("9") + 1] = True


def _lines(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of every line of every text, and the text it belongs to."""
    breaks = np.flatnonzero(raw == 10)
    owner = np.searchsorted(offsets, breaks, "right") - 1
    text = np.concatenate([np.arange(len(offsets) - 1), owner])
    starts = np.concatenate([offsets[:-1], breaks + 1])
    order = np.lexsort((starts, text))
    text, starts = text[order], starts[order]
    ends = np.empty_like(starts)
    ends[:-1] = starts[1:] - 1
    closing = np.ones(len(text), bool)
    closing[:-1] = text[1:] != text[:-1]
    ends[closing] = offsets[text[closing] + 1]
    return starts, ends, text


def _repeated_words(word_hashes: np.ndarray, before: np.ndarray) -> np.ndarray:
    """Words of each text inside windows that the text has twice or more."""
    n = len(word_hashes)
    texts = len(before) - 1
    if n < WINDOW:
        return np.zeros(texts, np.int64)
    owner = np.repeat(np.arange(texts), np.diff(before))
    inside = np.flatnonzero(owner[: n - WINDOW + 1] == owner[WINDOW - 1 :])
    key = hashing.mix(hashing.windows(word_hashes, WINDOW)[inside] + owner[inside].astype(np.uint64))
    order = np.argsort(key)
    same = key[order][1:] == key[order][:-1]
    twice = np.zeros(len(key), bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    edges = np.zeros(n + 1, np.int64)
    np.add.at(edges, inside[twice], 1)
    np.add.at(edges, inside[twice] + WINDOW, -1)
    return hashing.per_text(np.cumsum(edges)[:n] > 0, before)


def _sketches(word_hashes: np.ndarray, before: np.ndarray) -> pa.Array:
    """A byte of the least hash of the shingles in each of ``SKETCH`` classes of hashes; none for a text without words.

    A text of fewer words than a shingle has one shingle of all of them.
    """
    texts = len(before) - 1
    owner = np.repeat(np.arange(texts), np.diff(before))
    shingles = hashing.windows(word_hashes, SHINGLE)
    of_text = owner[: len(shingles)]
    inside = of_text == owner[len(owner) - len(shingles) :] if len(shingles) else np.zeros(0, bool)
    shingles, of_text = shingles[inside], of_text[inside]
    short = np.flatnonzero((np.diff(before) > 0) & (np.diff(before) < SHINGLE))
    sums = np.concatenate([[np.uint64(0)], np.cumsum(word_hashes, dtype=np.uint64)])
    shingles = np.concatenate([shingles, hashing.mix(sums[before[short + 1]] - sums[before[short]])])
    of_text = np.concatenate([of_text, short])
    least = np.full(texts * SKETCH, 2**32 - 1, np.uint64)
    np.minimum.at(least, of_text * SKETCH + (shingles % np.uint64(SKETCH)).astype(np.int64), shingles >> np.uint64(32))
    least = least.reshape(texts, SKETCH)
    # An empty place takes the next filled one, marked by how far it is.
    twice = np.concatenate([least, least], 1)
    filled = np.where(twice < 2**32 - 1, np.arange(2 * SKETCH), 4 * SKETCH)
    nearest = np.minimum.accumulate(filled[:, ::-1], 1)[:, ::-1][:, :SKETCH]
    some = np.diff(before) > 0
    at = np.where(some[:, None], nearest, 0)
    far = (at - np.arange(SKETCH)).astype(np.uint64)
    values = np.take_along_axis(twice, at, 1) + far * np.uint64(0x9E3779B1)
    offsets = np.concatenate([[0], np.cumsum(some * SKETCH)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values[some].ravel().astype(np.uint8).view(np.int8)))


def describe_batch(texts: pa.Array) -> list:
    raw, offsets = buffer(texts)
    begin, end, before = hashing.words(raw, offsets)
    n_words = np.diff(before)
    ink = ~hashing.IS_SPACE[raw]
    word_chars = hashing.per_text(ink & ((raw & 0xC0) != 0x80), offsets)
    n_symbols = hashing.per_text(_SYMBOL[raw], offsets)
    prefix = hashing.Prefix(raw)
    hashes = prefix.of(begin, end)
    repeated = _repeated_words(hashes, before)

    starts, ends, owner = _lines(raw, offsets)
    in_line = np.searchsorted(begin, ends) - np.searchsorted(begin, starts)
    full = in_line > 0
    starts, ends, owner, in_line = starts[full], ends[full], owner[full], in_line[full]
    exact = hashing.mix(prefix.of(starts, ends) + owner.astype(np.uint64))
    _, first = np.unique(exact, return_index=True)
    n_lines = np.bincount(owner, minlength=len(texts))
    n_dup = n_lines - np.bincount(owner[first], minlength=len(texts))

    kept = ~_DROPPED[raw]
    place = np.concatenate([[0], np.cumsum(kept, dtype=np.int64)])
    normal = hashing.Prefix(_LOWER[raw[kept]], 1).of(place[starts], place[ends])
    first_line = np.cumsum(n_lines) - n_lines
    nth = (np.arange(len(owner)) - first_line[owner]).astype(np.uint64)
    sums = np.concatenate([[np.uint64(0)], np.cumsum(hashing.mix(normal + hashing.mix(nth)), dtype=np.uint64)])
    identity = sums[first_line + n_lines] - sums[first_line]
    lines = pa.ListArray.from_arrays(
        pa.array(np.concatenate([[0], np.cumsum(n_lines)]).astype(np.int32)),
        pa.StructArray.from_arrays(
            [
                pa.array(normal.view(np.int64)),
                pa.array(in_line.astype(np.int32)),
            ],
            ["line", "words"],
        ),
    )
    counts = [pa.array(x.astype(np.int64)) for x in (n_words, word_chars, n_symbols, n_dup, repeated)]
    return [*counts, pa.array(identity.view(np.int64)), lines, _sketches(hashes, before)]


def describe(df: DataFrame, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``df`` with the counts of the base rules, the hashes of its lines that have a word, one of them all, and a sketch of its shingles.

    Null and empty texts have zeros and no lines.
    """
    return with_columns(df, text, FIELDS, lambda batch: describe_batch(utf8(batch.column(text))), keep)


def _classes(texts: DataFrame, scratch: Scratch) -> DataFrame:
    """identity and ``label`` of the texts (identity, host, sketch) that have near duplicates in their host."""
    bands = F.transform(
        F.sequence(F.lit(0), F.lit(SKETCH // BAND - 1)),
        lambda i: F.xxhash64("host", i, F.slice("sketch", i * BAND + 1, BAND)),
    )
    drawn = texts.select("identity", F.explode(bands).alias("bucket"))
    leaders = drawn.groupBy("bucket").agg(F.min("identity").alias("leader"), F.count("*").alias("n"))
    # Written first: few buckets hold two texts, so that the others need not be moved to meet them.
    shared = scratch.write(leaders.where("n > 1").select("bucket", "leader"), "shared-buckets")
    pairs = (
        drawn.join(shared, "bucket")
        .where("identity <> leader")
        .select(F.col("identity").alias("member"), "leader")
        .distinct()
    )
    both = pairs.join(texts.select(F.col("identity").alias("member"), F.col("sketch").alias("own")), "member").join(
        texts.select(F.col("identity").alias("leader"), F.col("sketch").alias("others")), "leader"
    )
    equal = F.size(F.filter(F.arrays_zip("own", "others"), lambda x: x["own"] == x["others"]))
    links = scratch.write(both.where(equal >= SIMILAR * SKETCH).select("member", "leader"), "near-copies")
    return near_dedup.components(links, scratch).select(F.col("node").alias("identity"), "label")


def verdicts(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    host: str = "source",
    limit: int = LINE_LIMIT,
    least_left: float = LEAST_LEFT,
) -> DataFrame:
    """One row per row of ``docs``: id, ``text_key`` (hash of the text), the counts, what is left and the verdict.

    ``removed`` lists the numbers (from 0, among the lines that have a word) of the lines above the
    limit. Null and empty texts fail the base rules. Rows with a null host count as one host of
    their own. Rows with the same id are judged apart; equal rows get equal verdicts. An empty
    table gives an empty result. Other columns of ``docs`` are not touched.
    """
    narrow = docs.select(
        F.col(f"`{doc_id}`").alias("doc_id"),
        F.col(f"`{host}`").cast("string").alias("host"),
        F.xxhash64(F.col(f"`{text}`")).alias("text_key"),
        F.col(f"`{text}`").alias("text"),
    )
    # From here on a host is a hash, and part of the hashes of its lines and texts.
    hosted = F.xxhash64(F.col("host").isNull(), "host")
    described = describe(narrow, keep=["doc_id", "host", "text_key"]).withColumns({
        "row": F.monotonically_increasing_id(),
        "host": hosted,
        "identity": F.xxhash64(hosted, "identity"),
        "line_words": F.col("lines.words"),
        "lines": F.transform("lines.line", lambda line: F.xxhash64(hosted, line)),
    })
    # Written once, so that the row numbers are fixed and texts are read and parsed once.
    described = materialise(described, "lines")
    scratch = Scratch(docs.sparkSession)
    # A text's lines are read from one of its rows per host.
    distinct = described.groupBy("identity").agg(F.min("row").alias("row"), F.any_value("lines").alias("lines"))
    each = F.explode(F.array_distinct("lines")).alias("line")
    one_each = scratch.write(distinct, "texts").select("identity", "row", each)
    often = one_each.groupBy("line").agg(F.count("*").alias("texts")).where(F.col("texts") > limit)
    # Written first: frequent lines are few, so that the others need not be moved to meet them.
    often = scratch.write(often.select("line"), "often")
    held = scratch.write(one_each.join(often, "line", "left_semi"), "frequent-lines")
    texts = described.select("row", "identity", "host", "sketch").join(held.select("row").distinct(), "row", "left_semi")
    labels = _classes(scratch.write(texts.drop("row"), "frequent-texts"), scratch)
    classed = held.join(labels, "identity", "left").select("line", F.coalesce("label", "identity").alias("label"))
    counted = classed.distinct().groupBy("line").agg(F.count("*").alias("classes"))
    common = materialise(counted.where(F.col("classes") > limit).select("line"), "boilerplate")
    scratch.clear()
    placed = described.select("row", F.posexplode(F.arrays_zip("lines", "line_words")).alias("number", "it")).select(
        "row", "number", F.col("it.lines").alias("line"), F.col("it.line_words").alias("words")
    )
    hit = placed.join(common, "line", "left_semi")
    lost = hit.groupBy("row").agg(
        F.sum("words").cast("bigint").alias("words_lost"), F.sort_array(F.collect_list("number")).alias("removed")
    )
    judged = described.drop("lines", "line_words", "sketch").join(lost, "row", "left")
    base_failed = (F.col("n_words") < MIN_WORDS) | (
        100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words")
    )
    words_left = F.col("n_words") - F.coalesce("words_lost", F.lit(0))
    return judged.select(
        "doc_id",
        "text_key",
        *COUNTS,
        base_failed.alias("base_failed"),
        (~base_failed & (words_left >= least_left * F.col("n_words"))).alias("kept"),
        words_left.alias("words_left"),
        F.coalesce("removed", F.array().cast("array<int>")).alias("removed"),
    )


def _keep_lines(text: str, removed: list[int]) -> str:
    gone, worded, left = set(removed), 0, []
    for line in text.split("\n"):
        has_word = bool(line.strip(" \t\n\v\f\r"))
        if not (has_word and worded in gone):
            left.append(line)
        worded += has_word
    return "\n".join(left)


def apply(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", host: str = "source") -> DataFrame:
    """The rows of ``docs`` that are kept, all columns, without the lines above the limit.

    See :func:`verdicts` for nulls, empty texts and repeated rows; the latter all stay. Of other
    columns nothing changes.
    """
    gone, left = free("gone", docs.columns), free("left", docs.columns)
    judged = verdicts(docs, doc_id, text, host).where("kept")
    marks = judged.groupBy("doc_id", "text_key").agg(F.first("removed").alias(gone))
    d, m = docs.alias("d"), marks.alias("m")
    same = F.col(f"d.`{doc_id}`").eqNullSafe(F.col("m.doc_id")) & (F.xxhash64(F.col(f"d.`{text}`")) == F.col("m.text_key"))
    kept = d.join(m, same).select(*[F.col(f"d.`{c}`") for c in docs.columns], f"m.{gone}")

    def make(batch: pa.RecordBatch) -> list:
        texts, removed = batch.column(text).to_pylist(), batch.column(gone).to_pylist()
        return [pa.array([_keep_lines(t, r) if r else t for t, r in zip(texts, removed)], pa.string())]

    done = with_columns(
        kept, text, [T.StructField(left, T.StringType())], make, [c for c in docs.columns if c != text], uses=(gone,)
    )
    return done.select(*[F.col(left).alias(text) if c == text else F.col(f"`{c}`") for c in docs.columns])
