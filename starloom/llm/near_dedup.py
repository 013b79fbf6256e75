"""Near duplicates by improved consistent weighted sampling of TF-IDF shingles.

A text is the weighted set of its ``SHINGLE``-word shingles (lower-case ASCII; a text with fewer
words is one shingle), weighted by term frequency times inverse document frequency. Document
frequencies are counted over all documents in a table of ``DF_BUCKETS`` hashed buckets, whose size
does not depend on the corpus.

1. Equal texts are one class. Each text gets ``BANDS`` keys of ``ROWS`` samples each; two texts of
   weighted Jaccard similarity s agree in a sample with probability s.
2. Texts that share a key are compared by their exact weighted Jaccard similarity, and linked at
   ``SIMILARITY`` or more. A task compares a bucket as a whole, from the shingles that two of its members
   share, and returns links that connect what is similar, not pairs. A bucket with more than
   ``BLOCK_TEXTS`` texts or ``BLOCK_BYTES`` bytes is compared in pairs of blocks. One with more than
   ``LARGE`` texts goes first through ``ROUNDS`` rounds of a leader: all members are compared with it,
   spread over tasks. One minus the similarity is a metric, so members that are closer to the leader
   than the nearest failing member by more than the threshold cannot be linked to one that failed,
   and leave. What is left of it is split by rare shingles: similar texts share one of the rarest
   shingles that make up more than 1 - ``SIMILARITY`` of their weight. So every pair of a bucket is
   compared, or proven to be apart or connected anyway.
3. Links make classes by minimum labels and pointer jumping.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom.llm import hashing
from starloom.llm.frames import Scratch, bites, buffer, free, key_blocks, map_batches, release, utf8, with_columns
from starloom.session import materialise

SHINGLE = 5
SIMILARITY = 0.8
BANDS = 6
ROWS = 2
ROUNDS = 2
BLOCK_TEXTS = 1024
BLOCK_BYTES = 4 << 20
LARGE = 8 * BLOCK_TEXTS
DF_BUCKETS = 1 << 17

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32


def shingles(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The distinct shingles of each text: text, hash and count, sorted by text and hash."""
    raw, offsets = buffer(texts)
    raw = _LOWER[raw]
    begin, end, before = hashing.words(raw, offsets)
    n = np.diff(before)
    own = hashing.Prefix(raw).of(begin, end)
    rolled = hashing.windows(own, SHINGLE)
    owner = np.repeat(np.arange(len(n)), n)
    inside = np.flatnonzero(owner[: len(rolled)] == owner[SHINGLE - 1 :]) if len(rolled) else np.empty(0, np.int64)
    text, key = owner[inside], rolled[inside]
    few = np.flatnonzero((n > 0) & (n < SHINGLE))
    if len(few):
        short = [int(hashing.windows(own[before[i] : before[i + 1]], int(n[i]))[0]) for i in few]
        text = np.concatenate([text, few])
        key = np.concatenate([key, np.array(short, np.uint64)])
    order = np.lexsort((key, text))
    text, key = text[order], key[order]
    first = np.ones(len(key), bool)
    first[1:] = (key[1:] != key[:-1]) | (text[1:] != text[:-1])
    heads = np.flatnonzero(first)
    return text[heads], key[heads], np.diff(np.concatenate([heads, [len(key)]]))


def _bucket(key: np.ndarray, size: int) -> np.ndarray:
    return (key >> np.uint64(40)).astype(np.int64) % size


def document_frequencies(texts: DataFrame, text: str) -> tuple[np.ndarray, int]:
    """Documents behind each bucket of shingles (``DF_BUCKETS`` numbers), and the number of documents."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, documents = np.zeros(DF_BUCKETS, np.int64), 0
        for batch in batches:
            for part in bites(batch, text):
                _, key, _ = shingles(utf8(part.column(text)))
                sums += np.bincount(_bucket(key, DF_BUCKETS), minlength=DF_BUCKETS)
                documents += part.num_rows
        some = np.flatnonzero(sums)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.append(some, -1)), pa.array(np.append(sums[some], documents))], ["bucket", "n"]
        )

    rows = map_batches(texts.select(text), count, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    found = rows.toArrow()  # at most DF_BUCKETS + 1 rows
    bucket, n = (found.column(c).to_numpy() for c in ("bucket", "n"))
    table = np.zeros(DF_BUCKETS, np.int64)
    table[bucket[bucket >= 0]] = n[bucket >= 0]
    return table, int(n[bucket < 0].sum())


def inverse(frequencies: np.ndarray, documents: int) -> np.ndarray:
    """Weight of a shingle by bucket; positive."""
    return np.log1p((documents + 1) / (frequencies + 1)).astype(np.float32)


_SEEDS = [np.uint64(x) for x in np.random.default_rng(77).integers(1, 2**63, 2 * 64, dtype=np.uint64)]


def samples(text: np.ndarray, key: np.ndarray, weight: np.ndarray, texts: int, number: int) -> np.ndarray:
    """Improved consistent weighted sample ``number`` of each text (0 for a text without shingles)."""
    a = hashing.mix(key ^ _SEEDS[2 * number])
    b = hashing.mix(key + _SEEDS[2 * number + 1])
    unit = np.float32(2.0**-21)
    u1, u2, u3 = (
        (((a >> np.uint64(s)) & np.uint64(0x1FFFFF)).astype(np.float32) + np.float32(0.5)) * unit for s in (0, 21, 42)
    )
    u4, beta = ((((b >> np.uint64(s)) & np.uint64(0x1FFFFF)).astype(np.float32) + np.float32(0.5)) * unit for s in (0, 21))
    r = -np.log(u1 * u2)
    c = -np.log(u3 * u4)
    t = np.floor(np.log(weight) / r + beta)
    score = np.log(c) - r * (t - beta) - r
    heads = np.flatnonzero(np.concatenate([[True], text[1:] != text[:-1]])) if len(text) else np.empty(0, np.int64)
    out = np.zeros(texts, np.uint64)
    if not len(heads):
        return out
    sizes = np.diff(np.concatenate([heads, [len(text)]]))
    hit = np.flatnonzero(score == np.repeat(np.minimum.reduceat(score, heads), sizes))
    owner = text[hit]
    chosen = hit[np.concatenate([[True], owner[1:] != owner[:-1]])]
    out[text[chosen]] = hashing.mix(key[chosen] + t[chosen].astype(np.int64).view(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    return out


def band_keys(texts: pa.Array, idf: np.ndarray) -> pa.Array:
    """Keys of the bands of each text; none for a text without words."""
    text, key, count = shingles(texts)
    weight = count.astype(np.float32) * idf[_bucket(key, len(idf))]
    n = len(texts)
    keys = np.zeros((n, BANDS), np.uint64)
    for band in range(BANDS):
        own = np.full(n, band, np.uint64)
        for row in range(ROWS):
            own = hashing.mix(own * np.uint64(0x9E3779B97F4A7C15) + samples(text, key, weight, n, band * ROWS + row))
        keys[:, band] = own
    some = np.zeros(n, bool)
    some[text] = True
    return pa.ListArray.from_arrays(
        pa.array(np.concatenate([[0], np.cumsum(some * BANDS)]).astype(np.int32)), pa.array(keys[some].ravel().view(np.int64))
    )


def similarities(left: pa.Array, right: pa.Array, idf: np.ndarray) -> np.ndarray:
    """Weighted Jaccard similarity of the texts of each row."""
    n = len(left)
    (ta, ka, ca), (tb, kb, cb) = shingles(left), shingles(right)
    text, key = np.concatenate([ta, tb]), np.concatenate([ka, kb])
    weight = np.concatenate([ca, cb]) * idf[_bucket(key, len(idf))].astype(float)
    total = np.bincount(text, weight, n)
    order = np.lexsort((key, text))
    text, key, weight = text[order], key[order], weight[order]
    both = np.flatnonzero((text[1:] == text[:-1]) & (key[1:] == key[:-1]))
    shared = np.bincount(text[both], np.minimum(weight[both], weight[both + 1]), n)
    return shared / np.maximum(total - shared, 1e-9)


def _rare_shingles(texts: pa.Array, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The rarest shingles of each text that make up more than 1 - SIMILARITY of its weight."""
    text, key, count = shingles(texts)
    weight = count * idf[_bucket(key, len(idf))].astype(float)
    order = np.lexsort((key, -idf[_bucket(key, len(idf))], text))
    text, key, weight = text[order], key[order], weight[order]
    total = np.bincount(text, weight, len(texts))
    sums = np.cumsum(weight)
    base = np.concatenate([[0.0], np.cumsum(total)])[text]
    taken = (sums - weight - base) <= (1 - SIMILARITY) * total[text] * (1 + 1e-6)
    return text[taken], key[taken]


class _Compare:
    """Similarities of pairs of texts, looked up by key."""

    def __init__(self, texts: DataFrame, idf):
        self.texts, self.idf = texts, idf

    def __call__(self, pairs: DataFrame) -> DataFrame:
        """``pairs`` (member, leader) with their similarity."""
        idf = self.idf
        left = self.texts.select(F.col("text_key").alias("member"), F.col("text").alias("member_text"))
        right = self.texts.select(F.col("text_key").alias("leader"), F.col("text").alias("leader_text"))

        def make(batch: pa.RecordBatch) -> list:
            return [pa.array(similarities(utf8(batch.column("member_text")), utf8(batch.column("leader_text")), idf.value))]

        return with_columns(
            pairs.join(left, "member").join(right, "leader"),
            "member_text",
            [T.StructField("similarity", T.DoubleType())],
            make,
            ["member", "leader"],
            1 << 20,
            ("leader_text",),
        )


def _round(buckets: DataFrame, compare: _Compare, scratch: Scratch) -> tuple[DataFrame, DataFrame]:
    """Links to the leaders of the buckets (bucket, text_key), and what is left of the buckets."""
    leaders = buckets.groupBy("bucket").agg(F.min("text_key").alias("leader"))
    members = buckets.join(leaders, "bucket").where("text_key <> leader").withColumnRenamed("text_key", "member")
    scored = scratch.write(compare(members.select("member", "leader").distinct()), "scored")
    links = scored.where(F.col("similarity") >= SIMILARITY).select("member", "leader")
    seen = members.join(scored, ["member", "leader"])
    nearest = (
        seen.where(F.col("similarity") < SIMILARITY).groupBy("bucket").agg(F.max("similarity").alias("nearest"))
    )
    left = seen.join(nearest, "bucket").where(
        # the distance to the leader is within the threshold of the nearest failing member's
        (1 - F.col("similarity")) >= (1 - F.col("nearest")) - (1 - SIMILARITY) - 1e-9
    )
    left = scratch.write(left.select("bucket", F.col("member").alias("text_key")), "left")
    # A bucket of one member is done.
    several = left.groupBy("bucket").agg(F.count("*").alias("n")).where("n > 1").select("bucket")
    return links, left.join(several, "bucket", "left_semi")


def connect(row: np.ndarray, key: np.ndarray, count: np.ndarray, idf: np.ndarray, texts: int) -> np.ndarray:
    """For each text of a group the first text it is connected to by similarities of the threshold or more.

    The shingles (row, key, count) are sorted by row and key.
    """
    if texts < 2:
        return np.arange(texts)
    weight = idf[_bucket(key, len(idf))].astype(np.float32)
    total = np.bincount(row, weight * count, texts)
    # A shingle that occurs n times is n elements, so that minima of counts become common elements.
    level = np.arange(int(count.sum())) - np.repeat(np.cumsum(count) - count, count)
    row, weight = np.repeat(row, count), np.repeat(weight, count)
    element = hashing.mix(np.repeat(key, count) + level.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    _, column, shared = np.unique(element, return_inverse=True, return_counts=True)
    useful = shared[column] > 1
    _, column = np.unique(column[useful], return_inverse=True)
    row, weight = row[useful], np.sqrt(weight[useful])
    common = np.zeros((texts, texts), np.float32)
    order = np.argsort(column, kind="stable")
    row, weight, column = row[order], weight[order], column[order]
    width = 4096
    for start in range(0, int(column[-1]) + 1 if len(column) else 0, width):
        a, b = np.searchsorted(column, [start, start + width])
        part = np.zeros((texts, min(width, int(column[-1]) + 1 - start)), np.float32)
        part[row[a:b], column[a:b] - start] = weight[a:b]
        common += part @ part.T
    total = total.astype(np.float32)
    # common >= SIMILARITY * (total a + total b - common), with room for rounding
    common *= np.float32(1 + SIMILARITY)
    common += np.float32(1e-4) * np.maximum(total, 1)[:, None]
    linked = common >= np.float32(SIMILARITY) * (total[:, None] + total[None, :])
    parent = list(range(texts))

    def root(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for x, y in zip(*(side.tolist() for side in np.nonzero(np.triu(linked, 1)))):
        x, y = sorted((root(x), root(y)))
        parent[y] = x
    return np.array([root(x) for x in range(texts)])


def _compare_buckets(buckets: DataFrame, texts: DataFrame, idf) -> DataFrame:
    """Links (member, leader) inside buckets (bucket, text_key), each compared as a whole or in pairs of blocks."""
    sized = buckets.join(texts.select("text_key", F.octet_length("text").alias("bytes")), "text_key")
    # Buckets with the same members are compared once.
    each = sized.groupBy("bucket").agg(
        F.count("*").alias("n"), F.sum("bytes").alias("bytes"), F.bit_xor(F.xxhash64("text_key")).alias("members")
    )
    once = each.where("n > 1").groupBy("n", "bytes", "members").agg(F.min("bucket").alias("bucket"))
    blocks = F.greatest(F.ceil(F.col("n") / BLOCK_TEXTS), F.ceil(F.col("bytes") / BLOCK_BYTES), F.lit(1))
    blocks = F.least(blocks, F.col("n")).cast("int")
    chosen = buckets.join(once.select("bucket", blocks.alias("blocks")), "bucket")
    own = F.pmod(F.xxhash64("text_key"), F.col("blocks")).cast("int")
    other = F.explode(
        F.when(F.col("blocks") == 1, F.array(F.lit(0))).otherwise(
            F.filter(F.sequence(F.lit(0), F.col("blocks") - 1), lambda b: b != F.col("block"))
        )
    )
    dealt = (
        chosen.withColumn("block", own)
        .select("bucket", "text_key", "block", other.alias("other"))
        .select(
            F.xxhash64("bucket", F.least("block", "other"), F.greatest("block", "other")).alias("gram"), "text_key"
        )
        .join(texts, "text_key")
        .repartition("gram")
        .sortWithinPartitions("gram", "text_key")
    )
    schema = T.StructType([T.StructField(c, texts.schema["text_key"].dataType) for c in ("member", "leader")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in key_blocks(batches, "gram", 2 << 20):
            gram = block.column("gram").to_numpy(zero_copy_only=False)
            heads = [0, *(np.flatnonzero(gram[1:] != gram[:-1]) + 1).tolist(), len(gram)]
            found, start = [], 0
            for part in bites(block, "text"):  # the arrays behind shingles are many times the text
                row, key, count = shingles(utf8(part.column("text")))
                found.append((row + start, key, count))
                start += part.num_rows
            row, key, count = (np.concatenate(x) for x in zip(*found))
            bounds = np.searchsorted(row, heads)
            member, leader = [], []
            for a, b, s, e in zip(heads, heads[1:], bounds, bounds[1:]):
                first = connect(row[s:e] - a, key[s:e], count[s:e], idf.value, b - a)
                moved = np.flatnonzero(first != np.arange(b - a))
                member.append(moved + a)
                leader.append(first[moved] + a)
            keys = block.column("text_key")
            yield pa.RecordBatch.from_arrays(
                [keys.take(pa.array(np.concatenate(x))) for x in (member, leader)], ["member", "leader"]
            )

    return map_batches(dealt, run, schema)


def find_links(signatures: DataFrame, base: DataFrame, idf, scratch: Scratch, large: int = LARGE) -> DataFrame:
    """Linked pairs (member, leader) of text keys, enough to connect every class."""
    keyed = signatures.select("text_key", F.explode("keys").alias("bucket"))
    shared = keyed.groupBy("bucket").agg(F.count("*").alias("n")).where("n > 1")
    buckets = scratch.write(keyed.join(shared, "bucket"), "buckets")
    # One row of each text that shares a bucket: equal rows would cancel in the sums of members.
    wanted = signatures.join(buckets, "text_key", "left_semi").select(
        F.col("text_key").alias("key"), F.col("doc_id").alias("first")
    )
    same_row = (F.col("text_key") == F.col("key")) & F.col("doc_id").eqNullSafe(F.col("first"))
    rows = base.join(wanted, same_row).select("text_key", "text")
    chosen = scratch.write(rows.dropDuplicates(["text_key"]), "candidate-texts")
    release(base.sparkSession)
    compare = _Compare(chosen, idf)
    links = []
    small, rest = (buckets.where(x).select("bucket", "text_key") for x in (F.col("n") <= large, F.col("n") > large))
    for number in range(ROUNDS):
        if rest.isEmpty():
            break
        found, rest = _round(rest, compare, scratch)
        links.append(found)
        rest = scratch.write(rest, "rest")
    else:
        if not rest.isEmpty():
            rest = scratch.write(_split(rest, chosen, idf), "split")
        small = small.unionByName(rest)
    links.append(scratch.write(_compare_buckets(small, chosen, idf), "links"))
    every = links[0]
    for more in links[1:]:
        every = every.unionByName(more)
    return every.distinct()


def _split(buckets: DataFrame, texts: DataFrame, idf) -> DataFrame:
    """Finer buckets: of each bucket, the texts that share one of their rare shingles."""
    needed = texts.join(buckets.select("text_key").distinct(), "text_key", "left_semi")

    def rare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in bites(batch, "text"):
                text, key = _rare_shingles(utf8(part.column("text")), idf.value)
                yield pa.RecordBatch.from_arrays(
                    [part.column("text_key").take(pa.array(text)), pa.array(key.view(np.int64))], ["text_key", "shingle"]
                )

    schema = T.StructType([texts.schema["text_key"], T.StructField("shingle", T.LongType())])
    finer = buckets.join(map_batches(needed, rare, schema), "text_key").select(
        F.xxhash64("bucket", "shingle").alias("bucket"), "text_key"
    )
    several = finer.groupBy("bucket").agg(F.count("*").alias("n")).where("n > 1").select("bucket")
    return finer.join(several, "bucket", "left_semi")


def components(links: DataFrame, scratch: Scratch) -> DataFrame:
    """Label (smallest key of the component) of every key in ``links`` (member, leader)."""
    edges = scratch.write(
        links.select(F.col("member").alias("a"), F.col("leader").alias("b")).union(links.select("leader", "member")),
        "edges",
    )
    labels = scratch.write(edges.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("b")).select(
        "node", F.least("node", "b").alias("label")), "labels")
    while True:
        heard = (
            edges.join(labels, edges.b == labels.node)
            .groupBy(F.col("a").alias("node"))
            .agg(F.min("label").alias("heard"))
        )
        lower = labels.join(heard, "node").select("node", "label", F.least("label", "heard").alias("next"))
        jump = labels.select(F.col("node").alias("next"), F.col("label").alias("far"))
        step = scratch.write(
            lower.join(jump, "next").select(
                "node", F.least("next", "far").alias("label"), (F.least("next", "far") < F.col("label")).alias("moved")
            ),
            "labels",
        )
        labels = step.select("node", "label")
        if step.where("moved").isEmpty():
            return labels


def classes(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", large: int = LARGE) -> DataFrame:
    """One row per row of ``docs``: doc_id, text_key, class_id, class_size, representative.

    ``class_id`` is the smallest id of the class (null if all its ids are null, which come last).
    Equal texts are in one class; a null text or one without words is a class of its own with all
    equal texts, and is never linked to another. Repeated rows count in the size of their class
    and are all marked alike. An empty table gives an empty result. Other columns are not used.
    """
    spark = docs.sparkSession
    base = docs.select(
        F.col(doc_id).alias("doc_id"),
        F.unhex(F.md5(F.coalesce(F.col(text), F.lit("")))).alias("text_key"),
        F.col(text).alias("text"),
    )
    frequencies, documents = document_frequencies(base, "text")
    idf = spark.sparkContext.broadcast(inverse(frequencies, documents))
    scratch = Scratch(spark)
    signed = materialise(
        with_columns(
            base,
            "text",
            [T.StructField("keys", T.ArrayType(T.LongType()))],
            lambda batch: [band_keys(utf8(batch.column("text")), idf.value)],
            ["doc_id", "text_key"],
        ),
        "signatures",
    )
    signatures = scratch.write(
        signed.groupBy("text_key").agg(
            F.min("doc_id").alias("doc_id"), F.any_value("keys").alias("keys"), F.count("*").alias("copies")
        ),
        "texts",
    )
    labels = components(find_links(signatures, base, idf, scratch, large), scratch)
    labelled = materialise(
        signatures.join(labels, signatures.text_key == labels.node, "left").select(
            "text_key", "doc_id", "copies", F.coalesce("label", "text_key").alias("label")
        ),
        "labelled",
    )
    scratch.clear()
    lead = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "text_key"))
    sizes = labelled.groupBy("label").agg(lead.alias("lead"), F.sum("copies").alias("class_size"))
    named = labelled.join(sizes, "label").select(
        F.col("text_key").alias("key"), F.col("doc_id").alias("first"), "lead", "class_size"
    )
    return signed.join(named, F.col("text_key") == F.col("key")).select(
        "doc_id",
        "text_key",
        F.col("lead.doc_id").alias("class_id"),
        "class_size",
        ((F.col("text_key") == F.col("lead.text_key")) & F.col("doc_id").eqNullSafe(F.col("first"))).alias(
            "representative"
        ),
    )


def keep_one(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` that represent their class, all columns, one row of each class."""
    chosen = classes(docs, doc_id, text).where("representative")
    rows = free("rows", docs.columns)
    marks = chosen.groupBy("doc_id", "text_key").agg(F.count("*").alias(rows))
    d, m = docs.alias("d"), marks.alias("m")
    same = F.col(f"d.`{doc_id}`").eqNullSafe(F.col("m.doc_id")) & (
        F.unhex(F.md5(F.coalesce(F.col(f"d.`{text}`"), F.lit("")))) == F.col("m.text_key")
    )
    kept = d.join(m, same).select(*[F.col(f"d.`{c}`") for c in docs.columns], f"m.{rows}")
    single = kept.where(F.col(rows) == 1)
    # Only rows that repeat an id and a text need a second look.
    repeated = kept.where(F.col(rows) > 1).dropDuplicates([doc_id, text])
    return single.unionByName(repeated).drop(rows)
