"""Quality and toxicity by hierarchical empirical Bayes.

Two heads (quality, toxicity) work alike:

1. Document evidence: a logistic regression on a few dense features of the whole text: shape (symbols,
   capitals, digits, word lengths, repeated words and lines) and sums over telling words. Words tell
   if their log-odds between labelled classes are significant; they are counted on one half of
   the training rows and the regression is fitted on the other.
2. Site posteriors: evidence and labels are summed by host and by path (a section of a host) in
   grouped aggregation over all documents. A host's rate is shrunk to the global rate and a
   path's rate to its host's, each with a prior strength taken from the spread between sites
   (method of moments), so sparse sites stay near their prior. A document's own share is left out.
3. The posterior log-odds of a document are its evidence plus what its path's rate says more than
   the global rate.

Training uses about ``TRAINING_ROWS`` labelled rows, chosen by a hash of the id (the bound of the
broadcast join and of what the driver holds); everything else covers all rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom.llm import hashing
from starloom.llm.frames import bites, buffer, map_batches, utf8, with_columns
from starloom.session import materialise

TRAINING_ROWS = 20_000
WORD_BUCKETS = 1 << 18
#: Bytes of a word's beginning, which counts as a word of its own kind.
BEGINNING = 6
LEAST_Z = 3.5
LEAST_ROWS = 5
HEADS = ("quality", "toxic")
#: Bounds of the prior strength of a site, in documents.
STRENGTH = (2.0, 1e6)

_UPPER = np.zeros(256, bool)
_UPPER[ord("A") : ord("Z") + 1] = True
_DIGIT = np.zeros(256, bool)
_DIGIT[ord("0") : ord("9") + 1] = True
_SIGN = np.zeros(256, bool)
_SIGN[[b for b in range(0x21, 0x7F) if not chr(b).isalnum() and chr(b) not in ".,;:'\"-()?"]] = True
_MARK = np.zeros(256, bool)
_MARK[list(b".,;:'\"-()?")] = True


@dataclass
class Tokens:
    """Plain words of texts and the beginnings of long ones, as buckets."""

    words: np.ndarray
    before: np.ndarray  # words before each text
    bucket: np.ndarray  # of words and beginnings
    owner: np.ndarray  # the text of each bucket

    @classmethod
    def of(cls, texts: pa.Array) -> Tokens:
        raw, offsets = buffer(pc.utf8_lower(texts))
        begin, end, before = hashing.words(raw, offsets, hashing.IS_PLAIN)
        prefix = hashing.Prefix(raw)
        long = np.flatnonzero(end - begin > BEGINNING)
        stem = hashing.mix(prefix.of(begin[long], begin[long] + BEGINNING) + np.uint64(1))
        words, stems = ((x >> np.uint64(64 - 18)).astype(np.int64) for x in (prefix.of(begin, end), stem))
        owner = np.repeat(np.arange(len(before) - 1), np.diff(before))
        return cls(words, before, np.concatenate([words, stems]), np.concatenate([owner, owner[long]]))

    def cells(self, at=slice(None)) -> tuple[np.ndarray, np.ndarray]:
        """The distinct pairs of text and bucket."""
        cell = np.unique(self.owner[at] * WORD_BUCKETS + self.bucket[at])
        return cell // WORD_BUCKETS, cell % WORD_BUCKETS


def shape(texts: pa.Array, tokens: Tokens) -> np.ndarray:
    """Features of the form of each text."""
    words, before = tokens.words, tokens.before
    raw, offsets = buffer(texts)
    size = np.maximum(np.diff(offsets), 1)
    begin, _, blank = hashing.words(raw, offsets)
    n_words = np.maximum(np.diff(blank), 1)
    ink = hashing.per_text(~hashing.IS_SPACE[raw], offsets)
    rates = [hashing.per_text(kind[raw], offsets) / size for kind in (_UPPER, _DIGIT, _SIGN, _MARK)]
    owner = np.repeat(np.arange(len(before) - 1), np.diff(before))
    distinct = np.bincount(np.unique(owner * WORD_BUCKETS + words) // WORD_BUCKETS, minlength=len(before) - 1)
    lines = hashing.per_text(raw == 10, offsets)
    return np.stack(
        [
            np.log1p(np.diff(blank)),
            ink / n_words,
            *(np.sqrt(r) for r in rates),
            distinct / np.maximum(np.diff(before), 1),
            lines / n_words,
            np.diff(before) / n_words,
            np.minimum(np.diff(blank), 20) / 20,
        ],
        axis=1,
    )


def telling(tokens: Tokens, weights: np.ndarray) -> np.ndarray:
    """Over the distinct telling words of each text: sum and maximum for the class, sum against it, their rates."""
    before = tokens.before
    n = len(before) - 1
    owner, bucket = tokens.cells(np.flatnonzero(weights[tokens.bucket] != 0))
    weight = weights[bucket]
    positive, negative = np.maximum(weight, 0), np.maximum(-weight, 0)
    most = np.zeros(n)
    np.maximum.at(most, owner, positive)
    size = np.sqrt(np.maximum(np.diff(before), 1))
    up, down = np.bincount(owner, positive, n), np.bincount(owner, negative, n)
    return np.stack([np.minimum(up, 40), most, np.minimum(down, 40), 10 * up / size, 10 * down / size], axis=1)


@dataclass
class Head:
    weights: np.ndarray  # by bucket of words
    mean: np.ndarray
    scale: np.ndarray
    coefficients: np.ndarray  # the last is the intercept

    def evidence(self, form: np.ndarray, tokens: Tokens) -> np.ndarray:
        """Log-odds of each text."""
        x = (np.concatenate([form, telling(tokens, self.weights)], axis=1) - self.mean) / self.scale
        return np.clip(x @ self.coefficients[:-1] + self.coefficients[-1], -20, 20)


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0, rounds: int = 30) -> tuple[np.ndarray, ...]:
    """Mean, scale and coefficients (intercept last) by Newton's method."""
    mean, scale = x.mean(axis=0), np.maximum(x.std(axis=0), 1e-6)
    x = np.concatenate([(x - mean) / scale, np.ones((len(x), 1))], axis=1)
    b = np.zeros(x.shape[1])
    penalty = np.diag([ridge] * (len(b) - 1) + [1e-6])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ b, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + penalty, x.T @ (y - p) - penalty @ b)
        b += step
        if np.abs(step).max() < 1e-6:
            break
    return mean, scale, b


def word_weights(with_word: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Log-odds of the significant words from rows with the word by class (0, 1), and rows by class."""
    have = with_word + 0.5
    lack = np.maximum(rows[:, None] - with_word, 0) + 0.5
    odds = np.log(have[1] / lack[1]) - np.log(have[0] / lack[0])
    error = np.sqrt((1 / have + 1 / lack).sum(axis=0))
    told = (np.abs(odds) >= LEAST_Z * error) & (with_word.sum(axis=0) >= LEAST_ROWS)
    return np.where(told, np.clip(odds, -8, 8), 0.0)


def fit(training: DataFrame) -> dict[str, Head]:
    """Heads from ``training`` (text, half 0 or 1, and the labels); a head without both classes is left out."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((len(HEADS) * 2, WORD_BUCKETS + 1), np.int64)
        for batch in batches:
            for part in bites(batch, "text"):
                owner, bucket = Tokens.of(utf8(part.column("text"))).cells()
                for h, head in enumerate(HEADS):
                    label = part.column(head).to_numpy(zero_copy_only=False)
                    for value in (0, 1):
                        own = label == value
                        sums[2 * h + value] += np.bincount(bucket[own[owner]], minlength=WORD_BUCKETS + 1)
                        sums[2 * h + value, WORD_BUCKETS] += own.sum()
        kind, place = np.nonzero(sums)
        yield pa.RecordBatch.from_arrays(
            [pa.array(kind), pa.array(place), pa.array(sums[kind, place])], ["kind", "place", "n"]
        )

    first = training.where("half = 0").select("text", *HEADS)
    found = (
        map_batches(first, count, "kind long, place long, n long").groupBy("kind", "place").agg(F.sum("n").alias("n"))
    ).toArrow()  # buckets times classes
    sums = np.zeros((len(HEADS) * 2, WORD_BUCKETS + 1))
    sums[found.column("kind").to_numpy(), found.column("place").to_numpy()] = found.column("n").to_numpy()
    weights = {
        head: word_weights(sums[2 * h : 2 * h + 2, :-1], sums[2 * h : 2 * h + 2, -1]) for h, head in enumerate(HEADS)
    }
    shared = training.sparkSession.sparkContext.broadcast(weights)

    def dense(batch: pa.RecordBatch) -> list:
        texts = utf8(batch.column("text"))
        tokens = Tokens.of(texts)
        form = shape(texts, tokens)
        rows = [np.concatenate([form, telling(tokens, shared.value[head])], axis=1) for head in HEADS]
        return [pa.array(np.concatenate(rows, axis=1).tolist(), pa.list_(pa.float64()))]

    features = with_columns(
        training.where("half = 1"), "text", [T.StructField("x", T.ArrayType(T.DoubleType()))], dense, list(HEADS)
    ).toArrow()  # TRAINING_ROWS times the dense features
    heads = {}
    x = np.array(features.column("x").to_pylist(), float)
    for h, head in enumerate(HEADS):
        y = features.column(head).to_pylist()
        own = [i for i, v in enumerate(y) if v in (0, 1)]
        label = np.array([y[i] for i in own], float)
        if len(set(label.tolist())) == 2:
            part = np.split(x, len(HEADS), axis=1)[h][own]
            heads[head] = Head(weights[head], *fit_logistic(part, label))
    return heads


def _rate(evidence):
    return 1 / (1 + F.exp(-evidence))


def _logit(p):
    return F.log(p / (1 - p))


def posteriors(scored: DataFrame, head: str) -> DataFrame:
    """``scored`` (host, path, evidence_<head>, label_<head>) with the rates of its host and path and the posterior."""
    evidence, own = F.col(f"evidence_{head}"), F.col("own")
    scored = scored.withColumn(
        "own", F.when(F.col(f"label_{head}").isin(0, 1), F.col(f"label_{head}").cast("double")).otherwise(_rate(evidence))
    )
    paths = scored.groupBy("host", "path").agg(F.count("*").alias("n"), F.sum("own").alias("s"))
    paths = materialise(paths, f"paths-{head}")
    hosts = paths.groupBy("host").agg(F.sum("n").alias("host_n"), F.sum("s").alias("host_s"))
    world = hosts.agg(F.sum("host_n").alias("world_n"), F.sum("host_s").alias("world_s"))

    def strength(sites: DataFrame, n: str, s: str, mean, name: str) -> DataFrame:
        """Prior strength from the spread of the sites' rates around their mean, sampling spread taken off."""
        m = F.least(F.greatest(mean, F.lit(1e-4)), F.lit(1 - 1e-4))
        spread = F.sum(F.pow(F.col(s) / F.col(n) - mean, 2) * F.col(n) - m * (1 - m))
        weight = F.sum(F.col(n))
        between = F.greatest(spread / weight, F.lit(1e-9))
        raw = F.avg(m * (1 - m)) / between - 1
        return sites.agg(F.least(F.greatest(raw, F.lit(STRENGTH[0])), F.lit(STRENGTH[1])).alias(name))

    placed = hosts.crossJoin(F.broadcast(world))  # one row
    global_rate = F.col("world_s") / F.col("world_n")
    of_hosts = strength(placed, "host_n", "host_s", global_rate, "host_strength")
    of_paths = strength(
        paths.join(hosts, paths.host.eqNullSafe(hosts.host)).select("n", "s", "host_n", "host_s"),
        "n", "s", F.col("host_s") / F.col("host_n"), "path_strength",
    )
    prior = F.broadcast(world.crossJoin(of_hosts).crossJoin(of_paths))  # one row
    sites = paths.alias("p").join(hosts.alias("h"), F.col("p.host").eqNullSafe(F.col("h.host"))).crossJoin(prior)
    sites = sites.select(
        F.col("p.host").alias("of_host"), F.col("p.path").alias("of_path"), "n", "s", "host_n", "host_s",
        global_rate.alias("global_rate"), "host_strength", "path_strength",
    )
    joined = scored.join(
        sites, F.col("host").eqNullSafe(F.col("of_host")) & F.col("path").eqNullSafe(F.col("of_path"))
    )
    # Without the document itself.
    host_rate = (F.col("host_strength") * F.col("global_rate") + F.col("host_s") - own) / (
        F.col("host_strength") + F.col("host_n") - 1
    )
    path_rate = (F.col("path_strength") * F.col("host_rate") + F.col("s") - own) / (
        F.col("path_strength") + F.col("n") - 1
    )
    bounded = [F.least(F.greatest(F.col(c), F.lit(1e-6)), F.lit(1 - 1e-6)) for c in ("path_rate", "global_rate")]
    return (
        joined.withColumn("host_rate", host_rate)
        .withColumn("path_rate", path_rate)
        .withColumn("posterior", _rate(evidence + _logit(bounded[0]) - _logit(bounded[1])))
        .withColumnsRenamed({c: f"{head}_{c}" for c in ("host_rate", "path_rate", "posterior")})
        .drop("own", "of_host", "of_path", "n", "s", "host_n", "host_s", "global_rate", "host_strength", "path_strength")
    )


def classify(
    docs: DataFrame,
    labels: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    host: str = "source",
    path: str = "lang",
    training_rows: int = TRAINING_ROWS,
) -> DataFrame:
    """One row per row of ``docs``: id, rates of its host and path, posterior of each head, and ``kept``.

    ``labels`` has doc_id and the 0/1 columns quality and toxic, null where unknown; of several
    labels of one id the smallest quality and the largest toxic count. ``kept`` needs a quality of a
    half or more and a toxicity below. A null or empty text is rejected, whatever its posterior.
    A head that has no labels of both classes gives evidence 0. Null hosts and paths are sites of
    their own. Repeated rows are all classified and count in their sites. Empty tables give empty
    results. Other columns are not used.
    """
    base = docs.select(
        F.col(doc_id).alias("doc_id"), F.col(host).cast("string").alias("host"), F.col(path).cast("string").alias("path"),
        F.col(text).alias("text"),
    )
    marks = labels.groupBy("doc_id").agg(F.min("quality").alias("quality"), F.max("toxic").alias("toxic"))
    marks = materialise(marks.where("doc_id is not null"), "labels")
    total = marks.count()
    cut = int(min(1.0, training_rows / max(total, 1)) * (2**31 - 1))
    chosen = marks.where(F.pmod(F.xxhash64("doc_id"), F.lit(2**31 - 1)) <= cut).withColumn(
        "half", F.pmod(F.xxhash64(F.lit("half"), "doc_id"), F.lit(2)).cast("int")
    )
    training = materialise(
        # At most about TRAINING_ROWS rows of four numbers. Equal texts count once.
        base.join(F.broadcast(chosen), "doc_id").dropDuplicates(["text", *HEADS]).select("text", "half", *HEADS),
        "training",
    )
    heads = docs.sparkSession.sparkContext.broadcast(fit(training))

    def score(batch: pa.RecordBatch) -> list:
        texts = utf8(batch.column("text"))
        tokens = Tokens.of(texts)
        form = shape(texts, tokens)
        out = [
            pa.array(heads.value[h].evidence(form, tokens) if h in heads.value else np.zeros(len(texts)))
            for h in HEADS
        ]
        return [*out, pa.array(np.diff(tokens.before) == 0)]

    fields = [T.StructField(f"evidence_{h}", T.DoubleType()) for h in HEADS] + [T.StructField("empty", T.BooleanType())]
    scored = with_columns(base, "text", fields, score, ["doc_id", "host", "path"])
    labelled = materialise(
        scored.join(marks.withColumnsRenamed({h: f"label_{h}" for h in HEADS}), "doc_id", "left"), "scored"
    )
    done = labelled
    for head in HEADS:
        done = posteriors(done, head)
    columns = [f"{h}_{c}" for h in HEADS for c in ("host_rate", "path_rate", "posterior")]
    kept = (F.col("quality_posterior") >= 0.5) & (F.col("toxic_posterior") < 0.5) & ~F.col("empty")
    return done.select("doc_id", *columns, kept.alias("kept"))
