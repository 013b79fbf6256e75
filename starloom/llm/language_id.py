"""Language identification by unigrams over a fixed public vocabulary, all segmentations summed.

Each language has a probability for every piece of the vocabulary. The probability of a word is the
sum over all its segmentations into pieces, by the forward algorithm; that of a text is the product
over its words. The probabilities are found by expectation maximisation: expected counts of pieces
over all segmentations of the training words, by the forward-backward algorithm.

Words are lower-cased and split at white space; a word of any length is summed whole. A character
that is no piece is one arc of a common unknown piece.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom.llm import hashing
from starloom.llm.frames import bites, map_batches, utf8, with_columns
from starloom.session import materialise

VOCABULARY = public_tokenizers.path("piece_bpe_32k.model")
#: Labelled documents to fit on, in expectation; a hash of the id chooses them.
TRAINING_DOCUMENTS = 20_000
ITERATIONS = 4
#: Training documents of each language at least, if it has so many.
LEAST_DOCUMENTS = 300
#: Keeps forward sums in the middle of the range of a double; taken out again at the end.
SCALE = 8.0
SMOOTHING = 0.02
UNDECIDED = "und"
SPACE = "▁"
#: Words remembered by a Python worker between bites; then it starts afresh.
REMEMBERED = 600_000
#: The same in characters.
REMEMBERED_SIZE = 32 << 20

_letter = regex.compile(r"\p{L}").search


def _symbols(text: str) -> np.ndarray:
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    return hashing.mix(points * np.uint64(2) + np.uint64(1))


class Pieces:
    """The vocabulary as hashes of pieces and of all their prefixes."""

    def __init__(self, path: str):
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        every = range(model.get_piece_size())
        pieces = [
            model.id_to_piece(i) for i in every if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i))
        ]
        self.size = len(pieces)
        self.unknown = self.size
        numbers = {p: i for i, p in enumerate(pieces)}
        prefixes = sorted({p[:n] for p in pieces for n in range(1, len(p) + 1)})
        ends = np.cumsum([len(p) for p in prefixes])
        starts = ends - [len(p) for p in prefixes]
        hashes = hashing.Prefix(_symbols("".join(prefixes))).of(starts, ends)
        order = np.argsort(hashes)
        self.hashes = hashes[order]
        self.number = np.array([numbers.get(p, -1) for p in prefixes], np.int64)[order]
        self.longest = max(map(len, pieces))


@lru_cache(maxsize=1)
def pieces_of(path: str) -> Pieces:
    return Pieces(path)


@dataclass
class Lattice:
    """Arcs between the nodes of words (one node more than characters), sorted by how far in the word they end."""

    first: np.ndarray  # first node of each word
    last: np.ndarray
    start: np.ndarray
    end: np.ndarray
    piece: np.ndarray
    steps: np.ndarray  # bounds of the arcs of each step

    @classmethod
    def of(cls, words: list[str], pieces: Pieces) -> Lattice:
        sizes = np.array([len(w) for w in words], np.int64)
        ends = np.cumsum(sizes)
        begins = ends - sizes
        prefix = hashing.Prefix(_symbols("".join(words)))
        total = int(ends[-1]) if len(ends) else 0
        word_end = np.repeat(ends, sizes)
        word = np.repeat(np.arange(len(words)), sizes)
        alive = np.arange(total)
        arcs_start, arcs_end, arcs_piece = [], [], []
        single = np.zeros(total, bool)
        for n in range(1, pieces.longest + 1):
            alive = alive[alive + n <= word_end[alive]]
            key = prefix.of(alive, alive + n)
            at = np.minimum(np.searchsorted(pieces.hashes, key), len(pieces.hashes) - 1)
            hit = pieces.hashes[at] == key
            alive, at = alive[hit], at[hit]
            if not len(alive):
                break
            number = pieces.number[at]
            real = number >= 0
            arcs_start.append(alive[real])
            arcs_end.append(alive[real] + n)
            arcs_piece.append(number[real])
            if n == 1:
                single[alive[real]] = True
        rest = np.flatnonzero(~single)
        start = np.concatenate([*arcs_start, rest])
        end = np.concatenate([*arcs_end, rest + 1])
        piece = np.concatenate([*arcs_piece, np.full(len(rest), pieces.unknown)])
        owner = word[start] if total else start
        step = end - begins[owner] if total else end
        order = np.lexsort((end, step))
        start, end, piece, owner, step = start[order], end[order], piece[order], owner[order], step[order]
        top = int(step[-1]) if len(step) else 0
        index = np.arange(len(words))
        return cls(
            begins + index, ends + index, start + owner, end + owner, piece, np.searchsorted(step, np.arange(1, top + 2))
        )

    def forward(self, weights: np.ndarray) -> np.ndarray:
        """Sum over all ways from the first node of a word to each node, per language."""
        nodes = int(self.last[-1]) + 1 if len(self.last) else 0
        alpha = np.zeros((nodes, weights.shape[1]))
        alpha[self.first] = 1
        for a, b in zip(self.steps[:-1], self.steps[1:]):
            end = self.end[a:b]
            heads = np.flatnonzero(np.concatenate([[True], end[1:] != end[:-1]]))
            alpha[end[heads]] = np.add.reduceat(alpha[self.start[a:b]] * weights[self.piece[a:b]], heads, axis=0)
        return alpha

    def backward(self, weights: np.ndarray) -> np.ndarray:
        nodes = int(self.last[-1]) + 1 if len(self.last) else 0
        beta = np.zeros((nodes, weights.shape[1]))
        beta[self.last] = 1
        for a, b in reversed(list(zip(self.steps[:-1], self.steps[1:]))):
            # All arcs out of a node end behind it, so what ends last is complete first.
            np.add.at(beta, self.start[a:b], beta[self.end[a:b]] * weights[self.piece[a:b]])
        return beta


    def log_sums(self, weights: np.ndarray, backward: bool = False) -> np.ndarray:
        """Logarithms of ``forward`` or ``backward``, for words of any length.

        A node's sum is taken relative to that of its neighbour, which every way that matters is near.
        """
        nodes = int(self.last[-1]) + 1 if len(self.last) else 0
        out = np.zeros((nodes, weights.shape[1]))
        here, there, away = (self.start, self.end, 1) if backward else (self.end, self.start, -1)
        owner = np.searchsorted(self.first, self.start, "right") - 1
        far = self.last[owner] - here if backward else here - self.first[owner]
        order = np.lexsort((here, far))
        bounds = np.searchsorted(far[order], np.arange(1, int(far.max(initial=0)) + 2))
        for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
            arcs = order[a:b]
            node = here[arcs]
            heads = np.flatnonzero(np.concatenate([[True], node[1:] != node[:-1]]))
            beside = out[node + away]
            sums = np.add.reduceat(np.exp(out[there[arcs]] - beside) * weights[self.piece[arcs]], heads, axis=0)
            out[node[heads]] = beside[heads] + np.log(sums)
        return out


def _by_length(words: list[str], weights: np.ndarray) -> tuple[list[str], np.ndarray, np.ndarray]:
    """The words with the mark of their beginning, and places of those whose sums fit a double and of the others.

    A way through a word has at most as many arcs as characters, none of less than the least weight.
    """
    marked = [SPACE + w for w in words]
    direct = int(575 / max(1.0, -np.log(weights.min())))  # e^-575 is 1e-250
    long = np.fromiter((len(w) > direct for w in marked), bool, len(marked))
    return marked, np.flatnonzero(~long), np.flatnonzero(long)


def word_scores(words: list[str], weights: np.ndarray, pieces: Pieces) -> np.ndarray:
    """Log-probability of each word in each language, summed over all its segmentations."""
    marked, short, long = _by_length(words, weights)
    out = np.empty((len(words), weights.shape[1]))
    for places, direct in ((short, True), (long, False)):
        if len(places):
            lattice = Lattice.of([marked[i] for i in places.tolist()], pieces)
            out[places] = np.log(lattice.forward(weights)[lattice.last]) if direct else lattice.log_sums(weights)[lattice.last]
    return out - np.array([len(w) for w in marked])[:, None] * np.log(SCALE)


def expected_counts(words: list[str], counts: np.ndarray, weights: np.ndarray, pieces: Pieces) -> np.ndarray:
    """Expected occurrences of each piece in each language; ``counts`` of words by language."""
    marked, short, long = _by_length(words, weights)
    sums = np.zeros((pieces.size + 1, weights.shape[1]))
    for places, direct in ((short, True), (long, False)):
        if not len(places):
            continue
        lattice = Lattice.of([marked[i] for i in places.tolist()], pieces)
        owner = np.searchsorted(lattice.first, lattice.start, "right") - 1
        if direct:
            alpha, beta = lattice.forward(weights), lattice.backward(weights)
            through = alpha[lattice.start] * beta[lattice.end] / alpha[lattice.last][owner]
        else:
            alpha, beta = lattice.log_sums(weights), lattice.log_sums(weights, backward=True)
            through = np.exp(alpha[lattice.start] + beta[lattice.end] - alpha[lattice.last][owner])
        share = through * weights[lattice.piece] * counts[places][owner]
        for k in range(weights.shape[1]):
            sums[:, k] += np.bincount(lattice.piece, share[:, k], pieces.size + 1)
    return sums


@dataclass
class Model:
    languages: list[str]
    weights: np.ndarray  # probability of each piece and language, times SCALE to its length
    prior: np.ndarray
    vocabulary: str


def _lengths(path: str) -> np.ndarray:
    pieces = pieces_of(path)
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    every = range(model.get_piece_size())
    named = [model.id_to_piece(i) for i in every if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i))]
    assert len(named) == pieces.size
    return np.array([len(p) for p in named] + [1])


def fit(docs: DataFrame, text: str, lang: str, row_hash, bound: int = TRAINING_DOCUMENTS, vocabulary: str = VOCABULARY):
    """A model from the rows with a language; None if there are none.

    About ``bound`` rows, chosen by ``row_hash`` (a 64-bit hash column), are used, and at least
    ``LEAST_DOCUMENTS`` of each language that has so many. The model's size
    is that of the vocabulary times the number of languages.
    """
    labelled = docs.where(F.col(lang).isNotNull() & F.col(text).isNotNull())
    per_language = {r[0]: r[1] for r in labelled.groupBy(lang).count().collect()}
    if not per_language:
        return None
    languages = sorted(per_language)
    total = sum(per_language.values())
    wanted = {x: max(bound * n / total, LEAST_DOCUMENTS) for x, n in per_language.items()}
    cuts = [F.lit(x) for own in per_language for x in (own, int(min(1.0, wanted[own] / per_language[own]) * (2**31 - 1)))]
    chosen = labelled.where(F.pmod(row_hash, F.lit(2**31 - 1)) <= F.element_at(F.create_map(*cuts), F.col(lang))).select(
        F.col(lang).alias("lang"), F.col(text).alias("text")
    )

    def words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in bites(batch, "text"):
                found: dict[str, Counter] = {}
                for own, value in zip(part.column("lang").to_pylist(), utf8(part.column("text")).to_pylist()):
                    found.setdefault(own, Counter()).update(value.lower().split())
                for own, counter in found.items():
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([own] * len(counter)), pa.array(counter.keys(), pa.string()), pa.array(counter.values(), pa.int64())],
                        ["lang", "word", "n"],
                    )

    counted = materialise(
        map_batches(chosen, words, "lang string, word string, n long").groupBy("lang", "word").agg(F.sum("n").alias("n")),
        "words",
    )
    lengths = _lengths(vocabulary)
    size, n_languages = len(lengths), len(languages)
    probability = np.full((size, n_languages), 1.0 / size)
    context = docs.sparkSession.sparkContext
    for _ in range(ITERATIONS):
        weights = context.broadcast(probability * SCALE ** lengths[:, None])

        def expect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            pieces = pieces_of(vocabulary)
            sums = np.zeros((size, n_languages))
            for batch in batches:
                for at in range(0, batch.num_rows, 20_000):
                    part = batch.slice(at, 20_000)
                    counts = np.zeros((part.num_rows, n_languages))
                    column = np.searchsorted(languages, part.column("lang").to_pylist())
                    counts[np.arange(part.num_rows), column] = part.column("n").to_numpy()
                    sums += expected_counts(part.column("word").to_pylist(), counts, weights.value, pieces)
            piece, language = np.nonzero(sums)
            yield pa.RecordBatch.from_arrays(
                [pa.array(piece), pa.array(language), pa.array(sums[piece, language])], ["piece", "language", "n"]
            )

        found = (
            map_batches(counted, expect, "piece long, language long, n double")
            .groupBy("piece", "language")
            .agg(F.sum("n").alias("n"))
            .toArrow()  # pieces times languages
        )
        expected = np.zeros((size, n_languages))
        expected[found.column("piece").to_numpy(), found.column("language").to_numpy()] = found.column("n").to_numpy()
        share = expected / np.maximum(expected.sum(axis=0), 1e-9)
        probability = (1 - SMOOTHING) * share + SMOOTHING / size
        weights.unpersist()
    prior = np.log(np.array([per_language[x] for x in languages]) / total)
    return Model(languages, probability * SCALE ** lengths[:, None], prior, vocabulary)


class Memory(dict):
    """Numbers words as they come; scores[k] belongs to number k."""

    def __init__(self, model: Model):
        self.model = model
        self.scores = np.empty((0, len(model.languages)))
        self.size = 0

    def __missing__(self, word: str) -> int:
        number = self[word] = len(self)
        self.size += len(word)
        return number

    def learn(self) -> None:
        fresh = list(self)[len(self.scores) :]
        pieces = pieces_of(self.model.vocabulary)
        blocks = [
            word_scores(fresh[i : i + 20_000], self.model.weights, pieces) for i in range(0, len(fresh), 20_000)
        ]
        self.scores = np.concatenate([self.scores, *blocks])


_memory: dict[int, Memory] = {}


def _remembered(key: int, model: Model) -> Memory:
    memory = _memory.get(key)
    if memory is None or len(memory) > REMEMBERED or memory.size > REMEMBERED_SIZE:
        _memory.clear()
        memory = _memory[key] = Memory(model)
    return memory


def predict_texts(texts: list[str], memory: Memory) -> tuple[list[str], np.ndarray]:
    model = memory.model
    numbers = [np.fromiter(map(memory.__getitem__, t.lower().split()), np.int64) for t in texts]
    memory.learn()
    total = np.array([memory.scores[n].sum(axis=0) for n in numbers]).reshape(len(texts), -1) + model.prior
    best = total.argmax(axis=1)
    with np.errstate(under="ignore"):
        posterior = 1 / np.exp(total - total.max(axis=1, keepdims=True)).sum(axis=1)
    letters = [bool(_letter(t)) for t in texts]
    names = [model.languages[b] if ok else UNDECIDED for b, ok in zip(best.tolist(), letters)]
    return names, np.where(letters, posterior, 0.0)


def predict(
    docs: DataFrame, model: Model | None, text: str = "text", keep: list[str] | None = None
) -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score``, the posterior probability of the language.

    Null texts and texts without a letter are ``und`` with score 0, as is every text if there is no
    model. Ties go to the first language by name. Texts and words of any length are scored whole. Repeated rows are kept, an empty table stays
    empty, and columns of the two names are replaced.
    """
    fields = [T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())]
    if model is None:
        kept = [c for c in (docs.columns if keep is None else keep) if c.lower() not in ("lang_pred", "score")]
        return docs.select(
            *[f"`{c}`" for c in kept], F.lit(UNDECIDED).alias("lang_pred"), F.lit(0.0).alias("score")
        )
    shared = docs.sparkSession.sparkContext.broadcast(model)
    key = hash((model.weights.tobytes(), *model.languages))

    def make(batch: pa.RecordBatch) -> list:
        names, score = predict_texts(utf8(batch.column(text)).to_pylist(), _remembered(key, shared.value))
        return [pa.array(names, pa.string()), pa.array(score)]

    return with_columns(docs, text, fields, make, keep, 8 << 20)


def identify(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang", bound: int = TRAINING_DOCUMENTS
) -> DataFrame:
    """doc_id, held_out, lang_pred and score of every row; rows held out are not learnt from.

    A row is held out if crc32 of its id as text leaves 1 modulo 3; a null id counts as empty text.
    """
    remainder = F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % 3
    own = docs.select(
        F.col(doc_id).alias("doc_id"), (remainder == 1).alias("held_out"), F.col(text).alias("text"), F.col(lang).alias("lang")
    )
    model = fit(own.where("not held_out"), "text", "lang", F.xxhash64("doc_id"), bound)
    return predict(own.select("doc_id", "held_out", "text"), model, "text", ["doc_id", "held_out"])
