"""Token counts of texts by a SentencePiece model, huge texts by overlapping chunks.

Texts up to ``chunk`` characters are encoded whole. A longer one is encoded in chunks that overlap.
Lengths of the pieces give the byte offset of every token boundary of a chunk, and two
neighbouring encodings are spliced at a boundary that is proven stable: between two characters that
stand side by side in no piece of the vocabulary. No merge ever crosses such a place, whatever stands
further left or right, and the tokens on its two sides do not depend on each other. A space behind another
character is one, and so are most places in text of large alphabets. If the overlap holds no such place,
it is doubled, and beyond the whole left chunk that chunk is doubled, so the time stays linear even
for a text without any; such a text is held whole.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from starloom.llm.frames import utf8, with_columns

MODEL = public_tokenizers.path("piece_bpe_32k.model")
CHUNK = 32_768
OVERLAP = 512
SPACE = "▁"


class Counter:
    def __init__(self, path: str):
        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        ordinary = [
            not (self.model.is_byte(i) or self.model.is_control(i) or self.model.is_unknown(i))
            for i in range(len(pieces))
        ]
        #: Bytes of text behind each id.
        self.width = np.array(
            [len(p.replace(SPACE, " ").encode()) if own else 1 for p, own in zip(pieces, ordinary)], np.int64
        )
        texts = [p.replace(SPACE, " ") for p, own in zip(pieces, ordinary) if own]
        #: All pairs of neighbouring characters of a piece, sorted.
        self.inside = np.unique(np.concatenate([_pairs(t) for t in texts if len(t) > 1]))

    def ends(self, text: str) -> np.ndarray | None:
        """Byte offset in ``text`` of the end of each token; None if widths do not add up to it."""
        ends = np.cumsum(self.width[self.model.encode(text, num_threads=1)])
        size = len(text.encode())
        prefix = int(ends[-1]) - size if len(ends) else 0
        return ends - prefix if prefix in (0, 1) else None

    def count(self, text: str, chunk: int = CHUNK, overlap: int = OVERLAP) -> int:
        text = text.replace(SPACE, " ")  # the model takes both for the same symbol
        found = self._spliced(text, chunk, overlap) if len(text) > chunk else None
        return len(self.model.encode(text, num_threads=1)) if found is None else found

    def _spliced(self, text: str, chunk: int, overlap: int) -> int | None:
        """None if the model does not give the text back."""
        total, base, left, end = 0, 0, 0, chunk  # tokens before text[left:] are counted; its chunk begins at base
        ends = self.ends(text[:end])
        while ends is not None and end < len(text):
            back = overlap
            while back < end - left:
                start = end - back
                right = self.ends(text[start : start + chunk])
                if right is None:
                    return None
                at = self.stable(text, max(start, left), end)
                if at is not None:
                    total += int(np.searchsorted(ends, len(text[left:at].encode()), "right"))
                    base, left, end = start, at, min(start + chunk, len(text))
                    ends = _behind(right, text[start:at])
                    break
                back *= 2
            else:
                end = min(end + end - left, len(text))
                ends = self.ends(text[base:end])
                ends = None if ends is None else _behind(ends, text[base:left])
        return None if ends is None else total + len(ends)

    def stable(self, text: str, start: int, end: int) -> int | None:
        """The last place inside text[start:end] that no piece can cross."""
        pairs = _pairs(text[start:end])
        at = np.minimum(np.searchsorted(self.inside, pairs), len(self.inside) - 1)
        free = np.flatnonzero(self.inside[at] != pairs)
        return start + int(free[-1]) + 1 if len(free) else None


def _pairs(text: str) -> np.ndarray:
    """Neighbouring characters as numbers."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
    return points[:-1] << 21 | points[1:]


def _behind(ends: np.ndarray, text: str) -> np.ndarray:
    """The ends behind ``text``, with which the encoded text begins, counted from there."""
    size = len(text.encode())
    return ends[np.searchsorted(ends, size, "right") :] - size


@lru_cache(maxsize=2)
def counter(path: str) -> Counter:
    return Counter(path)


def count_tokens(
    df: DataFrame,
    text: str = "text",
    out: str = "n_tokens",
    model: str = MODEL,
    chunk: int = CHUNK,
    overlap: int = OVERLAP,
    keep: list[str] | None = None,
) -> DataFrame:
    """``df`` with the number of tokens of each text, without begin, end or other special tokens.

    Null and empty texts have 0 tokens. A very long text is encoded in chunks. Repeated rows keep their multiplicity, an empty table
    stays empty, and a column already named ``out`` is replaced.
    """

    def make(batch: pa.RecordBatch) -> list:
        own = counter(model)
        texts = utf8(batch.column(text)).to_pylist()
        short = [t for t in texts if len(t) <= chunk]
        sizes = iter([len(ids) for ids in own.model.encode(short, num_threads=1)] if short else [])
        return [pa.array([next(sizes) if len(t) <= chunk else own.count(t, chunk, overlap) for t in texts], pa.int64())]

    return with_columns(df, text, [T.StructField(out, T.LongType())], make, keep, 1 << 20)
