"""Token ids of texts by a library, each distinct unit of text encoded once.

A unit is a stretch of text whose tokens do not depend on what stands around it; who cuts the units
proves that for the vocabulary at hand. Arrow finds the distinct units of a bite, the library encodes
those that are new to the Python worker, and the ids of a text are those of its units in order.
"""

from __future__ import annotations

import os
from collections.abc import Callable, Iterator
from functools import lru_cache
from itertools import chain, repeat

import numpy as np

from starloom.llm.frames import spread

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

from tokenizers import Tokenizer  # noqa: E402

#: Bytes of units and ids that a worker remembers; beyond them it starts afresh.
REMEMBERED = 144 << 20

#: Units given to the library in one call.
CALL = 4_000

#: Ids of texts one after another, and how many each text has.
Ids = tuple[np.ndarray, np.ndarray]
Encode = Callable[[list[str]], Ids]


def flatten(ids: list[list[int]]) -> Ids:
    counts = np.fromiter(map(len, ids), np.int64, len(ids))
    return np.fromiter(chain.from_iterable(ids), np.int32, int(counts.sum())), counts


@lru_cache(maxsize=4)
def tokenizer(path: str, plain_specials: bool = False) -> Tokenizer:
    own = Tokenizer.from_file(path)
    own.encode_special_tokens = plain_specials
    return own


def library(path: str, plain_specials: bool = False) -> Encode:
    """The ids of each text without added special tokens; ``plain_specials``: their strings are plain text."""
    own = tokenizer(path, plain_specials)
    return lambda texts: flatten([e.ids for e in own.encode_batch_fast(texts, add_special_tokens=False)])


class Memory:
    """Numbers units; ids of number k under encoder e are flat[e][starts[e][k] : starts[e][k] + counts[e][k]]."""

    def __init__(self, encoders: list[Encode]):
        self.encoders = encoders
        self.forget()

    def forget(self) -> None:
        self.known: dict[str, int] = {}
        self.bytes = 0
        self.flat = [np.empty(0, np.int32) for _ in self.encoders]
        self.starts = [np.empty(0, np.int64) for _ in self.encoders]
        self.counts = [np.empty(0, np.int64) for _ in self.encoders]

    def numbers(self, units: list[str]) -> np.ndarray:
        """The number of each unit, new ones encoded. Numbers hold until the next call of ``tidy``."""
        known = self.known
        numbers = np.fromiter(map(known.get, units, repeat(-1)), np.int64, len(units))
        fresh = np.flatnonzero(numbers < 0).tolist()
        if fresh:
            new = list(dict.fromkeys([units[i] for i in fresh]))
            known.update(zip(new, range(len(known), len(known) + len(new))))
            self._learn(new)
            numbers[fresh] = [known[units[i]] for i in fresh]
        return numbers

    def tidy(self) -> None:
        """Start afresh if more than the bound is remembered."""
        if self.bytes > REMEMBERED:
            self.forget()

    def _learn(self, new: list[str]) -> None:
        for e, encode in enumerate(self.encoders):
            parts = [encode(new[at : at + CALL]) for at in range(0, len(new), CALL)]
            counts = np.concatenate([part[1] for part in parts])
            self.starts[e] = np.concatenate([self.starts[e], len(self.flat[e]) + np.cumsum(counts) - counts])
            self.counts[e] = np.concatenate([self.counts[e], counts])
            self.flat[e] = np.concatenate([self.flat[e], *[part[0] for part in parts]])
            self.bytes += 4 * int(counts.sum()) + 16 * len(new)
        self.bytes += sum(map(len, new)) + 130 * len(new)

    def ids(self, numbers: np.ndarray, encoder: int = 0) -> Ids:
        """Ids of the numbered units one after another, and how many each has."""
        counts = self.counts[encoder][numbers]
        return self.flat[encoder][spread(self.starts[encoder][numbers], counts)], counts


_memories: dict[tuple, Memory] = {}


def memory(key: tuple, encoders: Callable[[], list[Encode]]) -> Memory:
    """The worker's memory for these encoders."""
    if key not in _memories:
        _memories[key] = Memory(encoders())
    return _memories[key]


def stretches(texts: list[str], size: int, cut: Callable[[str, int], int]) -> Iterator[list[tuple[int, str, bool]]]:
    """Lists of (row, stretch of its text, whether it is the text's last) with about ``size`` characters each.

    ``cut(text, at)`` is the first place at or behind ``at`` where the text may be cut. A text without such
    a place stays in one piece.
    """
    held, weight = [], 0
    for row, text in enumerate(texts):
        start = 0
        while True:
            end = cut(text, start + size - weight) if len(text) - start > size - weight else len(text)
            held.append((row, text[start:end], end == len(text)))
            weight += end - start
            start = end
            if weight >= size:
                yield held
                held, weight = [], 0
            if end == len(text):
                break
    if held:
        yield held
