"""Anchors: a content-determined sample of suffixes that every window of a text meets.

A window of ``length`` bytes is anchored at its smallest ``gram``-byte string (by hash, the leftmost
on ties). The choice depends on the bytes of the window alone, so equal windows have their anchors
at equal places. The windows of one anchor start at neighbouring places; together they cover the
anchor's hull.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

from starloom.llm import hashing


@dataclass
class Anchors:
    text: np.ndarray  # row of the text
    at: np.ndarray  # first window's start, from the start of the text
    span: np.ndarray  # windows after the first
    place: np.ndarray  # where the anchor is in the hull
    gram: np.ndarray  # hash of the anchor's string
    hull: np.ndarray  # hash of the hull's bytes and the anchor's place in it


def find(raw: np.ndarray, offsets: np.ndarray, length: int, gram: int) -> Anchors:
    n, empty = len(raw), np.empty(0, np.int64)
    if n < length:
        return Anchors(empty, empty, empty, empty, empty.view(np.uint64), empty.view(np.uint64))
    first = hashing.Prefix(raw)
    places = np.arange(n - gram + 1)
    grams = first.of(places, places + gram)
    bits = np.uint64(max(24, n.bit_length()))
    least = (grams >> bits << bits) | places.astype(np.uint64)
    have, size = length - gram + 1, 1
    while 2 * size <= have:
        least = np.minimum(least[:-size], least[size:])
        size *= 2
    if size < have:
        least = np.minimum(least[: len(least) - (have - size)], least[have - size :])
    anchor = (least & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)
    # Windows that end in their own text.
    starts = np.arange(len(anchor))
    owner_end = np.repeat(offsets[1:], np.diff(offsets))[: len(anchor)]
    inside = starts + length <= owner_end
    starts, anchor, owner_end = starts[inside], anchor[inside], owner_end[inside]
    if not len(starts):
        return Anchors(empty, empty, empty, empty, empty.view(np.uint64), empty.view(np.uint64))
    begins = np.ones(len(starts), bool)
    begins[1:] = (anchor[1:] != anchor[:-1]) | (starts[1:] != starts[:-1] + 1)
    low = starts[begins]
    high = starts[np.concatenate([np.flatnonzero(begins)[1:], [len(starts)]]) - 1]
    place = anchor[begins]
    second = hashing.Prefix(raw, 1)
    hulls = hashing.mix(second.of(low, high + length) + (place - low).astype(np.uint64))
    text = np.searchsorted(offsets, low, "right") - 1
    return Anchors(text, low - offsets[text], high - low, place - low, grams[place], hulls)
