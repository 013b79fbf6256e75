"""Deep-shallow ordering of suffixes.

Shallow: multikey quicksort whose symbols are eight bytes; each pass splits the groups that are
still tied by their next symbol, all groups at once. Deep: groups that share more than ``shallow``
bytes go into a blind trie, which branches on single bytes and compares only once per string.
"""

from __future__ import annotations

import numpy as np

SHALLOW = 32


def _symbols(padded: np.ndarray, at: np.ndarray, left: np.ndarray) -> np.ndarray:
    """The next eight bytes of each suffix as a number; bytes past its end count as zero."""
    windows = np.lib.stride_tricks.sliding_window_view(padded, 8)
    taken = windows[at].copy()
    short = left < 8
    if short.any():
        taken[short] *= (np.arange(8) < left[short][:, None]).astype(np.uint8)
    return taken.view(">u8").ravel().astype(np.uint64)


def _common(a: bytes, b: bytes, start: int) -> int:
    """Length of the common prefix of two strings that agree before ``start``."""
    n = min(len(a), len(b))
    if a[start:n] == b[start:n]:
        return n
    differs = int.from_bytes(a[start:n], "big") ^ int.from_bytes(b[start:n], "big")
    return n - (differs.bit_length() + 7) // 8


class BlindTrie:
    """A trie of branching bytes only; an inner node is [depth, {byte: child}], a leaf a list of numbers."""

    def __init__(self):
        self.root = None
        self.strings: dict[int, bytes] = {}

    def insert(self, number: int, string: bytes, shared: int) -> None:
        self.strings[number] = string
        if self.root is None:
            self.root = [number]
            return
        node = self.root
        while isinstance(node, tuple):  # blind: bytes between branches are not looked at
            node = node[1].get(string[node[0]] if node[0] < len(string) else -1) or next(iter(node[1].values()))
        other = self.strings[node[0]]
        depth = _common(string, other, shared)
        if depth == len(string) == len(other):
            node.append(number)
            return
        parent, branch, node = None, None, self.root
        mine = string[depth] if depth < len(string) else -1
        theirs = other[depth] if depth < len(other) else -1
        while isinstance(node, tuple) and node[0] < depth:
            parent, branch = node, string[node[0]] if node[0] < len(string) else -1
            node = node[1][branch]
        if isinstance(node, tuple) and node[0] == depth:
            node[1][mine] = [number]
            return
        split = (depth, {theirs: node, mine: [number]})
        if parent is None:
            self.root = split
        else:
            parent[1][branch] = split

    def ordered(self, shared: int) -> tuple[list[int], list[int]]:
        """Numbers in order of their strings, and the common prefix of each with the one before."""
        order, common, stack, joint = [], [], [(self.root, shared)], shared
        while stack:
            node, joint = stack.pop()
            if isinstance(node, tuple):
                depth, children = node
                keys = sorted(children, reverse=True)
                stack.extend((children[k], depth) for k in keys[:-1])
                stack.append((children[keys[-1]], joint))
            else:
                size = len(self.strings[node[0]])
                order.extend(node)
                common.extend([joint] + [size] * (len(node) - 1))
        return order, common


def order(
    data: np.ndarray, starts: np.ndarray, lengths: np.ndarray, groups: np.ndarray, shallow: int = SHALLOW
) -> tuple[np.ndarray, np.ndarray]:
    """Order of the suffixes data[start : start + length] inside their groups, which stand in order of number.

    Also the common prefix of each suffix with the one before it in that order; -1 where a group
    begins.
    """
    n = len(starts)
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    lcp = np.full(n, -1, np.int64)
    if not n:
        return np.empty(0, np.int64), lcp
    suffixes = np.argsort(groups, kind="stable")
    tied = np.ones(n, bool)  # whether a place is tied with the one before
    tied[0] = False
    tied[1:] = groups[suffixes[1:]] == groups[suffixes[:-1]]
    depth = 0
    while depth < shallow:
        member = tied.copy()
        member[:-1] |= tied[1:]
        places = np.flatnonzero(member)
        if not len(places):
            return suffixes, lcp
        own = suffixes[places]
        group = np.cumsum(~tied[places])
        left = np.clip(lengths[own] - depth, 0, 8)
        symbol = _symbols(padded, np.minimum(starts[own] + depth, len(padded) - 8), left)
        sort = np.lexsort((left, symbol, group))
        own, symbol, left, group = own[sort], symbol[sort], left[sort], group[sort]
        suffixes[places] = own
        together = group[1:] == group[:-1]
        equal = together & (symbol[1:] == symbol[:-1]) & (left[1:] == left[:-1])
        parted = np.flatnonzero(together & ~equal) + 1
        differs = symbol[parted] ^ symbol[parted - 1]
        lcp[places[parted]] = depth + np.minimum(_leading(differs), np.minimum(left[parted], left[parted - 1]))
        still = np.zeros(len(places), bool)
        still[1:] = equal & (left[1:] == 8)
        ended = np.zeros(len(places), bool)
        ended[1:] = equal & (left[1:] < 8)
        lcp[places[ended]] = depth + left[ended]  # equal to their ends
        tied[places] = still
        depth += 8
    for begin, end in _runs(tied):
        trie = BlindTrie()
        for i in suffixes[begin:end].tolist():
            trie.insert(i, data[starts[i] : starts[i] + lengths[i]].tobytes(), depth)
        numbers, common = trie.ordered(depth)
        suffixes[begin:end] = numbers
        lcp[begin + 1 : end] = common[1:]
    return suffixes, lcp


def _leading(differs: np.ndarray) -> np.ndarray:
    """Equal bytes before the first difference of two symbols; 8 if there is none."""
    count = np.zeros(len(differs), np.int64)
    for byte in range(1, 9):
        count += (differs >> np.uint64(64 - 8 * byte)) == 0
    return count


def _runs(tied: np.ndarray) -> list[tuple[int, int]]:
    """Begin and end of the runs of places that are tied."""
    edge = np.diff(np.concatenate([[False], tied, [False]]).astype(np.int8))
    return list(zip((np.flatnonzero(edge == 1) - 1).tolist(), np.flatnonzero(edge == -1).tolist()))
