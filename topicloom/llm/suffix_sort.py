"""Sorting strings by the deep-shallow scheme: multikey quicksort first, blind tries for what still ties."""

from __future__ import annotations

import numpy as np

# Words of eight bytes that the quicksort looks at, and the size from which it stops splitting.
SHALLOW_WORDS = 4
SMALL = 2048


def _words(strings: list[bytes]) -> np.ndarray:
    """The first SHALLOW_WORDS * 8 bytes of each string as big-endian numbers, padded with zero bytes."""
    wide = 8 * SHALLOW_WORDS
    packed = np.array([s[:wide] for s in strings], dtype=f"S{wide}")
    return packed.view(np.uint8).reshape(len(strings), wide).view(">u8").astype(np.uint64)


def _quicksort(words: np.ndarray, rows: np.ndarray, depth: int, out: list[np.ndarray]) -> None:
    """Three-way partition by the word at ``depth``; only the equal part moves on to the next word."""
    stack = [(rows, depth)]
    while stack:
        rows, depth = stack.pop()
        if depth == SHALLOW_WORDS or len(rows) <= 1:
            out.append(rows)
            continue
        if len(rows) <= SMALL:
            out.append(rows[np.lexsort([words[rows, d] for d in range(SHALLOW_WORDS - 1, depth - 1, -1)])])
            continue
        column = words[rows, depth]
        sample = np.sort(column[:: max(1, len(column) // 9)])
        pivot = sample[len(sample) // 2]
        less, more = column < pivot, column > pivot
        # The stack gives back the smallest part first.
        stack += [(part, deep) for part, deep in ((rows[more], depth), (rows[~less & ~more], depth + 1), (rows[less], depth)) if len(part)]


def common_prefix(x: bytes, y: bytes) -> int:
    short = min(len(x), len(y))
    apart = int.from_bytes(x[:short], "little") ^ int.from_bytes(y[:short], "little")
    return ((apart & -apart).bit_length() - 1) >> 3 if apart else short


def blind_trie(strings: list[bytes], rows: list[int]) -> tuple[list[int], list[int]]:
    """The rows in the order of their strings, and the common prefix of each with the one before it (0 for the first).

    An inner node knows the length at which its strings part and one byte per branch, nothing of the text between. A
    string goes down by these bytes alone; the leaf it ends at tells where it really leaves the tree.
    """
    root: list = [None, [rows[0]]]  # leaf: [None, rows]; inner node: [length, {byte: node}]
    for row in rows[1:]:
        x = strings[row]
        path, node = [], root
        while node[0] is not None:
            path.append(node)
            byte = x[node[0]] if node[0] < len(x) else -1
            node = node[1].get(byte) or next(iter(node[1].values()))
        y = strings[node[1][0]]
        if x == y:
            node[1].append(row)
            continue
        length = common_prefix(x, y)
        mine, other = (x[length] if length < len(x) else -1), (y[length] if length < len(y) else -1)
        above = None
        for inner in path:
            if inner[0] >= length:
                break
            above = inner
        below = root if above is None else above[1][x[above[0]] if above[0] < len(x) else -1]
        if below[0] == length:
            below[1][mine] = [None, [row]]
        else:
            split = [length, {mine: [None, [row]], other: below}]
            if above is None:
                root = split
            else:
                above[1][x[above[0]] if above[0] < len(x) else -1] = split
    order, shared, stack = [], [], [(root, 0)]
    while stack:
        node, length = stack.pop()
        if node[0] is None:
            order += node[1]
            shared += [length] + [len(strings[node[1][0]])] * (len(node[1]) - 1)
        else:
            branches = [node[1][byte] for byte in sorted(node[1])]
            # Its first branch parts from what came before where the node does, the others where the node itself splits.
            stack += [(branch, node[0]) for branch in branches[:0:-1]] + [(branches[0], length)]
    return order, shared


def sorted_with_prefixes(strings: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Order of the strings, and the length of the common prefix of each with the one before it in that order."""
    if not strings:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    words = _words(strings)
    parts: list[np.ndarray] = []
    _quicksort(words, np.arange(len(strings)), 0, parts)
    order = np.concatenate(parts)
    lengths = np.array([len(s) for s in strings])
    apart = words[order[1:]] ^ words[order[:-1]]
    prefix = np.zeros(len(order), np.int64)
    tied = np.ones(len(order) - 1, bool)
    for d in range(SHALLOW_WORDS):
        here = apart[:, d]
        at = np.flatnonzero(tied & (here != 0))
        # Leading zero bytes of the first word that differs.
        same = sum((here[at] < np.uint64(1 << bits)).astype(np.int64) for bits in range(56, 0, -8))
        prefix[1:][at] = 8 * d + same
        tied[at] = False
    prefix[1:] = np.minimum(prefix[1:], np.minimum(lengths[order[1:]], lengths[order[:-1]]))
    edges = np.flatnonzero(np.diff(np.concatenate([[False], tied, [False]]).astype(np.int8)))
    for first, last in zip(edges[::2], edges[1::2]):
        rows, shared = blind_trie(strings, order[first : last + 1].tolist())
        order[first : last + 1] = rows
        prefix[first + 1 : last + 1] = shared[1:]
        # Padding can hide the ends of strings, so the borders of the group follow its new order.
        for i in (first, last + 1):
            if 0 < i < len(order):
                prefix[i] = common_prefix(strings[order[i - 1]], strings[order[i]])
    return order, prefix
