"""Deep-shallow sorting of byte suffixes.

Multikey quicksort, eight bytes at a time and for all open groups at once,
sorts to a shallow depth; the groups that still agree there are ordered by
blind tries, which look at one byte where suffixes branch and compare whole
suffixes once each."""

from __future__ import annotations

import numpy as np

#: Depth in bytes beyond which tries take over.
SHALLOW = 32
_SHIFTS = (np.uint64(8) * np.arange(7, -1, -1, dtype=np.uint64))


def _word(data: np.ndarray, start: np.ndarray, length: np.ndarray, depth: np.ndarray) -> np.ndarray:
    """Eight bytes from ``depth`` on as a big-endian number; zeros beyond the
    suffix's end.  ``data`` has eight spare bytes."""
    at = start + np.minimum(depth, length)
    left = np.clip(length - depth, 0, 8)
    out = np.zeros(len(start), np.uint64)
    for j in range(8):
        out |= np.where(left > j, data[at + j], 0).astype(np.uint64) << _SHIFTS[j]
    return out


def order(data: np.ndarray, start: np.ndarray, length: np.ndarray, group: np.ndarray) -> np.ndarray:
    """A permutation that sorts the suffixes within each group.  ``group`` is
    ascending.  Suffixes with equal bytes are in any order."""
    n = len(start)
    perm = np.arange(n)
    heads = np.flatnonzero(np.diff(group, prepend=-1)) if n else perm
    seg = np.stack([heads, np.diff(heads, append=n), np.zeros(len(heads), np.int64)], axis=1)  # begin, size, depth
    raw = None
    while len(seg):
        seg = seg[seg[:, 1] > 1]
        deep = seg[:, 2] >= SHALLOW
        for begin, size, depth in seg[deep].tolist():
            raw = raw if raw is not None else data.tobytes()
            own = perm[begin:begin + size]
            perm[begin:begin + size] = own[_trie([raw[start[i]:start[i] + length[i]] for i in own.tolist()], depth)]
        seg = seg[~deep]
        if not len(seg):
            break
        begin, size, depth = seg.T
        which = np.repeat(np.arange(len(seg)), size)
        place = np.arange(len(which)) - np.repeat(np.cumsum(size) - size, size) + begin[which]
        item = perm[place]
        word = _word(data, start[item], length[item], depth[which])
        first = np.cumsum(size) - size
        three = np.sort(np.stack([word[first], word[first + size // 2], word[first + size - 1]]), axis=0)
        pivot = three[1][which]
        kind = (word > pivot).astype(np.int64) * 2 + (word == pivot)
        counts = np.bincount(which * 3 + kind, minlength=3 * len(seg)).reshape(-1, 3)
        base = begin[:, None] + np.cumsum(counts, axis=1) - counts
        to = np.empty(len(which), np.int64)
        for c in range(3):
            here = kind == c
            ranks = np.cumsum(here) - 1
            offset = np.concatenate([[0], np.cumsum(counts[:, c])])[:-1]
            to[here] = base[which[here], c] + ranks[here] - offset[which[here]]
        perm[to] = item
        seg = np.concatenate([np.stack([base[:, c], counts[:, c], depth + (8 if c == 1 else 0)], axis=1) for c in range(3)])
    return perm


def _common(a: bytes, b: bytes, lo: int) -> int:
    """Length of the common prefix, known to be ``lo`` at least."""
    hi = min(len(a), len(b))
    if a[lo:hi] == b[lo:hi]:
        return hi
    while hi - lo > 1:  # a[lo:hi] differs somewhere
        mid = (lo + hi) // 2
        if a[lo:mid] == b[lo:mid]:
            lo = mid
        else:
            hi = mid
    return lo


class _Node:
    __slots__ = ("depth", "branch")

    def __init__(self, depth: int):
        self.depth, self.branch = depth, {}


def _trie(texts: list[bytes], depth: int) -> list[int]:
    """The sorted order of texts that share ``depth`` bytes.  Leaves are
    lists of equal texts; a branch is keyed by its byte, -1 at a text's end."""
    symbol = lambda t, d: t[d] if d < len(t) else -1
    root: _Node | list[int] = [0]
    for i in range(1, len(texts)):
        t = texts[i]
        node = root
        while type(node) is _Node:  # blind: only branching bytes are looked at
            node = node.branch.get(symbol(t, node.depth)) or next(iter(node.branch.values()))
        other = texts[node[0]]
        lcp = _common(t, other, depth)
        if lcp == len(t) == len(other):
            node.append(i)
            continue
        above, node = None, root
        while type(node) is _Node and node.depth < lcp:
            above, node = node, node.branch[symbol(t, node.depth)]
        if type(node) is _Node and node.depth == lcp:
            node.branch[symbol(t, lcp)] = [i]
            continue
        split = _Node(lcp)
        split.branch[symbol(other, lcp)] = node
        split.branch[symbol(t, lcp)] = [i]
        if above is None:
            root = split
        else:
            above.branch[symbol(t, above.depth)] = split
    out, stack = [], [root]
    while stack:
        node = stack.pop()
        if type(node) is _Node:
            stack.extend(node.branch[s] for s in sorted(node.branch, reverse=True))
        else:
            out.extend(node)
    return out


def neighbours(data: np.ndarray, start: np.ndarray, length: np.ndarray, perm: np.ndarray, group: np.ndarray) -> np.ndarray:
    """lcp[i]: bytes that suffix perm[i] shares with perm[i - 1]; -1 at a
    group's beginning."""
    n = len(perm)
    lcp = np.full(n, -1, np.int64)
    at = np.flatnonzero(group[perm][1:] == group[perm][:-1]) + 1 if n else perm
    a, b = perm[at - 1], perm[at]
    both = np.minimum(length[a], length[b])
    lcp[at] = both
    depth = 0
    while len(at):
        d = np.full(len(at), depth)
        differ = _word(data, start[a], both, d) ^ _word(data, start[b], both, d)
        lead = np.zeros(len(at), np.int64)
        for j in range(1, 8):
            lead += (differ >> np.uint64(64 - 8 * j)) == 0
        hit = differ != 0
        lcp[at[hit]] = depth + lead[hit]
        on = ~hit & (both > depth + 8)
        at, a, b, both = at[on], a[on], b[on], both[on]
        depth += 8
    return lcp
