"""Deep-shallow ordering of suffixes up to a given depth (helper of operator 9)."""

from __future__ import annotations

import numpy as np

#: Bytes that the multikey quicksort looks at in one step.
STEP = 8


def _keys(data: np.ndarray, starts: np.ndarray, at: int, width: int) -> np.ndarray:
    """Bytes at..at+width of each suffix as one big-endian number."""
    out = np.zeros(len(starts), np.uint64)
    for j in range(width):
        out = (out << np.uint64(8)) | data[starts + at + j]
    return out


def multikey(data: np.ndarray, starts: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Order by the first ``depth`` bytes, ``STEP`` at a time; (order, group starts).

    Each step sorts only the members of groups that are still tied.
    """
    order = np.arange(len(starts), dtype=np.int32)
    group = np.zeros(len(starts), np.int32)      # by place: where its group starts
    open_ = np.arange(len(starts), dtype=np.int32)  # places whose group has several members
    for at in range(0, depth, STEP):
        if not len(open_):
            break
        key = _keys(data, starts[order[open_]], at, min(STEP, depth - at))
        inner = np.lexsort((key, group[open_]))
        order[open_] = order[open_[inner]]
        key = key[inner]
        new = np.ones(len(open_), bool)          # group[open_] is sorted, places stay with their group
        new[1:] = (group[open_[1:]] != group[open_[:-1]]) | (key[1:] != key[:-1])
        head = np.flatnonzero(new)
        size = np.diff(np.append(head, len(open_)))
        group[open_] = np.repeat(open_[head], size)
        open_ = open_[np.repeat(size > 1, size)]
    return order, group


class BlindTrie:
    """Patricia trie over equally long strings; a node keeps only depth and branching bytes.

    A search skips the bytes that the path leaves out, one comparison with the
    leaf it ends at tells how far the string really agrees, and the string is
    hung in at that depth.
    """

    __slots__ = ("root", "depth")

    def __init__(self, depth: int):
        self.root: list | None = None            # leaf: [None, string, members]
        self.depth = depth                       # inner node: [depth, {byte: child}]

    def insert(self, string: bytes, member: int) -> None:
        node = self.root
        if node is None:
            self.root = [None, string, [member]]
            return
        while node[0] is not None:               # blind descent
            child = node[1].get(string[node[0]])
            node = child if child is not None else next(iter(node[1].values()))
        other = node[1]
        if other == string:
            node[2].append(member)
            return
        lcp = next(j for j in range(self.depth) if other[j] != string[j])
        parent, node = None, self.root           # hang in at the true depth
        while node[0] is not None and node[0] < lcp:
            parent, node = node, node[1][string[node[0]]]
        leaf = [None, string, [member]]
        if node[0] == lcp:
            node[1][string[lcp]] = leaf
            return
        inner = [lcp, {other[lcp]: node, string[lcp]: leaf}]
        if parent is None:
            self.root = inner
        else:
            parent[1][string[parent[0]]] = inner

    def leaves(self):
        """Member lists in the order of their strings."""
        stack = [self.root] if self.root else []
        while stack:
            node = stack.pop()
            if node[0] is None:
                yield node[2]
            else:
                stack += [node[1][b] for b in sorted(node[1], reverse=True)]


def deep_shallow(data: np.ndarray, starts: np.ndarray, depth: int,
                 shallow: int) -> tuple[np.ndarray, np.ndarray]:
    """Suffix order up to ``depth`` bytes: (order, class of each place, equal iff equal strings).

    Multikey quicksort up to ``shallow`` bytes, then a blind trie for each
    group that is still tied.  ``data`` must reach ``depth`` bytes beyond
    every start.
    """
    shallow = min(shallow, depth)
    order, group = multikey(data, starts, shallow)
    if shallow == depth or not len(order):
        return order, group
    head = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]]))
    size = np.diff(np.append(head, len(group)))
    raw = data.tobytes()
    for at, n in zip(head[size > 1].tolist(), size[size > 1].tolist()):
        trie = BlindTrie(depth - shallow)
        members = order[at:at + n].tolist()
        for m in members:
            start = int(starts[m])
            trie.insert(raw[start + shallow:start + depth], m)
        place = at
        for leaf in trie.leaves():
            stop = place + len(leaf)
            order[place:stop], group[place:stop] = leaf, place
            place = stop
    return order, group
