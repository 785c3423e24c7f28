"""A minimal acyclic transducer from frequent words to their token ids, kept in one flat file."""

from __future__ import annotations

import mmap
import struct
from collections.abc import Iterable

import numpy as np

_MAGIC = b"EVLX0001"


def compile_lexicon(entries: Iterable[tuple[str, list[int]]]) -> bytes:
    """Compile (word, ids) into bytes.

    Words are added in sorted order and a node is frozen as soon as no later word can change it, so equal
    suffix languages share one node. Each edge carries the number of words that sort before those behind
    it; the sum along a path is the word's number, which indexes the id outputs.
    """
    items = sorted((word.encode("utf-8"), ids) for word, ids in dict(entries).items() if word)
    frozen: dict[tuple, int] = {}
    nodes: list[tuple[bool, list[tuple[int, int]]]] = []
    counts: list[int] = []

    def freeze(final: bool, edges: list[tuple[int, int]]) -> int:
        key = (final, tuple(edges))
        if key not in frozen:
            frozen[key] = len(nodes)
            nodes.append((final, list(edges)))
            counts.append(final + sum(counts[t] for _, t in edges))
        return frozen[key]

    path: list[list] = [[False, []]]  # open nodes along the last word: [final, frozen edges]
    last = b""

    def close(depth: int) -> None:
        while len(path) - 1 > depth:
            final, edges = path.pop()
            path[-1][1].append((last[len(path) - 1], freeze(final, edges)))

    for word, _ in items:
        common = 0
        while common < min(len(word), len(last)) and word[common] == last[common]:
            common += 1
        close(common)
        path.extend([False, []] for _ in word[common:])
        path[-1][0], last = True, word
    close(0)
    root = freeze(*path[0])

    first = np.zeros(len(nodes) + 1, dtype="<u4")
    final = np.array([f for f, _ in nodes], dtype="u1")
    labels, targets, before = [], [], []
    for k, (is_final, edges) in enumerate(nodes):
        seen = int(is_final)
        for label, target in edges:
            labels.append(label)
            targets.append(target)
            before.append(seen)
            seen += counts[target]
        first[k + 1] = len(labels)
    # one sorted key per edge, so that a step is a binary search on (node, label)
    keys = np.repeat(np.arange(len(nodes), dtype="<u8"), np.diff(first)) * 256 + np.array(labels, dtype="<u8")
    ends = np.cumsum([0, *(len(ids) for _, ids in items)]).astype("<u4")
    flat = np.array([i for _, ids in items for i in ids], dtype="<u4")
    parts = [keys.astype("<u8"), np.array(targets, dtype="<u4"), np.array(before, dtype="<u4"), ends, flat, final]
    head = struct.pack("<6I", len(keys), len(items), len(flat), len(nodes), root, 0)
    return _MAGIC + head + b"".join(p.tobytes() for p in parts)


class Lexicon:
    """Read-only view of a compiled lexicon; lookups walk many words at once."""

    def __init__(self, path: str):
        with open(path, "rb") as f:
            self._map = mmap.mmap(f.fileno(), 0, access=mmap.ACCESS_READ)
        if self._map[:8] != _MAGIC:
            raise ValueError("not a lexicon file")
        edges, words, flat, nodes, self.root, _ = struct.unpack("<6I", self._map[8:32])
        at = 32

        def take(kind: str, n: int) -> np.ndarray:
            nonlocal at
            out = np.frombuffer(self._map, dtype=kind, count=n, offset=at)
            at += out.nbytes
            return out

        self.keys, self.targets, self.before = take("<u8", edges), take("<u4", edges), take("<u4", edges)
        self.ends, self.flat, self.final = take("<u4", words + 1), take("<u4", flat), take("u1", nodes)

    def numbers(self, words: list[str]) -> np.ndarray:
        """Each word's number, or -1 where the lexicon lacks it."""
        raw = [w.encode("utf-8") for w in words]
        lengths = np.array([len(r) for r in raw], dtype=np.int64)
        out = np.full(len(raw), -1, dtype=np.int64)
        if not len(raw) or not len(self.keys):
            return out
        starts = np.concatenate(([0], np.cumsum(lengths)[:-1]))
        data = np.frombuffer(b"".join(raw) + b"\0", dtype=np.uint8)
        live = np.flatnonzero(lengths > 0)
        state, total = np.full(len(live), self.root, dtype=np.int64), np.zeros(len(live), dtype=np.int64)
        step = 0
        while len(live):
            key = state.astype(np.uint64) * np.uint64(256) + data[starts[live] + step].astype(np.uint64)
            edge = np.searchsorted(self.keys, key)
            ok = edge < len(self.keys)
            ok[ok] = self.keys[edge[ok]] == key[ok]
            live, edge, total = live[ok], edge[ok], total[ok]
            state, total = self.targets[edge].astype(np.int64), total + self.before[edge]
            step += 1
            done = lengths[live] == step
            hit = done & (self.final[state] == 1)
            out[live[hit]] = total[hit]
            live, state, total = live[~done], state[~done], total[~done]
        return out

    def ids(self, number: int) -> np.ndarray:
        return self.flat[self.ends[number] : self.ends[number + 1]]
