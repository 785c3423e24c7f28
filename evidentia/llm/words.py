"""Pre-tokenisation and exact merges of the word-end BPE vocabulary, for use inside tasks."""

from __future__ import annotations

import heapq
import json
import re
import sys
import unicodedata
from functools import cached_property, lru_cache

import numpy as np

#: White space of the tokenizer's regular expressions (the Unicode White_Space property).
SPACES = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"


@lru_cache(maxsize=1)
def _classes() -> tuple[str, ...]:
    """Character-class bodies from Python's Unicode tables: letters, numbers, both within the BMP, unassigned."""
    runs: dict[str, list[list[int]]] = {"L": [], "N": [], "Cn": []}
    for point in range(sys.maxunicode + 1):
        kind = unicodedata.category(chr(point))
        kind = kind if kind == "Cn" else kind[0]
        if kind in runs:
            if runs[kind] and runs[kind][-1][1] == point - 1:
                runs[kind][-1][1] = point
            else:
                runs[kind].append([point, point])

    def body(limit: int, kind: str) -> str:
        return "".join(f"\\U{a:08x}-\\U{min(b, limit):08x}" for a, b in runs[kind] if a <= limit)

    top = sys.maxunicode
    return body(top, "L"), body(top, "N"), body(0xFFFF, "L"), body(0xFFFF, "N"), body(top, "Cn"), body(0xFFFF, "Cn")


@lru_cache(maxsize=2)
def _pattern(wide: bool) -> re.Pattern:
    """The vocabulary's split; a line feed, which parts chunks that are split together, is a piece of its own."""
    letters, numbers = _classes()[:2] if wide else _classes()[2:4]
    return re.compile(f"[{letters}]+|\n|'(?:[stmd]|re|ve|ll)|[{numbers}]|[^{SPACES}{letters}{numbers}]+")


_ASTRAL = re.compile("[\U00010000-\U0010ffff]")


def split_words(text: str) -> list[str]:
    """NFC, lower case by single characters, then the vocabulary's split; white space but line feeds is dropped."""
    if not text.isascii():
        text = unicodedata.normalize("NFC", text)
        if "Σ" in text:
            text = text.replace("Σ", "σ")  # a final sigma is not told apart
        return _pattern(_ASTRAL.search(text) is not None).findall(text.lower())
    return _pattern(False).findall(text.lower())


@lru_cache(maxsize=2)
def _unassigned(wide: bool) -> re.Pattern:
    """Code points that Python's tables lack; a newer library may class them as letters."""
    return re.compile(f"[{_classes()[4 if wide else 5]}]")


_SPACE_RUN = re.compile(f"[{SPACES}]+")


def chunks(text: str) -> list[str]:
    """Runs between white space. No word, special string or composition crosses white space, so a text's ids are its chunks' ids in order."""
    if "\x1c" in text or "\x1d" in text or "\x1e" in text or "\x1f" in text:  # space to Python alone
        return [c for c in _SPACE_RUN.split(text) if c]
    return text.split()


@lru_cache(maxsize=1)
def byte_chars() -> list[str]:
    """The printable stand-in of each byte: printable Latin-1 bytes stay, the rest follow from U+0100."""
    keep = [*range(33, 127), *range(161, 173), *range(174, 256)]
    table, nxt = {b: chr(b) for b in keep}, 256
    for b in range(256):
        if b not in table:
            table[b] = chr(nxt)
            nxt += 1
    return [table[b] for b in range(256)]


@lru_cache(maxsize=1)
def _char_bytes() -> dict[str, int]:
    return {c: b for b, c in enumerate(byte_chars())}


@lru_cache(maxsize=2)
def vocabulary(path: str) -> WordVocabulary:
    """The tokenizer file's vocabulary, read once in each worker process."""
    return WordVocabulary(path)


class WordVocabulary:
    """Ids, merges and special strings read from a tokenizer file."""

    def __init__(self, path: str):
        self.path = path
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        ids: dict[str, int] = model["vocab"]
        self.suffix = model["end_of_word_suffix"] or ""
        pairs = [p if isinstance(p, list) else p.split(" ") for p in model["merges"]]
        self.ranks = {(ids[a], ids[b]): rank for rank, (a, b) in enumerate(pairs)}
        self.made = [ids[a + b] for a, b in pairs]
        chars = byte_chars()
        self.inner = [ids[c] for c in chars]
        self.final = [ids[c + self.suffix] for c in chars]
        self.tokens = [""] * (max(max(ids.values()), *(t["id"] for t in spec["added_tokens"])) + 1)
        for token, i in ids.items():
            self.tokens[i] = token
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        for content, i in self.special.items():
            self.tokens[i] = content
        self._angled = all("<|" in s for s in self.special)  # one test then rules out all of them
        self._split = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")")

    def pieces(self, text: str) -> list[str]:
        """Words of a text in order; a special string is a piece of its own, found before normalising."""
        if "<|" not in text if self._angled else not any(s in text for s in self.special):
            return self._words(text)
        out: list[str] = []
        for part in self._split.split(text):
            out.extend([part] if part in self.special else self._words(part))
        return out

    def pieces_together(self, chunks_: list[str]) -> list[str]:
        """The pieces of many chunks in order, with a line feed before each chunk's own; nothing crosses a line feed."""
        text = "\n".join(["", *chunks_])
        odd = "<|" in text if self._angled else any(s in text for s in self.special)
        if not odd and (text.isascii() or not (_ASTRAL.search(text) or _unassigned(False).search(text))):
            return split_words(text)
        if len(chunks_) < 64:
            return [p for c in chunks_ for p in ("\n", *self.pieces(c))]
        size = -(-len(chunks_) // 16)  # the odd chunks are few
        return [p for at in range(0, len(chunks_), size) for p in self.pieces_together(chunks_[at : at + size])]

    def _words(self, text: str) -> list[str]:
        if text.isascii() or not _unassigned(_ASTRAL.search(text) is not None).search(text):
            words = split_words(text)
            return [w for w in words if w != "\n"] if "\n" in text else words
        parts = self.library.pre_tokenizer.pre_tokenize_str(self.library.normalizer.normalize_str(text))
        return [bytes(map(_char_bytes().__getitem__, part)).decode("utf-8") for part, _ in parts]

    @cached_property
    def library(self):
        from tokenizers import Tokenizer

        return Tokenizer.from_file(self.path)

    def merge(self, word: str) -> list[int]:
        """Exact merges of one word: lowest rank first, leftmost first."""
        raw = word.encode("utf-8")
        ids = [self.inner[b] for b in raw[:-1]] + [self.final[raw[-1]]]
        return self._merge_short(ids) if len(ids) <= 32 else self._merge_long(ids)

    def merge_many(self, words: list[str]) -> list[bytes]:
        """Exact merges of many words side by side, as little-endian unsigned 32-bit ids.

        Words of one byte length form a matrix; every step merges each word's lowest-ranked, leftmost pair.
        """
        out: list[bytes] = [b""] * len(words)
        raw = [w.encode("utf-8") for w in words]
        groups: dict[int, list[int]] = {}
        for k, r in enumerate(raw):
            if len(r) > 48:
                out[k] = np.array(self.merge(words[k]), dtype="<u4").tobytes()
            elif r:
                groups.setdefault(len(r), []).append(k)
        inner, final, _ = self._arrays
        for length, members in groups.items():
            codes = np.frombuffer(b"".join([raw[k] for k in members]), dtype=np.uint8).reshape(-1, length)
            ids = inner[codes.T]
            ids[-1] = final[codes[:, -1]]
            sizes = np.full(len(members), length)
            if length > 1:
                self._merge_columns(ids, sizes)
            kept = np.arange(length) < sizes[:, None]
            flat, ends = ids.T[kept].astype("<u4").tobytes(), np.cumsum(sizes) * 4
            for k, a, b in zip(members, (ends - 4 * sizes).tolist(), ends.tolist()):
                out[k] = flat[a:b]
        return out

    def _rank_many(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        keys, ranks = self._pair_table
        wanted = left * len(self.tokens) + right
        at = np.searchsorted(keys, wanted)
        at[at == len(keys)] = 0
        return np.where(keys[at] == wanted, ranks[at], len(self.made))

    @cached_property
    def _arrays(self) -> tuple[np.ndarray, ...]:
        return tuple(np.array(x, dtype=np.int64) for x in (self.inner, self.final, self.made))

    @cached_property
    def _pair_table(self) -> tuple[np.ndarray, np.ndarray]:
        keys = np.array([a * len(self.tokens) + b for a, b in self.ranks], dtype=np.int64)
        order = np.argsort(keys)
        return keys[order], np.array(list(self.ranks.values()), dtype=np.int64)[order]

    def _merge_columns(self, ids: np.ndarray, sizes: np.ndarray) -> None:
        """Merge words that stand side by side, one per column, in place; sizes become the ids left."""
        none, made = len(self.made), self._arrays[2]
        words, own, ranks = np.arange(ids.shape[1]), ids.copy(), self._rank_many(ids[:-1], ids[1:])
        while True:
            at = ranks.argmin(axis=0)
            best = ranks[at, np.arange(len(words))]
            live = best < none
            if not live.all():
                ids[: len(own), words[~live]] = own[:, ~live]
                words, own, ranks, at, best = words[live], own[:, live], ranks[:, live], at[live], best[live]
            if not len(words):
                return
            here = np.arange(len(words))
            own[at, here] = made[best]
            sizes[words] -= 1
            for k in range(1, len(own) - 1):
                own[k] = np.where(k > at, own[k + 1], own[k])
            own = own[:-1]
            if len(own) == 1:
                ids[:1, words] = own
                return
            for k in range(len(ranks) - 1):
                ranks[k] = np.where(k >= at, ranks[k + 1], ranks[k])
            ranks = ranks[:-1]
            # a merge changes the pairs on both sides of the new id
            has = np.flatnonzero(at > 0)
            ranks[at[has] - 1, has] = self._rank_many(own[at[has] - 1, has], own[at[has], has])
            has = np.flatnonzero(at < len(ranks))
            ranks[at[has], has] = self._rank_many(own[at[has], has], own[at[has] + 1, has])

    def _merge_short(self, ids: list[int]) -> list[int]:
        rank_of, made, none = self.ranks.get, self.made, len(self.made)
        ranks = [rank_of(p, none) for p in zip(ids, ids[1:])]
        while ranks:
            best = min(ranks)
            if best == none:
                break
            at = ranks.index(best)
            ids[at : at + 2] = [made[best]]
            del ranks[at]
            if at:
                ranks[at - 1] = rank_of((ids[at - 1], ids[at]), none)
            if at < len(ranks):
                ranks[at] = rank_of((ids[at], ids[at + 1]), none)
        return ids

    def _merge_long(self, ids: list[int]) -> list[int]:
        n, rank_of = len(ids), self.ranks.get
        nxt, prv, alive = list(range(1, n + 1)), list(range(-1, n - 1)), [True] * n
        heap = [(r, i, ids[i], ids[i + 1]) for i in range(n - 1) if (r := rank_of((ids[i], ids[i + 1]))) is not None]
        heapq.heapify(heap)
        while heap:
            rank, i, a, b = heapq.heappop(heap)
            j = nxt[i]
            if not alive[i] or j >= n or ids[i] != a or ids[j] != b:
                continue  # one side has been merged away meanwhile
            ids[i], alive[j], nxt[i] = self.made[rank], False, nxt[j]
            if nxt[j] < n:
                prv[nxt[j]] = i
            for left, right in ((prv[i], i), (i, nxt[i])):
                if left >= 0 and right < n and (r := rank_of((ids[left], ids[right]))) is not None:
                    heapq.heappush(heap, (r, left, ids[left], ids[right]))
        return [x for x, live in zip(ids, alive) if live]
