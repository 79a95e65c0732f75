"""Byte-pair merges for many words at once.

All words lie end to end in one symbol array. In each round every unfinished word applies its merge of lowest rank, at
its leftmost place, which is the order in which a merge list is defined; ranks are looked up for the two pairs that
changed. A word leaves the array when no pair of it has a rank.
"""

from __future__ import annotations

import json

import numpy as np

NONE = np.int32(2**31 - 1)


def _byte_symbols() -> list[str]:
    """The printable stand-in of every byte in byte-level vocabularies (a published rule)."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = [b for b in range(256) if b not in plain]
    return [chr(b) if b in plain else chr(256 + other.index(b)) for b in range(256)]


class Merges:
    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            model = json.load(f)["model"]
        vocab, suffix = model["vocab"], model.get("end_of_word_suffix") or ""
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        size = len(vocab)
        key = np.array([vocab[a] * size + vocab[b] for a, b in pairs], np.int64)
        into = np.array([vocab[a + b] for a, b in pairs], np.int32)
        order = np.argsort(key, kind="stable")
        self.into, self.size = into, size
        self._index(key[order], order.astype(np.int32))
        symbols = _byte_symbols()
        self.inner = np.array([vocab[s] for s in symbols], np.int32)
        self.final = np.array([vocab[s + suffix] for s in symbols], np.int32)
        # ranks of two bytes inside a word, and of the last two of a word
        first, second = (x.reshape(-1) for x in np.meshgrid(np.arange(256), np.arange(256), indexing="ij"))
        self.pair_inner = self._ranks(self.inner[first], self.inner[second])
        self.pair_final = self._ranks(self.inner[first], self.final[second])

    def _index(self, key: np.ndarray, rank: np.ndarray) -> None:
        """A hash table with linear probing, at most a quarter full."""
        self.bits = max(4, int(np.ceil(np.log2(4 * len(key) + 4))))
        self.slots, self.ranks = np.full(1 << self.bits, -1, np.int64), np.full(1 << self.bits, NONE)
        at, todo = self._slot(key), np.arange(len(key))
        while len(todo):
            free = self.slots[at[todo]] < 0
            _, first = np.unique(np.where(free, at[todo], -1 - todo), return_index=True)
            own = first[free[first]]
            self.slots[at[todo[own]]], self.ranks[at[todo[own]]] = key[todo[own]], rank[todo[own]]
            todo = np.delete(todo, own)
            at[todo] = (at[todo] + 1) & ((1 << self.bits) - 1)

    def _slot(self, q: np.ndarray) -> np.ndarray:
        return ((q.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def _ranks(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        q = a.astype(np.int64) * self.size + b
        at = self._slot(q)
        held = self.slots[at]
        out = np.where(held == q, self.ranks[at], NONE)
        more = np.flatnonzero((held != q) & (held >= 0))
        while len(more):
            at[more] = (at[more] + 1) & ((1 << self.bits) - 1)
            held = self.slots[at[more]]
            out[more] = np.where(held == q[more], self.ranks[at[more]], NONE)
            more = more[(held != q[more]) & (held >= 0)]
        return out

    def encode(self, words: list[bytes], at_once: int = 4096) -> tuple[np.ndarray, np.ndarray]:
        """``words`` as UTF-8 -> (ids end to end, number of ids of each word). No word is empty."""
        if not words:
            return np.zeros(0, np.int32), np.zeros(0, np.int64)
        parts = [self._encode(words[lo : lo + at_once]) for lo in range(0, len(words), at_once)]
        return np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])

    def _encode(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        n = len(words)
        lens = np.fromiter(map(len, words), np.int64, n)
        data = np.frombuffer(b"".join(words), np.uint8)
        ends = np.cumsum(lens)
        sym = self.inner[data]
        sym[ends - 1] = self.final[data[ends - 1]]
        word = np.repeat(np.arange(n), lens)
        rank = np.full(len(sym), NONE)
        two = data[:-1].astype(np.int32) * 256 + data[1:]
        rank[:-1] = self.pair_inner[two]
        last = ends[lens > 1] - 2
        rank[last] = self.pair_final[two[last]]
        rank[ends - 1] = NONE
        starts = ends - lens
        done_sym, done_word = [], []
        while len(sym):
            low = np.minimum.reduceat(rank, starts)
            over = low == NONE
            n_over = int(over.sum())
            if 4 * n_over >= len(over):  # finished words leave together
                out = np.repeat(over, lens)
                done_sym.append(sym[out])
                done_word.append(word[out])
                stay = ~out
                sym, word, rank = sym[stay], word[stay], rank[stay]
                low, lens = low[~over], lens[~over]
                if not len(sym):
                    break
                starts = np.cumsum(lens) - lens
                n_over = 0
            if n_over:
                low[over] = -1  # matches no rank
            hits = np.flatnonzero(rank == np.repeat(low, lens))
            first = np.ones(len(hits), bool)
            first[1:] = word[hits[1:]] != word[hits[:-1]]
            at = hits[first]  # one a word, in the order of the words
            own = np.flatnonzero(low >= 0) if n_over else slice(None)
            sym[at] = self.into[low[own]]
            stay = np.ones(len(sym), bool)
            stay[at + 1] = False
            at = at - np.arange(len(at))  # places after the removals
            sym, word, rank = sym[stay], word[stay], rank[stay]
            lens = lens.copy()
            lens[own] -= 1
            starts = np.cumsum(lens) - lens
            begin, last = starts[own], (starts + lens - 1)[own]
            right = np.minimum(at + 1, len(sym) - 1)
            rank[at] = np.where(at < last, self._ranks(sym[at], sym[right]), NONE)
            left = np.maximum(at - 1, 0)
            rank[left] = np.where(at > begin, self._ranks(sym[left], sym[at]), rank[left])
        sym, word = np.concatenate(done_sym), np.concatenate(done_word)
        order = np.argsort(word, kind="stable")
        return sym[order], np.bincount(word, minlength=n)
