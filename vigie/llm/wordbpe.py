"""Batch encoding with a word-splitting BPE tokenizer file, by way of distinct words.

The tokenizer never merges across white space, so a text is cut there into chunks; equal chunks have equal ids, and a
batch is an array of chunk codes plus one id list per distinct chunk. New chunks are cut into the tokenizer's words, and
new words are merged many at once. The fast cut handles texts in Latin-1 (one byte a character): there lower-casing is
a byte table, nothing is composed, and the word pattern is a byte pattern. Every other text, and one that spells a
special token, is encoded whole by the library, so results equal the library's for every text.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable
from itertools import islice

import numpy as np

from vigie.llm.merges import Merges

#: The word pattern of ``word_bpe_49k.json`` spelled out for lower-cased Latin-1 bytes.
LETTERS = rb"a-z\xaa\xb5\xba\xdf-\xf6\xf8-\xff"
DIGITS = rb"0-9\xb2\xb3\xb9\xbc-\xbe"
SPACES = rb"\x09-\x0d\x20\x85\xa0"
WORD = re.compile(rb"'s|'t|'re|'ve|'m|'ll|'d|[" + LETTERS + rb"]+|[" + DIGITS + rb"]|[^" + SPACES + LETTERS + DIGITS + rb"]+")
#: Lower-cases, and makes the two spaces beyond ASCII plain ones.
LOWER = bytes(32 if c in (0x85, 0xA0) else c + 32 if 65 <= c <= 90 or 192 <= c <= 222 and c != 215 else c for c in range(256))


class Codes(dict):
    """key -> code, numbering new keys."""

    def __missing__(self, key: bytes) -> int:
        code = self[key] = len(self)
        return code


class WordEncoder:
    """``lookup(words) -> id lists, None where unknown`` is asked before the merges are."""

    def __init__(self, path: str, lookup: Callable | None = None, limit: int = 300_000):
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.whole = Tokenizer.from_file(path)
        self.whole.no_truncation()
        self.whole.no_padding()
        self.special = [t["content"] for t in spec.get("added_tokens", [])]
        self.merges = Merges(path)
        self.lookup, self.limit = lookup, limit
        self._clear()

    def _clear(self) -> None:
        self.codes = Codes()
        self.ids = np.zeros(1 << 16, np.int32)
        self.starts = np.zeros(1, np.int64)  # chunk code -> where its ids start; one more at the end

    def chunks(self, text: str) -> list[bytes] | None:
        """The lower-cased stretches between white space, or None if the library has to cut the text."""
        try:
            data = text.encode("latin-1")
        except UnicodeEncodeError:
            return None
        if b"<|" in data and any(s in text for s in self.special):
            return None
        return data.translate(LOWER).split()

    def word_ids(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids end to end and their number for distinct words (lower-cased Latin-1 bytes)."""
        lists = self.lookup(words) if self.lookup else [None] * len(words)
        unseen = [i for i, x in enumerate(lists) if x is None]
        ids, lens = self.merges.encode([words[i].decode("latin-1").encode() for i in unseen])
        if len(unseen) == len(words):
            return ids, lens
        ends = np.cumsum(lens)
        for i, lo, hi in zip(unseen, ends - lens, ends):
            lists[i] = ids[lo:hi]
        return np.concatenate([np.asarray(x, np.int32) for x in lists]), np.fromiter(map(len, lists), np.int64, len(lists))

    def _learn(self, new: list[bytes]) -> None:
        """Id lists for new chunks."""
        code = Codes()
        found = [[code[w] for w in WORD.findall(c)] for c in new]
        ids, lens = self.word_ids(list(code))
        n_words = np.fromiter(map(len, found), np.int64, len(found))
        words = np.fromiter((w for x in found for w in x), np.int64, int(n_words.sum()))
        flat = _runs(ids, np.cumsum(lens) - lens, lens, words)
        per_chunk = np.add.reduceat(lens[words], np.cumsum(n_words) - n_words)
        starts = self.starts[-1] + np.cumsum(per_chunk)
        if starts[-1] > len(self.ids):
            self.ids = np.concatenate([self.ids, np.zeros(max(len(self.ids), int(starts[-1])), np.int32)])
        self.ids[self.starts[-1] : starts[-1]] = flat
        self.starts = np.concatenate([self.starts, starts])

    def batch(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, dict[int, list[int]], list[bytes]]:
        """Chunk codes of all texts, where each text's codes end, ids of the texts the library cut, and the new chunks.

        New chunks have the highest codes; if as many as there are codes are new, all earlier codes were forgotten.
        """
        if len(self.codes) > self.limit:
            self._clear()
        known = len(self.codes)
        code, flat, sizes, whole = self.codes.__getitem__, [], [], {}
        for i, t in enumerate(texts):
            chunks = self.chunks(t or "")
            if chunks is None:
                whole[i] = self.whole.encode(t, add_special_tokens=False).ids
                chunks = []
            flat.append(np.fromiter(map(code, chunks), np.int32, len(chunks)))
            sizes.append(len(chunks))
        new = list(islice(self.codes, known, None))
        if new:
            self._learn(new)
        return np.concatenate(flat) if flat else np.zeros(0, np.int32), np.cumsum(sizes), whole, new

    def expand(self, codes: np.ndarray) -> np.ndarray:
        """The ids of a run of chunk codes."""
        return _runs(self.ids, self.starts[:-1], np.diff(self.starts), codes)


def _runs(values: np.ndarray, starts: np.ndarray, lens: np.ndarray, picks: np.ndarray) -> np.ndarray:
    """values[starts[p] : starts[p] + lens[p]] for each pick, end to end."""
    n = lens[picks]
    ends = np.cumsum(n)
    total = int(ends[-1]) if len(ends) else 0
    return values[np.repeat(starts[picks] - (ends - n), n) + np.arange(total)]
