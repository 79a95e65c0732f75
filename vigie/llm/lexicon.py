"""A word lexicon as a minimal acyclic transducer, and exact encoding and decoding with it.

``compile_lexicon`` turns a sorted word list into the smallest acyclic automaton that accepts it (equal suffixes share
states). Every arc carries a number; the sum along a word's path is the word's place in the list, by which its ids are
found. Arcs lie in one sorted table, so a batch of words walks the automaton together, one byte a step. The tables are
written to one file, which each Python worker maps into memory.

The lexicon is compiled from the ``LEXICON_WORDS`` most frequent words of the whole corpus, which bounds its size. Words
outside it are merged exactly, so results do not depend on what it holds.
"""

from __future__ import annotations

import hashlib
import os
import tempfile
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vigie.llm.common import stored
from vigie.llm.wordbpe import WORD, WordEncoder

LEXICON_WORDS = 1 << 16
FINAL = np.int64(256)  # the arc of a word's end


# ---- automaton ------------------------------------------------------------------------------------------------------


def compile_lexicon(words: list[bytes], ids: list[list[int]]) -> dict[str, np.ndarray]:
    """Tables of the automaton for ``words`` (distinct, sorted, none empty) with their ``ids``."""
    register: dict[tuple, int] = {}  # a state's arcs -> its number
    states: list[tuple] = []
    path: list[dict[int, int | None]] = [{}]  # states along the last word, not registered yet

    def settle(depth: int) -> None:
        while len(path) > depth + 1:
            arcs = tuple(path.pop().items())
            number = register.get(arcs)
            if number is None:
                number = register[arcs] = len(states)
                states.append(arcs)
            parent = path[-1]
            parent[next(reversed(parent))] = number

    last = b""
    for word in words:
        common = 0
        while common < min(len(word), len(last)) and word[common] == last[common]:
            common += 1
        settle(common)
        for byte in word[common:]:
            path[-1][byte] = None
            path.append({})
        path[-1][int(FINAL)] = -1
        last = word
    settle(0)
    root = len(states)
    states.append(tuple(path[0].items()))
    size = np.zeros(len(states), np.int64)  # words below a state; children have smaller numbers
    key, target, add = [], [], []
    for s, arcs in enumerate(states):
        # in list order a word ends before its extensions
        before = 0
        for byte, to in sorted(arcs, key=lambda a: -1 if a[0] == FINAL else a[0]):
            key.append(s * 257 + byte)
            target.append(to)
            add.append(before)
            before += 1 if to == -1 else size[to]
        size[s] = before
    order = np.argsort(np.array(key, np.int64), kind="stable")
    lens = np.fromiter(map(len, ids), np.int64, len(ids))
    return {
        "key": np.array(key, np.int64)[order],
        "target": np.array(target, np.int64)[order],
        "add": np.array(add, np.int64)[order],
        "ends": np.cumsum(lens),
        "ids": np.array([i for x in ids for i in x], np.int64),
        "root": np.array([root], np.int64),
    }


def pack(tables: dict[str, np.ndarray]) -> bytes:
    """All tables in one buffer of 64-bit numbers: their lengths, then the tables."""
    return np.concatenate([np.array([len(tables[k]) for k in sorted(tables)], np.int64), *[tables[k] for k in sorted(tables)]]).tobytes()


class Lexicon:
    """Read-only view on packed tables."""

    NAMES = sorted(["key", "target", "add", "ends", "ids", "root"])

    def __init__(self, numbers: np.ndarray):
        at = len(self.NAMES)
        for name, n in zip(self.NAMES, numbers[:at].tolist()):
            setattr(self, name, numbers[at : at + n])
            at += n

    @classmethod
    def mapped(cls, data: bytes) -> Lexicon:
        """The tables as a file mapped into memory; its name is removed at once, so nothing stays behind."""
        fd, path = tempfile.mkstemp(prefix="lexicon-")
        with os.fdopen(fd, "wb") as f:
            f.write(data)
        numbers = np.memmap(path, np.int64, "r")
        os.unlink(path)
        return cls(numbers)

    def _step(self, state: np.ndarray, byte: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        want = state * 257 + byte
        at = np.minimum(np.searchsorted(self.key, want), len(self.key) - 1)
        hit = (self.key[at] == want) & (state >= 0)
        return np.where(hit, self.target[at], -2), np.where(hit, self.add[at], 0)

    def find(self, words: list[bytes]) -> np.ndarray:
        """The place of every word in the list, -1 for one that is not in it."""
        out = np.full(len(words), -1, np.int64)
        if not words or not len(self.key):
            return out
        lens = np.fromiter(map(len, words), np.int64, len(words))
        data = np.frombuffer(b"".join(words) + b"\0", np.uint8)
        start = np.cumsum(lens) - lens
        who = np.arange(len(words))
        state, total = np.full(len(words), self.root[0]), np.zeros(len(words), np.int64)
        for j in range(int(lens.max()) + 1):
            ended = lens[who] == j
            if ended.any():
                stop, add = self._step(state[ended], np.full(int(ended.sum()), FINAL))
                out[who[ended]] = np.where(stop == -1, total[ended] + add, -1)
            who, state, total = who[~ended], state[~ended], total[~ended]
            state, add = self._step(state, data[start[who] + j].astype(np.int64))
            alive = state >= 0
            who, state, total = who[alive], state[alive], (total + add)[alive]
            if not len(who):
                break
        return out

    def lookup(self, words: list[bytes]) -> list:
        at = self.find(words)
        ends = np.concatenate([[0], self.ends])
        return [self.ids[a:b] if p >= 0 else None for p, a, b in zip(at, ends[np.maximum(at, 0)], ends[np.minimum(at + 1, len(ends) - 1)])]


# ---- Spark side -----------------------------------------------------------------------------------------------------


def word_counts(df: DataFrame, text: str, path: str) -> DataFrame:
    """``(word, n)`` over all texts the fast cut handles, summed in each task before the shuffle."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, chunks = WordEncoder(path), Counter()

        def flush():
            words: Counter = Counter()
            for c, n in chunks.items():
                for w in WORD.findall(c):
                    words[w] += n
            chunks.clear()
            return pa.RecordBatch.from_arrays([pa.array(list(words), pa.binary()), pa.array(list(words.values()), pa.int64())], ["word", "n"])

        for b in batches:
            for t in b.column(0):
                chunks.update(encoder.chunks(t.as_py() or "") or ())
            if len(chunks) > 500_000:
                yield flush()
        yield flush()

    return df.select(F.col(text)).mapInArrow(count, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))


def corpus_lexicon(df: DataFrame, path: str, text: str = "text", size: int = LEXICON_WORDS) -> bytes:
    """The packed automaton of the corpus's most frequent words."""
    counts = stored(word_counts(df, text, path), "words")
    # how many words occur at least 1, 2, 4, ... times says where to cut before the sort, which one task ends
    tiers = {r["tier"]: r["count"] for r in counts.groupBy(F.length(F.bin("n")).alias("tier")).count().collect()}
    tier, above = max(tiers, default=1), 0
    while tier > 1 and above + tiers.get(tier, 0) < size:
        above, tier = above + tiers.get(tier, 0), tier - 1
    top = stored(counts.where(F.col("n") >= 2 ** (tier - 1)).orderBy(F.desc("n"), "word").limit(size), "lexicon")
    words = sorted(bytes(r["word"]) for r in top.select("word").toLocalIterator())
    ids, lens = WordEncoder(path).word_ids(words)
    ends = np.cumsum(lens)
    return pack(compile_lexicon(words, [ids[a:b].tolist() for a, b in zip(ends - lens, ends)]))


def encode_decode(df: DataFrame, path: str, text: str = "text", columns: tuple[str, ...] = (), size: int = LEXICON_WORDS, digests: bool = False) -> DataFrame:
    """``columns`` plus ``_ids`` (array of int) and ``_decoded`` (string) of every text; a null text is empty.

    ``digests``: instead ``_n_tokens``, ``_ids_sha256`` (ids in decimal, one space between) and ``_decoded_sha256``.
    Decoding joins the ids' tokens with one space, as the file names no decoder.
    """
    shared = df.sparkSession.sparkContext.broadcast(corpus_lexicon(df, path, text, size))
    columns, n = tuple(columns), len(columns)
    added = [F.lit(0).cast("long").alias("_n_tokens"), F.lit("").alias("_ids_sha256"), F.lit("").alias("_decoded_sha256")] if digests else [F.array(F.lit(0)).alias("_ids"), F.lit("").alias("_decoded")]
    schema = df.select(*columns, *added).schema
    names = [f.name for f in schema.fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = WordEncoder(path, Lexicon.mapped(shared.value).lookup)
        token = [encoder.whole.id_to_token(i).encode() for i in range(encoder.whole.get_vocab_size())]
        digit = [str(i).encode() for i in range(len(token))]
        as_ids: list[bytes] = []
        as_text: list[bytes] = []
        for b in batches:
            for lo in range(0, b.num_rows, 1000):
                part = b.slice(lo, 1000)
                codes, ends, whole, new = encoder.batch(part.column(n).to_pylist())
                if len(new) == len(encoder.codes):
                    as_ids.clear(), as_text.clear()
                starts = encoder.starts[len(encoder.codes) - len(new) :]
                ids, starts = encoder.ids[starts[0] : starts[-1]].tolist(), (starts - starts[0]).tolist()
                for at, end in zip(starts, starts[1:]):
                    own = ids[at:end]
                    as_ids.append(b" ".join([digit[i] for i in own]))
                    as_text.append(b" ".join([token[i] for i in own]))
                out: list[list] = [[], [], []]
                begin = 0
                for i, end in enumerate(ends.tolist()):
                    own, begin = codes[begin:end], end
                    if digests:
                        c = own.tolist()
                        count = int((encoder.starts[own + 1] - encoder.starts[own]).sum())
                        a, d = b" ".join([as_ids[x] for x in c]), b" ".join([as_text[x] for x in c])
                        if i in whole:
                            count, a, d = len(whole[i]), b" ".join([digit[x] for x in whole[i]]), b" ".join([token[x] for x in whole[i]])
                        for col, v in zip(out, (count, hashlib.sha256(a).hexdigest(), hashlib.sha256(d).hexdigest())):
                            col.append(v)
                    else:
                        got = whole.get(i, None) if i in whole else encoder.expand(own).tolist()
                        out[0].append(got)
                        out[1].append(b" ".join([token[x] for x in got]).decode())
                cols = [part.column(k) for k in range(n)]
                extra = [pa.array(x) for x in out[: len(names) - n]] if digests else [pa.array(out[0], pa.list_(pa.int32())), pa.array(out[1], pa.string())]
                yield pa.RecordBatch.from_arrays(cols + extra, names=names)

    return df.select(*columns, F.col(text).alias("_lex_text")).mapInArrow(run, schema)
