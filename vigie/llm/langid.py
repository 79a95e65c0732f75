"""Language identification by prediction by partial matching (PPM).

For every language a byte context tree of variable order (up to ``ORDER``) is learned from labelled documents. Statistics
are counted once, over all training documents, and then frozen. A byte seen in a context has probability
``count / (total + distinct)``; the escape probability is ``distinct / (total + distinct)``, and the bytes not seen share it
in proportion to their probability in the next shorter context, without those seen (exclusion). So the probabilities of a
context add up to one and code lengths are exact. Below order 0 stands the uniform code over 256 bytes.

The trees hold every context of every order. The top order is kept as the grams that occur (a code length per language) and
the contexts that occur (an escape length per language), so the model, which is the only thing sent to every task, grows with
the distinct grams of the training documents and not with their number. The driver builds it in one piece.

A document's language is the one with the shortest code, the first by name among equals. ``score`` is its share of the posterior under equal priors.
Null text or text without a letter (Unicode category L): ``und`` with score 0. An empty training set predicts ``und`` for every row. Null
``lang`` rows are not learned from. Rows are scored one by one, so repeated rows get equal results. Extra columns are ignored
unless named in ``columns``; one that has the name of an appended column is replaced by it.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vigie.llm.common import stored

ORDER = 3
#: Bytes counted or coded at once in a task, and distinct grams a task holds before it hands them on.
CHUNK = 1 << 20
MOST_HELD = 1 << 20
#: By Unicode category: superscripts, fractions and Roman numeral signs are numbers.
LETTER = regex.compile(r"\p{L}")


# ---- counting -------------------------------------------------------------------------------------------------------


def _grams(data: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """(ORDER + 1)-grams as uint32, the predicted byte lowest; before a text stand ORDER zero bytes."""
    wide = data.astype(np.uint32)
    out = wide.copy()
    for k in range(1, ORDER + 1):
        shifted = np.zeros_like(wide)
        shifted[k:] = wide[:-k]
        for j in range(k):  # the first bytes of a text do not see the text before it
            at = starts + j
            shifted[at[at < len(wide)]] = 0
        out |= shifted << np.uint32(8 * k)
    return out


def _joined(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All bytes, where each non-empty text starts, and the lengths."""
    lens = np.fromiter(map(len, texts), np.int64, len(texts))
    starts = np.cumsum(lens) - lens
    return np.frombuffer(b"".join(texts), np.uint8), starts, lens


def _merged(one: tuple[np.ndarray, np.ndarray], two: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Sums of two sorted (gram, count) tables."""
    grams, where = np.unique(np.concatenate([one[0], two[0]]), return_inverse=True)
    return grams, np.bincount(where, weights=np.concatenate([one[1], two[1]])).astype(np.int64)


def gram_counts(train: DataFrame, text: str = "text", lang: str = "lang") -> DataFrame:
    """``(lang, gram, n)`` over all rows of ``train`` whose ``lang`` and ``text`` are not null."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list[bytes]] = {}
        sums: dict[str, tuple[np.ndarray, np.ndarray]] = {}
        size = 0

        def add():
            for name, texts in held.items():
                data, starts, lens = _joined(texts)
                if len(data):
                    new = np.unique(_grams(data, starts[lens > 0]), return_counts=True)
                    sums[name] = _merged(sums[name], new) if name in sums else new
            held.clear()

        def flush():
            for name, (g, c) in sums.items():
                yield pa.RecordBatch.from_arrays([pa.array([name] * len(g)), pa.array(g.astype(np.int64)), pa.array(c.astype(np.int64))], ["lang", "gram", "n"])
            sums.clear()

        for b in batches:
            for name, t in zip(b.column(0), b.column(1)):
                t = t.as_py()
                held.setdefault(name.as_py(), []).append(t)
                size += len(t)
                if size >= CHUNK:
                    add()
                    size = 0
                    if sum(len(g) for g, _ in sums.values()) > MOST_HELD:
                        yield from flush()
        add()
        yield from flush()

    rows = train.where(F.col(lang).isNotNull() & F.col(text).isNotNull()).select(F.col(lang).alias("lang"), F.col(text).cast("binary").alias("text"))
    return rows.mapInArrow(count, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))


# ---- model ----------------------------------------------------------------------------------------------------------


@dataclass
class Model:
    """``bits[row, byte, lang]`` are the code lengths below the top order, ``node[c2, c1]`` the row of a context.

    ``grams`` (sorted, as ``((c3 * width + c2) * width + c1) * width + byte``) and ``contexts`` (sorted, without the byte) are
    those seen in any language. ``seen[gram, lang]`` is the code length in the top order; a byte not seen after a context costs
    ``escape[context, lang]`` more than below (0 where the language does not know the context).
    """

    langs: list[str]
    alphabet: np.ndarray  # byte -> index; bytes never seen share the last index
    node: np.ndarray
    bits: np.ndarray
    width: int
    grams: np.ndarray
    seen: np.ndarray
    contexts: np.ndarray
    escape: np.ndarray

    def lengths(self, above: np.ndarray, sym: np.ndarray) -> np.ndarray:
        """Bits of each ``sym`` after its context ``above`` under every language."""
        row = self.node[above % (self.width * self.width)].astype(np.int64)
        out = self.bits.reshape(-1, len(self.langs))[row * self.width + sym]
        if not len(self.grams):
            return out
        gram = above * self.width + sym
        at = np.minimum(np.searchsorted(self.grams, gram), len(self.grams) - 1)
        hit = self.grams[at] == gram
        out[hit] = self.seen[at[hit]]
        miss = np.flatnonzero(~hit)
        at = np.minimum(np.searchsorted(self.contexts, above[miss]), len(self.contexts) - 1)
        known = self.contexts[at] == above[miss]
        out[miss[known]] += self.escape[at[known]]
        return out


def fit(counts: DataFrame, max_contexts: int | None = None) -> Model:
    """The frozen model from ``(lang, gram, n)``; ``max_contexts`` holds only so many contexts of the top order (None: all).

    The driver gets a row per distinct gram of a language, and the sums by the shorter context.
    """
    counts = stored(counts, "grams")
    held = counts
    if max_contexts is not None:
        ctx = F.shiftright("gram", 8)
        top = counts.groupBy(ctx.alias("ctx")).agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "ctx").limit(max_contexts)
        top = stored(top.select("ctx"), "contexts")
        held = counts.withColumn("ctx", ctx).join(F.broadcast(top), "ctx")
    held = held.select("lang", "gram", "n").toPandas()
    lower = counts.groupBy("lang", F.col("gram").bitwiseAND(0xFFFFFF).alias("gram")).agg(F.sum("n").alias("n")).toPandas()
    return _build(held, lower)


def _build(held, lower) -> Model:
    langs = sorted(lower["lang"].unique())
    if not langs:
        return Model([], np.zeros(256, np.int64), np.zeros(0, np.int32), np.zeros((0, 0, 0), np.float32), 0, np.zeros(0, np.int64), np.zeros((0, 0), np.float32), np.zeros(0, np.int64), np.zeros((0, 0), np.float32))
    g = lower["gram"].to_numpy()
    seen = np.unique(np.concatenate([g & 255, g >> 8 & 255, g >> 16 & 255, [0]]))
    width = len(seen) + 1
    alphabet = np.full(256, width - 1, np.int64)
    alphabet[seen] = np.arange(len(seen))
    unseen = 256 - len(seen)  # byte values behind the last index
    code = {name: i for i, name in enumerate(langs)}

    def cols(frame):
        gram, n = frame["gram"].to_numpy().astype(np.int64), frame["n"].to_numpy().astype(float)
        return [alphabet[gram >> (8 * k) & 255] for k in range(ORDER + 1)], n, frame["lang"].map(code).to_numpy()

    b, n, lg = cols(lower)
    n_lang = len(langs)
    share = np.full(width, 1 / 256)
    share[-1] = unseen / 256

    def blend(counts: np.ndarray, parent: np.ndarray) -> np.ndarray:
        """counts[..., byte]; parent probabilities, broadcastable -> probabilities with escape and exclusion."""
        total, hit = counts.sum(-1, keepdims=True), counts > 0
        distinct = hit.sum(-1, keepdims=True)
        rest = 1 - np.where(hit, parent, 0).sum(-1, keepdims=True)
        full = rest <= 1e-12  # every byte was seen: nothing to escape to
        denom = np.maximum(total + np.where(full, 0, distinct), 1e-300)
        escape = np.where(full, 0, distinct / denom / np.maximum(rest, 1e-300))
        return np.where(total > 0, np.where(hit, counts / denom, escape * parent), parent)

    c0 = np.zeros((n_lang, width))
    np.add.at(c0, (lg, b[0]), n)
    p0 = blend(c0, share)
    c1 = np.zeros((n_lang, width, width))
    np.add.at(c1, (lg, b[1], b[0]), n)
    p1 = blend(c1, p0[:, None])
    # order 2: a row for every pair seen in any language; other pairs use order 1
    pairs, where = np.unique(b[2] * width + b[1], return_inverse=True)
    c2 = np.zeros((n_lang, len(pairs), width), np.float64)
    np.add.at(c2, (lg, where, b[0]), n)
    p2 = blend(c2, p1[:, pairs % width])
    row2 = np.full(width * width, -1, np.int64)
    row2[pairs] = np.arange(len(pairs))
    # the top order: only what occurs, a gram in one language needs its length in all of them
    h, m, hl = cols(held)
    gram, gram_at = np.unique(((h[3] * width + h[2]) * width + h[1]) * width + h[0], return_inverse=True)
    context, context_at = np.unique(gram // width, return_inverse=True)
    c3 = np.zeros((len(gram), n_lang))
    np.add.at(c3, (gram_at, hl), m)
    below = p2[:, row2[gram // width % (width * width)], gram % width].T
    hit = c3 > 0
    total, distinct, used = (np.zeros((len(context), n_lang)) for _ in range(3))
    for sums, x in ((total, c3), (distinct, hit), (used, np.where(hit, below, 0))):
        np.add.at(sums, context_at, x)
    rest = 1 - used
    full = rest <= 1e-12
    denom = np.maximum(total + np.where(full, 0, distinct), 1e-300)
    escape = np.where(total > 0, np.where(full, 0, distinct / denom / np.maximum(rest, 1e-300)), 1)
    p3 = np.where(hit, c3 / denom[context_at], escape[context_at] * below)
    last = gram % width == width - 1
    p3[last] /= max(unseen, 1)
    prob = np.concatenate([p1, p2], axis=1)  # rows: order 1, order 2
    prob[..., -1] /= max(unseen, 1)  # one of the bytes behind the last index

    def length(p: np.ndarray) -> np.ndarray:
        return -np.log2(np.maximum(p, 1e-30)).astype(np.float32)

    node = np.where(row2 >= 0, width + row2, np.arange(width * width) % width).astype(np.int32)
    return Model(langs, alphabet, node, np.ascontiguousarray(length(prob.transpose(1, 2, 0))), width, gram, length(p3), context, length(escape))


def code_lengths(model: Model, texts: list[bytes]) -> np.ndarray:
    """Bits of every text under every language, shape (texts, languages)."""
    out = np.zeros((len(texts), len(model.langs)))
    lo = 0
    while lo < len(texts):
        hi, size = lo, 0
        while hi < len(texts) and (hi == lo or size + len(texts[hi]) <= CHUNK // 4):
            size += len(texts[hi])
            hi += 1
        data, starts, lens = _joined(texts[lo:hi])
        # a text longer than a chunk is coded in pieces that see the bytes before them
        for at in range(0, max(len(data), 1), CHUNK // 4):
            begin, end = max(0, at - ORDER), min(len(data), at + CHUNK // 4)
            sym = model.alphabet[data[begin:end]]
            ctx = np.zeros((ORDER, len(sym)), np.int64)
            zero = model.alphabet[0]
            own = starts[lens > 0]
            own = own[(own >= begin - ORDER) & (own < end)] - begin
            for k in range(1, ORDER + 1):
                ctx[k - 1, k:] = sym[:-k]
                ctx[k - 1, :k] = zero
                for j in range(k):
                    p = own + j
                    ctx[k - 1, p[(p >= 0) & (p < len(sym))]] = zero
            bits = model.lengths((ctx[2] * model.width + ctx[1]) * model.width + ctx[0], sym)[at - begin :]
            inside = np.flatnonzero(lens > 0)
            inside = inside[(starts[inside] < end) & (starts[inside] + lens[inside] > at)]
            if len(inside) and len(bits):
                cuts = np.maximum(starts[inside], at) - at
                out[lo + inside] += np.add.reduceat(bits.astype(np.float64), cuts, axis=0)
        lo = hi
    return out


# ---- prediction -----------------------------------------------------------------------------------------------------


def predict(df: DataFrame, model: Model, text: str = "text", columns: tuple[str, ...] = ()) -> DataFrame:
    """``columns`` of ``df`` plus ``_lang_pred``, ``_lang_score`` and ``_lang_bits`` (bits a byte of the best code)."""
    shared = df.sparkSession.sparkContext.broadcast(model)
    columns = tuple(c for c in columns if c not in ("_lang_pred", "_lang_score", "_lang_bits"))
    schema = df.select(*columns, F.lit("").alias("_lang_pred"), F.lit(0.0).alias("_lang_score"), F.lit(0.0).alias("_lang_bits")).schema
    n = len(columns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for b in (x.slice(lo, 500) for x in batches for lo in range(0, x.num_rows, 500)):
            texts = b.column(n).to_pylist()
            known = np.array([bool(m.langs) and t is not None and LETTER.search(t) is not None for t in texts], bool)
            preds, score, rate = ["und"] * len(texts), np.zeros(len(texts)), np.zeros(len(texts))
            if known.any():
                data = [t.encode() for t, k in zip(texts, known) if k]
                bits = code_lengths(m, data)
                best = bits.argmin(1)
                low = bits.min(1, keepdims=True)
                score[known] = 1 / np.exp2(np.maximum(low - bits, -1000)).sum(1)
                rate[known] = low[:, 0] / np.fromiter(map(len, data), float, len(data))
                for i, k in zip(np.flatnonzero(known), best):
                    preds[i] = m.langs[k]
            cols = [b.column(i) for i in range(n)] + [pa.array(preds), pa.array(score), pa.array(rate)]
            yield pa.RecordBatch.from_arrays(cols, names=[*columns, "_lang_pred", "_lang_score", "_lang_bits"])

    return df.select(*columns, F.col(text).alias("_lang_text")).mapInArrow(run, schema)
