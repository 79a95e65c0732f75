"""Language-model scores: corpus counts, a causal self-attention model trained on Spark, and scoring by windows.

* Tokens of the base score are words (stretches without ASCII white space, A-Z lower-cased) and one end per text. All
  training texts are counted. Words travel as 64-bit hashes, in packed arrays by hash partition; a partition counts its words
  and answers each block of documents with sums, so no word list is ever gathered in one place.
* The model works on subword ids: each word, with a space before it, by the merges of a public byte-level vocabulary.
  Bigram counts over all training texts give its prior tables (bounded by ``attention.HEAD`` squared). Its weights are trained in
  rounds: in each round every worker runs Adam over its own windows, starting from the common weights, which are then
  averaged. Every window of every training text is trained on exactly once, whatever the size of the corpus: a hash deals it to
  a round and a worker. Windows are cut again in each round and never stored.
* Scoring runs over overlapping windows: each id is predicted once, with at least half a window of context before it where
  the text has it, in batches with one causal mask.

The probability of a text is the product over its ids and its end. Null text: as if empty, only the end is predicted.
Repeated rows all count in the corpus and get equal results. Rows with a null id are never held out. An empty training
set leaves uniform prior tables and the base of an empty corpus. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import io
from collections.abc import Iterator
from itertools import count, islice

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vigie.llm import attention
from vigie.llm.common import crc_mod, forgotten, stored
from vigie.llm.merges import Merges
from vigie.llm.wordbpe import Codes

END = 50256
VOCAB = 50257
END_WORD = xxhash.xxh3_64_intdigest(b" end")  # no word holds a space
ROUNDS = 6
RATE = 0.01
#: Windows a worker takes per round at least; from ``MANY_WORKERS`` on workers take more, up to ``MOST_WINDOWS`` on average.
WORKER_WINDOWS = 2048
MANY_WORKERS = 256
MOST_WINDOWS = 1 << 17
BLOCK_DOCS = 4096
BLOCK_TOKENS = 1_500_000
PART_TOKENS = 6_000_000
WORD_SHARES = 8
MOST_WORDS = 400_000
MOST_PAIRS = 4_000_000

ENCODED = (
    "doc_id long, text_hash long, train boolean, n_tokens long, ids binary, "
    "part int, block long, words binary, times binary, who binary"
)


# ---- encoding -------------------------------------------------------------------------------------------------------


class Words:
    """Codes, hashes and subword ids of words, remembered while there are not too many."""

    def __init__(self, path: str):
        self.merges = Merges(path)
        self.clear()

    def clear(self) -> None:
        self.code = Codes()
        self.hash = np.zeros(0, np.uint64)
        self.ids = np.zeros(0, np.uint16)
        self.starts = np.zeros(1, np.int64)

    def codes(self, texts: list[list[bytes]]) -> list[np.ndarray]:
        known, get = len(self.code), self.code.__getitem__
        out = [np.fromiter(map(get, words), np.int64, len(words)) for words in texts]
        new = list(islice(self.code, known, None))
        if new:
            self.hash = np.concatenate([self.hash, np.fromiter(map(xxhash.xxh3_64_intdigest, new), np.uint64, len(new))])
            ids, lens = self.merges.encode([b" " + w for w in new])
            self.ids = np.concatenate([self.ids, ids.astype(np.uint16)])
            self.starts = np.concatenate([self.starts, self.starts[-1] + np.cumsum(lens)])
        return out

    def expand(self, codes: np.ndarray) -> np.ndarray:
        first = self.starts[codes]
        lens = self.starts[codes + 1] - first
        ends = np.cumsum(lens)
        return self.ids[np.repeat(first - (ends - lens), lens) + np.arange(int(ends[-1]) if len(ends) else 0)]


def encoded(df: DataFrame, path: str, train, parts: int, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Two kinds of rows (``ENCODED``): one per document with its subword ids, and packed word counts by hash partition.

    ``train`` is a boolean column; the sign of a document's counts in ``times`` says whether it is a training document, and
    ``who`` which document of the block a count is from. A row with a negative ``part`` holds the keys of a block's documents.
    """
    names = [c.split()[0] for c in ENCODED.split(", ")]
    types = [pa.int64(), pa.int64(), pa.bool_(), pa.int64(), pa.binary(), pa.int32(), pa.int64(), pa.binary(), pa.binary(), pa.binary()]

    def rows(values: list[tuple], first: int) -> pa.RecordBatch:
        cols = [pa.nulls(len(values), t) for t in types]
        for k in range(len(values[0]) if values else 0):
            cols[first + k] = pa.array([v[k] for v in values], types[first + k])
        return pa.RecordBatch.from_arrays(cols, names)

    def deal(keys: list[tuple], held: list[tuple], numbers: Iterator[int]) -> pa.RecordBatch:
        docs = np.array(keys, np.int64).tobytes()
        at = np.array([TaskContext.get().partitionId(), next(numbers)], np.int64).tobytes()  # equal blocks of two tasks stay apart
        block = int.from_bytes(hashlib.blake2b(at + docs, digest_size=8).digest(), "little", signed=True)
        lens = np.fromiter((len(h) for h, _ in held), np.int64, len(held))
        word, times = (np.concatenate(x) for x in zip(*held))
        who = np.repeat(np.arange(len(held), dtype=np.uint16), lens)
        part = ((word >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)).astype(np.int64)
        order = np.argsort(part, kind="stable")
        word, times, who = word[order], times[order], who[order]
        cuts = np.concatenate([[0], np.cumsum(np.bincount(part, minlength=parts))])
        out = [(p, block, word[a:b].tobytes(), times[a:b].tobytes(), who[a:b].tobytes()) for p, (a, b) in enumerate(zip(cuts, cuts[1:])) if b > a]
        out.append((-1 - block % parts, block, docs, b"", b""))
        return rows(out, 5)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = Words(path)
        numbers = count()
        keys: list[tuple] = []
        held: list[tuple] = []
        size = 0
        for b in (x.slice(lo, 500) for x in batches for lo in range(0, x.num_rows, 500)):
            data = [t.as_py() or b"" for t in b.column(1)]
            if len(words.code) > MOST_WORDS:
                words.clear()
            out = []
            for doc, on, d, codes in zip(b.column(0).to_pylist(), b.column(2).to_pylist(), data, words.codes([d.lower().split() for d in data])):
                key = xxhash.xxh3_64_intdigest(d) - 2**63
                own, times = np.unique(codes, return_counts=True)
                out.append((doc, key, on, len(codes) + 1, words.expand(codes).tobytes()))
                keys.append((doc if doc is not None else 0, doc is None, key))
                times = np.append(times, 1).astype(np.int32)
                held.append((np.append(words.hash[own], np.uint64(END_WORD)), times if on else -times))
                size += len(times)
                if len(keys) >= BLOCK_DOCS or size >= BLOCK_TOKENS:
                    yield deal(keys, held, numbers)
                    keys, held, size = [], [], 0
            yield rows(out, 0)
        if keys:
            yield deal(keys, held, numbers)

    return df.select(F.col(doc_id).cast("long"), F.col(text).cast("binary"), F.coalesce(train, F.lit(True))).mapInArrow(run, ENCODED)


# ---- base -----------------------------------------------------------------------------------------------------------


def base_scores(dealt: DataFrame) -> DataFrame:
    """``(doc_id, text_hash, train_tokens, n_known, base_score)`` once per document key."""

    def part(group: pd.DataFrame) -> pd.DataFrame:
        if group["part"].iloc[0] < 0:  # the documents pass
            return pd.DataFrame({"block": group["block"], "docs": group["words"], "who": b"", "sums": b"", "hits": b"", "n": 0, "v": 0})
        word = [np.frombuffer(x, np.uint64) for x in group["words"]]
        cuts = np.cumsum([0, *map(len, word)])
        word = np.concatenate(word)
        times = np.concatenate([np.frombuffer(x, np.int32) for x in group["times"]])
        log, n, v = np.empty(len(word)), 0, 0
        share = word.astype(np.uint8) % WORD_SHARES  # an executor's memory holds the sort of one share of the words, not of all
        for k in range(WORD_SHARES):
            at = np.flatnonzero(share == k)
            _, inverse = np.unique(word[at], return_inverse=True)
            count = np.bincount(inverse, weights=np.maximum(times[at], 0))
            log[at] = np.log10(count + 1)[inverse]
            n, v = n + int(count.sum()), v + int((count > 0).sum())
        out = []
        for x, a, b in zip(group["who"], cuts, cuts[1:]):
            who, own_times = np.frombuffer(x, np.uint16), np.abs(times[a:b])
            own = np.flatnonzero(np.bincount(who))
            sums, hits = np.bincount(who, weights=log[a:b] * own_times), np.bincount(who, weights=(log[a:b] > 0) * own_times)
            out.append((own.astype(np.uint16).tobytes(), sums[own].tobytes(), hits[own].astype(np.uint32).tobytes()))
        first = np.arange(len(group)) == 0  # the partition's own sums stand on its first row
        sums = {"n": np.where(first, n, 0), "v": np.where(first, v, 0)}
        return pd.DataFrame({"block": group["block"], "docs": None} | {k: [r[i] for r in out] for i, k in enumerate(("who", "sums", "hits"))} | sums)

    def block(group: pd.DataFrame) -> pd.DataFrame:
        docs = np.frombuffer(group["docs"].dropna().iloc[0], np.int64).reshape(-1, 3)
        sums, hits = np.zeros(len(docs)), np.zeros(len(docs), np.int64)
        for x, s, h in zip(group["who"], group["sums"], group["hits"]):
            who = np.frombuffer(x, np.uint16)  # a document stands once in a row
            sums[who] += np.frombuffer(s, np.float64)
            hits[who] += np.frombuffer(h, np.uint32)
        ids = pd.array(docs[:, 0], "Int64")
        ids[docs[:, 1] == 1] = pd.NA
        return pd.DataFrame({"doc_id": ids, "text_hash": docs[:, 2], "log_sum": sums, "n_known": hits})

    back = stored(dealt.groupBy("part").applyInPandas(part, "block long, docs binary, who binary, sums binary, hits binary, n long, v long"), "base")
    total = back.agg(F.sum("n"), F.sum("v")).first()
    n, v = total[0] or 0, total[1] or 0
    out = back.select("block", "docs", "who", "sums", "hits").groupBy("block").applyInPandas(block, "doc_id long, text_hash long, log_sum double, n_known long")
    return out.dropDuplicates(["doc_id", "text_hash"]).withColumns({"train_tokens": F.lit(n).cast("long"), "log_all": F.lit(float(np.log10(n + v + 1)))})


# ---- model ----------------------------------------------------------------------------------------------------------


def bigram_counts(texts: DataFrame) -> DataFrame:
    """``(pair, n)`` over all rows of ``texts(ids)``: previous id * 65536 + next id, ends included."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        end = np.array([END], np.uint16)
        parts: list[tuple[np.ndarray, np.ndarray]] = []
        held, size, distinct = [], 0, 0

        def add():
            flat = np.concatenate([x for one in held for x in (end, one)] + [end]).astype(np.uint32)
            held.clear()
            parts.append(np.unique(flat[:-1] << np.uint32(16) | flat[1:], return_counts=True))
            return len(parts[-1][0])

        def flush():
            pair, where = np.unique(np.concatenate([p for p, _ in parts]), return_inverse=True)
            n = np.bincount(where, weights=np.concatenate([c for _, c in parts])).astype(np.int64)
            parts.clear()
            return pa.RecordBatch.from_arrays([pa.array(pair.astype(np.int64)), pa.array(n)], ["pair", "n"])

        for b in batches:
            for x in b.column(0):
                held.append(np.frombuffer(x.as_py(), np.uint16))
                size += len(held[-1]) + 1
                if size >= BLOCK_TOKENS:
                    distinct, size = distinct + add(), 0
                    if distinct > MOST_PAIRS:
                        distinct = 0
                        yield flush()
        if held:
            add()
        if parts:
            yield flush()

    return texts.select("ids").mapInArrow(run, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n"))


def prior_tables(pairs: DataFrame, head: int = attention.HEAD) -> dict[str, np.ndarray]:
    """``attention.prior`` from the corpus's pairs; rare ids are summed to one on Spark, so the driver gets at most head * (head + VOCAB)."""
    single = pairs.groupBy(F.col("pair").bitwiseAND(0xFFFF).alias("id")).agg(F.sum("n").alias("n")).toPandas()
    if not len(single):
        return attention.prior(np.array([END * 65536 + END]), np.array([0]), VOCAB, END, head)
    top = single.sort_values(["n", "id"], ascending=[False, True])["id"].head(head - 2).tolist() + [END]
    spark = pairs.sparkSession
    keep = F.broadcast(spark.createDataFrame([(int(i),) for i in set(top)], "head long"))
    rare_prev = int(min(set(range(VOCAB)) - set(top)))  # any id outside the head stands for all of them
    prev = F.shiftright("pair", 16)
    rows = pairs.join(keep, prev == F.col("head"), "left").select(F.coalesce("head", F.lit(rare_prev)).alias("prev"), F.col("pair").bitwiseAND(0xFFFF).alias("next"), "n")
    rows = rows.groupBy("prev", "next").agg(F.sum("n").alias("n")).toPandas()
    return attention.prior(rows["prev"].to_numpy() * 65536 + rows["next"].to_numpy(), rows["n"].to_numpy(), VOCAB, END, head)


def training_windows(texts: DataFrame, every: int = 1, rounds: int = ROUNDS, only: int | None = None, kind: type = np.int32) -> DataFrame:
    """``(turn, key, ids)`` of the windows of ``texts(text_hash, doc_id, ids)``; ``ids`` is packed ``kind``, -1 pads.

    ``every``: one window in so many; ``only``: the windows of one turn.
    """
    size, stride = attention.WINDOW, attention.STRIDE

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        end = np.array([END], np.uint16)
        for b in (x.slice(lo, 1000) for x in batches for lo in range(0, x.num_rows, 1000)):
            texts = [np.frombuffer(x.as_py(), np.uint16) for x in b.column(2)]
            flat = np.concatenate([y for x in texts for y in (end, x, end)])
            lens = np.fromiter(map(len, texts), np.int64, len(texts)) + 2
            first = np.cumsum(lens) - lens
            per = -(-(lens - 1) // stride)
            text = np.repeat(np.arange(len(texts)), per)
            start = (np.arange(len(text)) - np.repeat(np.cumsum(per) - per, per)) * stride
            seed = b.column(0).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64) ^ b.column(1).to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)
            mix = seed[text] + start.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
            mix ^= mix >> np.uint64(31)
            mix *= np.uint64(0xBF58476D1CE4E5B9)
            mix ^= mix >> np.uint64(33)
            turns = (mix // np.uint64(every) % np.uint64(rounds)).astype(np.int32)
            pick = np.flatnonzero((mix % np.uint64(every) == 0) & (True if only is None else turns == only))
            at = start[pick, None] + np.arange(-stride, size - stride + 1)[None]
            ok = (at >= 0) & (at < lens[text[pick], None])
            rows = np.where(ok, flat[np.where(ok, at + first[text[pick], None], 0)].astype(np.int32), np.int32(-1)).astype(kind)
            mix = mix[pick] // np.uint64(every)
            turn, key = turns[pick], (mix // np.uint64(rounds) % np.uint64(2**31)).astype(np.int64)
            width = rows.shape[1] * rows.itemsize
            ids = pa.FixedSizeBinaryArray.from_buffers(pa.binary(width), len(rows), [None, pa.py_buffer(np.ascontiguousarray(rows).tobytes())]).cast(pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(turn), pa.array(key), ids], ["turn", "key", "ids"])

    return texts.select("doc_id", "text_hash", "ids").mapInArrow(run, "turn int, key long, ids binary")


def _packed(params: dict[str, np.ndarray]) -> bytes:
    out = io.BytesIO()
    np.savez(out, **params)
    return out.getvalue()


def _unpacked(data: bytes) -> dict[str, np.ndarray]:
    with np.load(io.BytesIO(data)) as f:
        return {k: f[k] for k in f.files}


def _mean(group: pd.DataFrame) -> pd.DataFrame:
    weight = group["n"].to_numpy(float)
    every = [_unpacked(x) for x in group["params"]]
    mean = {k: np.tensordot(weight / weight.sum(), np.stack([p[k] for p in every]), 1).astype(np.float32) for k in every[0]}
    return pd.DataFrame({"n": [int(weight.sum())], "loss": [float((group["loss"] * weight).sum() / weight.sum())], "params": [_packed(mean)]})


def fit(texts: DataFrame, rounds: int = ROUNDS, rate: float = RATE, head: int = attention.HEAD) -> tuple[dict, dict, list[float]]:
    """Weights, prior tables and the mean loss of each round, from ``texts(doc_id, text_hash, ids)``."""
    tables = prior_tables(stored(bigram_counts(texts), "pairs"), head)
    total = texts.agg(F.sum(F.ceil((F.octet_length("ids") / 2 + 1) / attention.STRIDE))).first()[0] or 0
    workers = max(1, min(MANY_WORKERS, total // (rounds * WORKER_WINDOWS)), -(-total // (rounds * MOST_WINDOWS)))
    params, losses = attention.init(tables), []
    context = texts.sparkSession.sparkContext
    shared_tables = context.broadcast(tables)
    for turn in range(rounds):
        shared = context.broadcast(params)
        lr = rate * (1 - turn / (rounds + 1))
        own = training_windows(texts, rounds=rounds, only=turn, kind=np.uint16).withColumn("worker", F.col("key") % workers)
        done = own.select("worker", "ids").groupBy("worker").applyInPandas(_train(shared, shared_tables, lr, turn), "worker long, n long, loss double, params binary")
        # averaged in two steps, so the driver gets a few weights however many workers there are
        part = done.groupBy(F.col("worker") % 16).applyInPandas(_mean, "n long, loss double, params binary").toPandas()
        shared.unpersist()
        if len(part):
            mean = _mean(part).iloc[0]
            params, losses = _unpacked(mean["params"]), [*losses, mean["loss"]]
        del own, done
        forgotten(texts.sparkSession)
    return params, tables, losses


def _train(shared, tables, rate: float, seed: int):
    def run(group: pd.DataFrame) -> pd.DataFrame:
        rows = np.stack([np.frombuffer(x, np.uint16) for x in sorted(group["ids"])]).astype(np.int32)
        rows[rows == 0xFFFF] = -1  # no id is that large
        params, loss = attention.train(shared.value, tables.value, rows, rate, seed=seed)
        return pd.DataFrame({"worker": group["worker"].iloc[:1], "n": [len(rows)], "loss": [loss], "params": [_packed(params)]})

    return run


def scored(texts: DataFrame, params: dict, tables: dict, columns: tuple[str, ...]) -> DataFrame:
    """``columns`` plus ``score`` of every row of ``texts`` (with ``ids``)."""
    shared = texts.sparkSession.sparkContext.broadcast((params, tables))
    schema = texts.select(*columns, F.lit(0.0).alias("score")).schema
    n = len(columns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = attention.Runner(*shared.value)
        for b in (x.slice(lo, 200) for x in batches for lo in range(0, x.num_rows, 200)):
            got = model.texts([np.frombuffer(x.as_py(), np.uint16) for x in b.column(n)])
            yield pa.RecordBatch.from_arrays([b.column(i) for i in range(n)] + [pa.array(got)], names=[*columns, "score"])

    return texts.select(*columns, "ids").mapInArrow(run, schema)


def lm_scores(df: DataFrame, path: str, train=None, doc_id: str = "doc_id", text: str = "text", **model) -> DataFrame:
    """``(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score)`` for every row of ``df``.

    ``train``: boolean column of the rows to learn from; by default those whose crc32 of the id is not 2 modulo 7.
    """
    on = crc_mod(doc_id, 7) != 2 if train is None else train
    size = df.select(F.sum(F.octet_length(text))).first()[0] or 0
    every = stored(encoded(df, path, on, max(4, -(-size // (8 * PART_TOKENS))), doc_id, text), "encoded")
    base = stored(base_scores(every.where("part is not null").select("part", "block", "words", "times", "who")), "scores")
    forgotten(df.sparkSession)
    texts = every.where("part is null").select("doc_id", "text_hash", "train", "n_tokens", "ids")
    params, tables, _ = fit(texts.where("train"), **model)
    out = scored(texts, params, tables, ("doc_id", "text_hash", "train", "n_tokens"))
    b = base.select(F.col("doc_id").alias("b_id"), F.col("text_hash").alias("b_hash"), "log_sum", "n_known", "train_tokens", "log_all")
    out = out.join(b, F.col("doc_id").eqNullSafe(F.col("b_id")) & (F.col("text_hash") == F.col("b_hash")), "left")
    return out.select("doc_id", (~F.col("train")).alias("held_out"), "n_tokens", "n_known", "train_tokens", (F.col("log_sum") - F.col("n_tokens") * F.col("log_all")).alias("base_score"), "score")
