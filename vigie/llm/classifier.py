"""Quality classifier: hashed word n-grams, logistic regression by follow-the-regularised-leader, sparse dot products.

* Tokens are stretches of ASCII letters, digits and characters beyond ASCII, and stretches of any other characters but white
  space; case is kept. A token equal to the one before it is read as ``=``, so a loop of any word looks alike. Features are
  the tokens and the pairs of neighbours, hashed to ``2 ** BITS`` places; a feature's value is the square root of its share of
  all features of the text, so every text has the same length, ``SCALE``.
* Learning (FTRL-proximal, a learning rate for each coordinate, L1 and L2): the training rows are dealt to ``WORKERS``
  parts by a hash. In each of ``ROUNDS`` rounds a task goes through one part in a hashed order, one row at a time, starting from
  the common state; the states are then averaged, each coordinate over the parts that met it. A state is at most two numbers
  for each of the ``2 ** BITS`` places, whatever the corpus, so it may pass through the driver.
* At most about ``MOST_LABELLED`` labelled documents are learned from: beyond that a hash of the id chooses. The same number of
  parts and rounds is used at every size.
* Scoring reads every whole text once, row by row of the table, and shuffles nothing.

Null text is empty; an empty text gets the score of the bias alone. Labels that are null, or outside 0 to 1, or of a null id,
do not count; several labels of one id count as their mean. Rows repeated whole are learned from once and all get equal
scores; one id with several texts gives one training row for each. Without any label the score is 0.5. Ties cannot occur:
a score depends on the text and the state only. Extra columns are ignored unless named in ``columns``. An empty table
gives no rows.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator
from functools import reduce
from itertools import islice

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vigie.llm.common import stored
from vigie.llm.wordbpe import Codes
from vigie.session import ensure_checkpoint_dir

BITS = 18
WORKERS = 8
ROUNDS = 6
MOST_LABELLED = 131_072
#: Learning rate, its offset, and the two penalties.
ALPHA, BETA, L1, L2 = 0.1, 1.0, 0.1, 0.05
#: Length of a text's vector, beside a bias input of 1.
SCALE = 10.0

TOKEN = re.compile(rb"[0-9A-Za-z\x80-\xff]+|[^\x09-\x0d\x20\x80-\xff0-9A-Za-z]+")
SAME = np.uint64(xxhash.xxh3_64_intdigest(b" same"))  # no token holds a space
ODD, PAIR = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)
CHUNK_BYTES = 1 << 20
MOST_TOKENS = 400_000
TRAIN = "turn long, n int, gaps binary, counts binary, target double, part int"
STATE = "span int, places binary, z binary, n binary"
SPAN_BITS = 14


# ---- features -------------------------------------------------------------------------------------------------------


def chunks(texts: list[bytes], most: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Runs ``(from, to)`` of texts of about ``most`` bytes; a longer text stands alone."""
    first = held = 0
    for i, t in enumerate(texts):
        if i > first and held + len(t) > most:
            yield first, i
            first, held = i, 0
        held += len(t)
    if len(texts) > first:
        yield first, len(texts)


class Features:
    """Places and counts of the features of texts; hashes of tokens are remembered while there are not too many."""

    def __init__(self, bits: int = BITS):
        self.bits = bits
        self.code, self.hash = Codes(), np.zeros(0, np.uint64)

    def __call__(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """``(places, counts, ends)``: features of text ``i`` stand in ``ends[i]:ends[i + 1]``, by ascending place."""
        if len(self.code) > MOST_TOKENS:
            self.code, self.hash = Codes(), np.zeros(0, np.uint64)
        tokens = [TOKEN.findall(t) for t in texts]
        lens = np.fromiter(map(len, tokens), np.int64, len(tokens))
        known, get = len(self.code), self.code.__getitem__
        codes = np.fromiter((get(t) for one in tokens for t in one), np.int64, int(lens.sum()))
        new = list(islice(self.code, known, None))
        self.hash = np.concatenate([self.hash, np.fromiter(map(xxhash.xxh3_64_intdigest, new), np.uint64, len(new))])
        who = np.repeat(np.arange(len(texts)), lens)
        h = self.hash[codes]
        inside = who[1:] == who[:-1]  # neighbours within a text
        again = np.flatnonzero(inside & (codes[1:] == codes[:-1])) + 1
        h[again] = SAME
        two = (h[:-1] * PAIR ^ h[1:]) * ODD
        shift = np.uint64(64 - self.bits)
        place = np.concatenate([h * ODD >> shift, two[inside] >> shift]).astype(np.int64)
        keys, counts = np.unique(np.concatenate([who, who[1:][inside]]) << self.bits | place, return_counts=True)
        ends = np.searchsorted(keys >> self.bits, np.arange(len(texts) + 1))
        return (keys & ((1 << self.bits) - 1)).astype(np.int32), counts.astype(np.int32), ends


def narrow(x: np.ndarray) -> bytes:
    """Whole numbers in the fewest bytes each (1, 2 or 4) that hold the largest."""
    most = x.max(initial=0)
    return x.astype(np.uint8 if most < 1 << 8 else np.uint16 if most < 1 << 16 else np.uint32).tobytes()


def widen(data: bytes, n: int) -> np.ndarray:
    return np.frombuffer(data, {1: np.uint8, 2: np.uint16, 4: np.uint32}[len(data) // n if n else 1]).astype(np.int64)


def values(counts: np.ndarray) -> np.ndarray:
    return SCALE * np.sqrt(counts / counts.sum()) if len(counts) else np.zeros(0)


# ---- learning -------------------------------------------------------------------------------------------------------


class Leader:
    """State of FTRL-proximal: ``z`` and ``n`` per place, the bias last."""

    def __init__(self, z: np.ndarray, n: np.ndarray):
        self.z, self.n = z.copy(), n.copy()

    @classmethod
    def blank(cls, bits: int = BITS) -> Leader:
        return cls(np.zeros((1 << bits) + 1), np.zeros((1 << bits) + 1))

    def weights(self, at=slice(None)) -> np.ndarray:
        z, n = self.z[at], self.n[at]
        far = np.maximum(np.abs(z) - L1, 0)
        return -np.sign(z) * far / ((BETA + np.sqrt(n)) / ALPHA + L2)

    def learn(self, places: np.ndarray, x: np.ndarray, target: float) -> float:
        """One row; returns the probability given before the update."""
        at = np.append(places, len(self.z) - 1)
        x = np.append(x, 1.0)
        w = self.weights(at)
        p = probability(float(w @ x))
        g = (p - target) * x
        n = self.n[at]
        self.z[at] += g - (np.sqrt(n + g * g) - np.sqrt(n)) / ALPHA * w
        self.n[at] = n + g * g
        return p


def probability(margin):
    return 1 / (1 + np.exp(-np.clip(margin, -35, 35)))


def training_rows(docs: DataFrame, labels: DataFrame, train: Column, doc_id: str, text: str, target: str, bits: int, most: int) -> DataFrame:
    """Labelled documents of the training fold as features, dealt to parts (``TRAIN``)."""
    usable = labels.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(target).cast("double").alias("target")).where("doc_id is not null and target between 0 and 1")
    known = stored(usable.where(train).groupBy("doc_id").agg(F.avg("target").alias("target")), "labels")
    share = min(1.0, most / max(known.count(), 1))
    chosen = known.where(F.pmod(F.xxhash64("doc_id", F.lit(1)), F.lit(1 << 30)) < F.lit(int(share * (1 << 30))))
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")).join(F.broadcast(chosen), "doc_id")  # at most about ``most`` ids
    rows = rows.dropDuplicates(["doc_id", "text"])
    rows = rows.select(F.xxhash64("doc_id", "text"), F.col("text").cast("binary"), "target", F.pmod(F.xxhash64("doc_id", F.lit(2)), F.lit(WORKERS)).cast("int"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features = Features(bits)
        for b in batches:
            texts = [t.as_py() or b"" for t in b.column(1)]
            for lo, hi in chunks(texts):
                places, counts, ends = features(texts[lo:hi])
                cut = list(zip(ends, ends[1:]))
                turn, target, part = (b.column(k).slice(lo, hi - lo) for k in (0, 2, 3))
                gaps = pa.array([narrow(np.diff(places[i:j], prepend=0)) for i, j in cut], pa.binary())
                counts = pa.array([narrow(counts[i:j]) for i, j in cut], pa.binary())
                cols = [turn, pa.array(np.diff(ends).astype(np.int32)), gaps, counts, target, part]
                yield pa.RecordBatch.from_arrays(cols, [c.split()[0] for c in TRAIN.split(", ")])

    return rows.mapInArrow(run, TRAIN)


def dealt(rows: DataFrame) -> DataFrame:
    """``rows`` stored by part, in hashed order; each part becomes one partition, so no round shuffles them again."""
    spark = rows.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/vigie-llm/features-{uuid.uuid4().hex}"
    rows.repartition(WORKERS, "part").sortWithinPartitions("part", "turn").write.partitionBy("part").parquet(path)
    back = spark.read.schema(rows.schema).parquet(path)
    # Spark lays single partitions of a union upon each other, into one task; a leg of another kind (no such part) keeps them apart
    return reduce(DataFrame.union, [back.where(F.col("part") == k).coalesce(1) for k in range(WORKERS)], back.where("part < 0"))


def one_round(rows: DataFrame, state: Leader) -> Leader:
    """Every part (a partition of ``rows``) goes on from ``state``; the mean of the parts, coordinate by coordinate."""
    shared = rows.sparkSession.sparkContext.broadcast((state.z, state.n))

    def out(own: Leader) -> pa.RecordBatch:
        touched = np.flatnonzero((own.n != shared.value[1]) | (own.z != shared.value[0]))
        span = touched >> SPAN_BITS
        cuts = np.searchsorted(span, np.arange(int(span[-1]) + 2 if len(span) else 1))
        parts = [(k, touched[a:b].astype(np.int32)) for k, (a, b) in enumerate(zip(cuts, cuts[1:])) if b > a]
        cols = [[k for k, _ in parts], [p.tobytes() for _, p in parts], [own.z[p].astype(np.float32).tobytes() for _, p in parts], [own.n[p].astype(np.float32).tobytes() for _, p in parts]]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.int32(), pa.binary(), pa.binary(), pa.binary()))], ["span", "places", "z", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = None
        for b in batches:
            for n, gaps, counts, target in zip(b.column(1).to_pylist(), b.column(2), b.column(3), b.column(4).to_pylist()):
                own = own or Leader(*shared.value)
                own.learn(np.cumsum(widen(gaps.as_py(), n)), values(widen(counts.as_py(), n)), target)
        if own is not None:
            yield out(own)

    def mean(group: pd.DataFrame) -> pd.DataFrame:
        places = np.concatenate([np.frombuffer(x, np.int32) for x in group["places"]])
        at, inverse = np.unique(places, return_inverse=True)
        met = np.bincount(inverse)
        z, n = (np.bincount(inverse, weights=np.concatenate([np.frombuffer(x, np.float32) for x in group[c]])) / met for c in ("z", "n"))
        return pd.DataFrame({"span": [group["span"].iloc[0]], "places": [at.astype(np.int32).tobytes()], "z": [z.tobytes()], "n": [n.tobytes()]})

    merged = Leader(state.z, state.n)
    for r in rows.mapInArrow(run, STATE).groupBy("span").applyInPandas(mean, STATE).collect():  # at most 2 ** BITS + 1 places
        at = np.frombuffer(r["places"], np.int32)
        merged.z[at], merged.n[at] = np.frombuffer(r["z"]), np.frombuffer(r["n"])
    shared.unpersist()
    return merged


def fit(docs: DataFrame, labels: DataFrame, train: Column | None = None, doc_id: str = "doc_id", text: str = "text", target: str = "quality", bits: int = BITS, rounds: int | None = None, most: int = MOST_LABELLED) -> np.ndarray:
    """Weights learned from the labelled rows for which ``train`` (a condition on ``doc_id``) holds; the bias is the last."""
    train = F.lit(True) if train is None else F.coalesce(train, F.lit(False))
    rows = dealt(training_rows(docs, labels, train, doc_id, text, target, bits, most))
    state = Leader.blank(bits)
    for _ in range(rounds or ROUNDS):
        state = one_round(rows, state)
    return state.weights()


def score(df: DataFrame, weights: np.ndarray, columns: tuple[str, ...] = ("doc_id",), text: str = "text") -> DataFrame:
    """``columns`` plus ``_score``, the probability of label 1, for every row of ``df``."""
    shared = df.sparkSession.sparkContext.broadcast(np.asarray(weights, float))
    bits, n = int(len(weights) - 1).bit_length() - 1, len(columns)
    schema = df.select(*columns, F.lit(0.0).alias("_score")).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features, w = Features(bits), shared.value
        for b in batches:
            texts = [t.as_py() or b"" for t in b.column(n)]
            out = np.zeros(len(texts))
            for lo, hi in chunks(texts):
                places, counts, ends = features(texts[lo:hi])
                who = np.repeat(np.arange(hi - lo), np.diff(ends))
                size = np.bincount(who, weights=counts, minlength=hi - lo)
                dot = np.bincount(who, weights=w[places] * np.sqrt(counts), minlength=hi - lo)
                out[lo:hi] = probability(SCALE * dot / np.sqrt(np.maximum(size, 1)) + w[-1])
            yield pa.RecordBatch.from_arrays([*(b.column(i) for i in range(n)), pa.array(out)], names=[*columns, "_score"])

    return df.select(*columns, F.col(text).cast("binary").alias("_scored_text")).mapInArrow(run, schema)
