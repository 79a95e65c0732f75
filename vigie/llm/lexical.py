"""Ranked lexical search: best-first over document intervals, bounded by range-maximum tables of posting lists.

* The queries are cut into blocks of about ``QUERY_TERMS`` terms, so what is sent to all tasks is bounded; for each block all
  documents are indexed and searched. Queries with equal terms are searched once.
* Indexing: each task goes through its whole texts and puts out index blocks: posting lists (document place, occurrences)
  of the terms some query asks for, for at most about ``BLOCK_POSTINGS`` postings. No posting is shuffled. Counts of documents, terms
  and of the documents that hold a term cover the whole table.
* Searching: in an index block every posting gets its impact (its whole share of a score), and the posting lists get sparse
  tables: for every power of two the place of the largest impact in every stretch of that length, so the largest impact of
  a term in any interval of documents is had from two entries. Their sum over the query's terms bounds the score of every
  document in the interval. The interval of the highest bound is taken first; the document with its largest impact is scored and the
  interval is split there. Intervals below the worst of the best ``k`` so far are dropped unseen. Many intervals of
  a query are taken at once, so the work is done on arrays.
* A task keeps the best ``k`` of each query over all its blocks; only these are shuffled and ranked.

Terms are stretches of ASCII letters (A-Z lower-cased), ASCII digits and characters beyond ASCII, in the whole text. Null or
empty text holds none. Rows repeated whole are documents of their own, each with its rank; equal scores come by ascending id, a
null id last, and rows equal in score and id are interchangeable. Repeated queries get equal results. A query without a match,
and an empty table on either side, gives no rows. Extra columns are ignored unless named in ``columns``.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vigie.llm.common import NULL_ID, stored

TOP = 10
QUERY_TERMS = 200_000
BLOCK_POSTINGS = 1_000_000
CHUNK_BYTES = 1 << 20
#: Intervals of a query taken at once, and its documents scored before the others' bounds are looked at again.
AT_ONCE = 128
#: Fixed values of the scoring rule.
WEIGHT_SCALE, TF_SCALE, TF_WEIGHT, SIZE_WEIGHT, SIZE_BASE, SIZE_SLOPE = 1000, 1_000_000_000, 1000, 8, 100, 90
#: Every byte to itself (A-Z to a-z) if it belongs to a term, else to a space.
TERM_BYTES = bytes(c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else c + 32 if 65 <= c <= 90 else 32 for c in range(256))

INDEX = "n_docs long, n_terms long, docs binary, lens binary, code binary, place binary, times binary"
FOUND = "query int, doc long, score long"


def terms(data: bytes) -> list[bytes]:
    return data.translate(TERM_BYTES).split()


# ---- index ----------------------------------------------------------------------------------------------------------


def posting_rows(texts: list[bytes], vocabulary: dict[bytes, int]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Numbers of terms per text, and ``(text, code, occurrences)`` of the vocabulary's terms."""
    split = [terms(t) for t in texts]
    lens = np.fromiter(map(len, split), np.int64, len(split))
    get = vocabulary.get
    code = np.fromiter((get(t, -1) for one in split for t in one), np.int64, int(lens.sum()))
    who = np.repeat(np.arange(len(texts)), lens)[code >= 0]
    key, times = np.unique(who * len(vocabulary) + code[code >= 0], return_counts=True)
    return lens, key // max(len(vocabulary), 1), key % max(len(vocabulary), 1), times


def packed(docs: np.ndarray, lens: np.ndarray, who: np.ndarray, code: np.ndarray, times: np.ndarray) -> tuple:
    """An index block. Documents stand by their most frequent term, then by length, so that likes are neighbours."""
    best = np.lexsort((code, -times, who))
    first = best[np.unique(who[best], return_index=True)[1]]  # one posting for each document that has any
    held = who[first]
    order = np.lexsort((docs[held], lens[held], code[first]))
    place = np.zeros(len(docs), np.int64)
    place[held[order]] = np.arange(len(held))
    by = np.lexsort((place[who], code))
    own = held[order]
    return tuple(a.tobytes() for a in (docs[own], lens[own], code[by].astype(np.int32), place[who][by].astype(np.int32), times[by].astype(np.int32)))


def index_blocks(docs: DataFrame, vocabulary, doc_id: str, text: str, most: int) -> DataFrame:
    names = [c.split()[0] for c in INDEX.split(", ")]
    types = [pa.int64(), pa.int64()] + [pa.binary()] * 5

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        n_docs = n_terms = n_rows = size = 0

        def block() -> pa.RecordBatch:
            ids, lens, who, code, times = (np.concatenate(x) for x in zip(*held))
            row = (n_docs, n_terms, *packed(ids, lens, who, code, times))
            return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, types)], names)

        for b in batches:
            ids = b.column(0).to_numpy(zero_copy_only=False)
            texts = [t.as_py() or b"" for t in b.column(1)]
            for lo, hi in stretches(texts):
                lens, who, code, times = posting_rows(texts[lo:hi], vocabulary.value)
                held.append((ids[lo:hi], lens, who + n_rows, code, times))
                n_docs, n_terms, n_rows, size = n_docs + int((lens > 0).sum()), n_terms + int(lens.sum()), n_rows + hi - lo, size + len(who)
                if size >= most or n_rows >= most:
                    yield block()
                    held, n_docs, n_terms, n_rows, size = [], 0, 0, 0, 0
        if held:
            yield block()

    rows = docs.select(F.coalesce(F.col(doc_id).cast("long"), F.lit(NULL_ID)), F.col(text).cast("binary"))
    return stored(rows.mapInArrow(run, INDEX), "postings")


def stretches(texts: list[bytes], most: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Runs ``(from, to)`` of texts that end once they hold ``most`` bytes."""
    first = held = 0
    for i, t in enumerate(texts):
        held += len(t)
        if held >= most:
            yield first, i + 1
            first, held = i + 1, 0
    if len(texts) > first:
        yield first, len(texts)


def document_counts(blocks: DataFrame) -> tuple[int, int, dict[int, int]]:
    """Documents with a term, all their terms, and for each term of the vocabulary the documents that hold it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(0, np.int64)
        for b in batches:
            for x in b.column(0):
                own = np.bincount(np.frombuffer(x.as_py(), np.int32), minlength=len(total))
                own[: len(total)] += total
                total = own
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], ["code", "df"])

    all_of = blocks.agg(F.sum("n_docs"), F.sum("n_terms")).first()
    df = blocks.select("code").mapInArrow(run, "code long, df long").groupBy("code").agg(F.sum("df").alias("df"))
    return all_of[0] or 0, all_of[1] or 0, {r["code"]: r["df"] for r in df.collect()}  # at most one row for each term of the block of queries


# ---- search in a block ----------------------------------------------------------------------------------------------


class Impacts:
    """The posting lists of a block with their impacts and sparse tables."""

    def __init__(self, docs, lens, code, place, times, weight: np.ndarray, n_docs: int, n_terms: int):
        self.docs, self.place, self.n = docs, place.astype(np.int64), len(docs)
        size = SIZE_BASE - SIZE_SLOPE + SIZE_SLOPE * lens * n_docs // max(n_terms, 1)
        times = times.astype(np.int64)
        self.impact = weight[code] * (TF_SCALE * times // (TF_WEIGHT * times + SIZE_WEIGHT * size[place]))
        self.starts = np.searchsorted(code, np.arange(len(weight) + 1))
        self.key = code.astype(np.int64) * self.n + place
        longest = int(np.diff(self.starts).max(initial=0))
        self.log = np.zeros(longest + 2, np.int64)
        for i in range(2, len(self.log)):
            self.log[i] = self.log[i >> 1] + 1
        level = np.arange(len(code), dtype=np.int32)
        self.best = [level]
        step = 1
        while 2 * step <= longest:
            a, b = level[:-step], level[step:]
            level = np.concatenate([np.where(self.impact[a] >= self.impact[b], a, b), level[-step:]])
            self.best.append(level)
            step *= 2
        self.best = np.concatenate(self.best)

    def largest(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Of intervals x terms, each a stretch ``a:b`` of a posting list: the sum of the largest impacts, and the place of the largest."""
        some = b > a
        level = self.log[b - a]
        base = level * len(self.place)
        i = self.best[base + np.where(some, a, 0)] if len(self.place) else a
        j = self.best[base + np.where(some, b - (1 << level), 0)] if len(self.place) else a
        vi, vj = self.impact[i], self.impact[j]
        value = np.where(some, np.maximum(vi, vj), 0)
        top = value.argmax(1)
        row = np.arange(len(a))
        return value.sum(1), self.place[np.where(vi >= vj, i, j)[row, top]]

    def search(self, codes: np.ndarray, k: int, best: list[tuple[int, int]]) -> list[tuple[int, int]]:
        """The best ``k`` as ``(-score, doc)`` of those in ``best`` and the documents of this block."""
        codes = codes[self.starts[codes + 1] > self.starts[codes]]
        if not len(codes):
            return best
        a, b = self.starts[codes][None, :], self.starts[codes + 1][None, :]
        bound, at = self.largest(a, b)
        base = codes * self.n
        least = -best[k - 1][0] if len(best) >= k else 1
        while len(bound):
            take = np.argpartition(-bound, AT_ONCE - 1)[:AT_ONCE] if len(bound) > AT_ONCE else np.arange(len(bound))
            ta, tb, tat = a[take], b[take], at[take]
            keep = np.ones(len(bound), bool)
            keep[take] = False
            want = base + tat[:, None]
            cut = np.searchsorted(self.key, want)
            cut = np.clip(cut, ta, tb)
            here = (cut < tb) & (self.key[np.minimum(cut, len(self.key) - 1)] == want)
            score = np.where(here, self.impact[np.minimum(cut, len(self.key) - 1)], 0).sum(1)
            good = score >= least
            if good.any():
                best = sorted(best + list(zip((-score[good]).tolist(), self.docs[tat[good]].tolist())))[:k]
                least = max(least, -best[k - 1][0]) if len(best) >= k else least
            na, nb = np.concatenate([ta, cut + here]), np.concatenate([cut, tb])
            nbound, nat = self.largest(na, nb)
            new, keep = nbound >= least, keep & (bound >= least)  # a tie may hold a smaller id
            a, b = np.concatenate([a[keep], na[new]]), np.concatenate([b[keep], nb[new]])
            bound, at = np.concatenate([bound[keep], nbound[new]]), np.concatenate([at[keep], nat[new]])
        return best


def search_blocks(blocks: DataFrame, queries, weight: np.ndarray, n_docs: int, n_terms: int, k: int) -> DataFrame:
    spark = blocks.sparkSession
    shared = spark.sparkContext.broadcast((queries, weight))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked, weights = shared.value
        best: list[list[tuple[int, int]]] = [[] for _ in asked]
        kinds = (np.int64, np.int64, np.int32, np.int32, np.int32)
        for b in batches:
            for row in zip(*(b.column(i) for i in range(5))):
                own = Impacts(*(np.frombuffer(x.as_py(), t) for x, t in zip(row, kinds)), weights, n_docs, n_terms)
                for q, codes in enumerate(asked):
                    best[q] = own.search(codes, k, best[q])
        flat = [(q, d, -s) for q, one in enumerate(best) for s, d in one]
        yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in flat], t) for i, t in enumerate((pa.int32(), pa.int64(), pa.int64()))], ["query", "doc", "score"])

    return stored(blocks.select("docs", "lens", "code", "place", "times").mapInArrow(run, FOUND), "found")


# ---- operator -------------------------------------------------------------------------------------------------------


def weights_of(df: dict[int, int], size: int, n_docs: int) -> np.ndarray:
    return np.array([math.floor(WEIGHT_SCALE * math.log((2 * n_docs + 2) / (2 * df.get(c, 0) + 1))) for c in range(size)], np.int64)


def search(docs: DataFrame, items: DataFrame, columns: tuple[str, ...] = ("item_id",), k: int = TOP, doc_id: str = "doc_id", text: str = "text", item_text: str = "text", query_terms: int = QUERY_TERMS, block_postings: int = BLOCK_POSTINGS) -> DataFrame:
    """``columns`` of ``items`` plus ``_rank`` (from 1), ``_doc_id`` and ``_score`` for the ``k`` best rows of ``docs``."""
    spark, n = docs.sparkSession, len(columns)
    held = [f"_item_{i}_" for i in range(n)]  # a caller's names may be names used here

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            own = [sorted(set(terms(t.as_py() or b""))) for t in b.column(n)]
            yield pa.RecordBatch.from_arrays([*(b.column(i) for i in range(n)), pa.array(own, pa.list_(pa.binary()))], names=[*held, "terms"])

    named = items.select(*[F.col(c).alias(h) for c, h in zip(columns, held)], F.col(item_text).cast("binary").alias("terms"))
    asked = named.mapInArrow(read, named.withColumn("terms", F.array("terms")).schema)
    asked = stored(asked.withColumn("row", F.monotonically_increasing_id()), "queries")
    total = asked.agg(F.sum(F.size("terms"))).first()[0] or 0
    n_blocks = -(-total // query_terms)
    out = asked.select(*held, F.lit(0).cast("int").alias("place"), F.lit(0).cast("long").alias("doc"), F.lit(0).cast("long").alias("score")).limit(0)
    for block in range(n_blocks):
        mine = asked.where((F.pmod(F.xxhash64("row"), F.lit(n_blocks)) == block) & (F.size("terms") > 0))
        kinds: dict[tuple, list[int]] = {}
        for r in mine.select("row", "terms").collect():  # about ``query_terms`` terms
            kinds.setdefault(tuple(map(bytes, r["terms"])), []).append(r["row"])
        vocabulary = {t: c for c, t in enumerate(sorted({t for one in kinds for t in one}))}
        queries = [np.array([vocabulary[t] for t in one], np.int64) for one in kinds]
        blocks = index_blocks(docs, spark.sparkContext.broadcast(vocabulary), doc_id, text, block_postings)
        n_docs, n_terms, df = document_counts(blocks)
        found = search_blocks(blocks, queries, weights_of(df, len(vocabulary), n_docs), n_docs, n_terms, k)
        asks = spark.createDataFrame([(q, row) for q, own in enumerate(kinds.values()) for row in own], "query int, row long")
        order = Window.partitionBy("query").orderBy(F.desc("score"), "doc")
        best = found.withColumn("place", F.row_number().over(order)).where(F.col("place") <= k)
        hits = best.join(asks, "query").join(mine.drop("terms"), "row")
        out = out.unionByName(hits.select(*held, "place", F.when(F.col("doc") != NULL_ID, F.col("doc")).alias("doc"), "score"))
    return out.toDF(*columns, "_rank", "_doc_id", "_score")
