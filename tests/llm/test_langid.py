import collections
import math
import random

import numpy as np
from pyspark.sql import functions as F

from vigie.llm import langid
from vigie.llm.queries import op5


def brute_bits(train: dict[str, list[bytes]], text: bytes, top: set[bytes]) -> dict[str, float]:
    """Code lengths by the definition, byte by byte: escape with exclusion down to order 0 and the uniform code."""
    out = {}
    for lang, texts in train.items():
        seen = [collections.defaultdict(collections.Counter) for _ in range(4)]
        for t in texts:
            p = b"\0\0\0" + t
            for i in range(3, len(p)):
                for k in range(4):
                    seen[k][p[i - k : i]][p[i]] += 1

        def prob(byte, ctx, lang_seen=seen):
            if ctx is None:
                return 1 / 256
            counts = lang_seen[len(ctx)].get(ctx) if len(ctx) < 3 or ctx in top else None
            below = ctx[1:] if ctx else None
            if not counts:
                return prob(byte, below)
            n, d = sum(counts.values()), len(counts)
            if d == 256:
                return counts[byte] / n
            if byte in counts:
                return counts[byte] / (n + d)
            rest = 1 - sum(prob(b, below) for b in counts)
            return d / (n + d) * prob(byte, below) / rest

        p = b"\0\0\0" + text
        out[lang] = -sum(math.log2(prob(p[i], p[i - 3 : i])) for i in range(3, len(p)))
    return out


def test_code_lengths_match_definition(spark):
    rng = random.Random(1)
    train = {"aa": [bytes(rng.choice(b"abcd ") for _ in range(80)) for _ in range(3)], "bb": [bytes(rng.choice(b"cdef ") for _ in range(60)) for _ in range(2)] + [b"x"]}
    df = spark.createDataFrame([(t.decode(), name) for name, ts in train.items() for t in ts], "text string, lang string")
    counts = langid.gram_counts(df)
    limit = 40
    top = counts.groupBy(F.shiftright("gram", 8).alias("c")).agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "c").limit(limit)
    held = {int(r["c"]).to_bytes(3, "big") for r in top.collect()}
    model = langid.fit(langid.gram_counts(df), limit)
    tests = [b"abcd", b"a", b"dddd ffe", b"zz top", b"abc" * 30, b""]
    got = langid.code_lengths(model, tests)
    for t, row in zip(tests, got):
        want = brute_bits(train, t, held)
        assert np.allclose(row, [want[x] for x in model.langs], rtol=1e-5, atol=1e-4), t


def test_probabilities_add_up(spark):
    df = spark.createDataFrame([("abracadabra", "x"), ("simsalabim", "y")], "text string, lang string")
    model = langid.fit(langid.gram_counts(df))
    seen = np.unique(model.alphabet)
    weight = np.bincount(model.alphabet, minlength=model.width)  # bytes behind each index
    assert np.allclose((np.exp2(-model.bits.astype(float)) * weight[None, :, None]).sum(1), 1, atol=1e-5)
    assert len(seen) == model.width


def test_long_text_in_pieces_equals_whole(spark, monkeypatch):
    df = spark.createDataFrame([("abracadabra simsalabim " * 9, "x"), ("hocus pocus", "y")], "text string, lang string")
    model = langid.fit(langid.gram_counts(df))
    texts = [b"abra", b"", b"hocus abracadabra " * 40, b"pocus"]
    whole = langid.code_lengths(model, texts)
    monkeypatch.setattr(langid, "CHUNK", 64)
    assert np.allclose(langid.code_lengths(model, texts), whole)


def test_edges_and_held_out_accuracy(docs, rows, empty):
    model = langid.fit(langid.gram_counts(docs))
    got = langid.predict(docs, model, columns=("doc_id", "lang")).collect()
    assert len(got) == len(rows)
    by = {r["doc_id"]: r for r in got}
    for i in (103, 104, 105, 106, 112):
        assert by[i]["_lang_pred"] == "und" and by[i]["_lang_score"] == 0
    assert all(by[i]["_lang_pred"] == by[i]["lang"] for i in range(1, 61))
    assert all(0 <= r["_lang_score"] <= 1 for r in got)
    nothing = langid.fit(langid.gram_counts(empty))
    assert {r["_lang_pred"] for r in langid.predict(docs, nothing, columns=("doc_id",)).collect()} == {"und"}
    assert langid.predict(empty, model, columns=("doc_id",)).count() == 0


def test_query_accuracy_on_held_out_rows(spark):
    sf = "/root/testdata/sf0.001"
    got = op5.query(spark, sf).join(spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang"), "doc_id").where("held_out")
    right, n = got.agg(F.sum((F.col("lang") == F.col("lang_pred")).cast("int")), F.count("*")).first()
    assert n > 20 and right >= 0.95 * n


def test_every_top_context_is_held(spark):
    """More contexts than any cap had; those of a small language beside a large one are coded by the definition."""
    rng = random.Random(4)
    alphabet = "abcdefghijklmnopqrstuvwxyz0123456789"
    large = ["".join(rng.choice(alphabet) for _ in range(3000)) for _ in range(12)]
    small = ["qxz zqx xzq qzx " * 3]
    df = spark.createDataFrame([(t, "large") for t in large] + [(t, "small") for t in small], "text string, lang string")
    counts = langid.gram_counts(df)
    contexts = {int(r["c"]).to_bytes(3, "big") for r in counts.select(F.shiftright("gram", 8).alias("c")).distinct().collect()}
    assert len(contexts) > 16384
    model = langid.fit(counts)
    train = {"large": [t.encode() for t in large], "small": [t.encode() for t in small]}
    for t in (b"qxz zqx xzq", large[5][100:160].encode(), b"qqq!zz"):
        want = brute_bits(train, t, contexts)
        assert np.allclose(langid.code_lengths(model, [t])[0], [want[x] for x in model.langs], rtol=1e-5, atol=1e-3), t


def test_letters_by_category(spark):
    train = spark.createDataFrame([("abracadabra", "x"), ("abracadabra", "a"), ("simsalabim", "y")], "text string, lang string")
    model = langid.fit(langid.gram_counts(train))
    texts = ["\u00b2 \u00bd \u2167 12_\u0663 \u0301", "", None, "\u00e9", "\u00bda", "\u4e2d", "\u00aa", "abra"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id long, text string")
    got = {r["id"]: (r["_lang_pred"], r["_lang_score"]) for r in langid.predict(df, model, columns=("id",)).collect()}
    assert [got[i] for i in range(3)] == [("und", 0.0)] * 3
    assert all(got[i][0] != "und" for i in range(3, 8))
    assert got[7][0] == "a"  # equal codes: the first by name
