import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from vigie.llm import classifier
from vigie.llm.common import crc_mod
from vigie.llm.queries import op12

SF = "/root/testdata/sf0.01"


def features_by_hand(text, bits):
    """{place: count} with Python's integers."""
    import xxhash

    tokens = classifier.TOKEN.findall(text.encode())
    h = [xxhash.xxh3_64_intdigest(t) for t in tokens]
    h = [int(classifier.SAME) if i and tokens[i] == tokens[i - 1] else x for i, x in enumerate(h)]
    odd, pair, mask = int(classifier.ODD), int(classifier.PAIR), 2**64 - 1
    every = [x * odd & mask for x in h] + [((a * pair & mask) ^ b) * odd & mask for a, b in zip(h, h[1:])]
    out = {}
    for x in every:
        out[x >> (64 - bits)] = out.get(x >> (64 - bits), 0) + 1
    return out


def test_features():
    texts = ["", "one", "a b b b c", "The the THE!! x%%% | y", "naïve 日本語 naïve naïve", "a b"]
    places, counts, ends = classifier.Features(18)([t.encode() for t in texts])
    for t, a, b in zip(texts, ends, ends[1:]):
        assert dict(zip(places[a:b].tolist(), counts[a:b].tolist())) == features_by_hand(t, 18)


def test_learning_step_follows_the_published_rule():
    rng = np.random.default_rng(1)
    own = classifier.Leader.blank(4)
    z, n = [0.0] * 17, [0.0] * 17
    for _ in range(200):
        places = rng.choice(16, 3, replace=False)
        x = rng.random(3)
        target = float(rng.integers(2))
        weights = []
        for i in (*places, 16):
            weights.append(0.0 if abs(z[i]) <= classifier.L1 else -(z[i] - math.copysign(classifier.L1, z[i])) / ((classifier.BETA + math.sqrt(n[i])) / classifier.ALPHA + classifier.L2))
        p = 1 / (1 + math.exp(-sum(w * v for w, v in zip(weights, (*x, 1.0)))))
        assert own.learn(places, x, target) == pytest.approx(p)
        for i, v, w in zip((*places, 16), (*x, 1.0), weights):
            g = (p - target) * v
            z[i] += g - (math.sqrt(n[i] + g * g) - math.sqrt(n[i])) / classifier.ALPHA * w
            n[i] += g * g
    assert own.z == pytest.approx(z) and own.n == pytest.approx(n)


@pytest.fixture(scope="module")
def weights(spark, rows):
    labels = spark.createDataFrame([(r[0], i % 2, 0) for i, r in enumerate(rows) if r[0] is not None], "doc_id long, quality int, toxic int")
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    return classifier.fit(docs, labels, rounds=2)


def test_scores_are_sparse_dot_products(spark, rows, docs, weights):
    out = classifier.score(docs, weights, columns=("doc_id", "score", "n"))
    assert out.columns == ["doc_id", "score", "n", "_score"]
    got = {(r["doc_id"], round(r["_score"], 9)) for r in out.collect()}
    assert out.count() == len(rows)
    want = set()
    for i, text, *_ in rows:
        f = features_by_hand(text or "", classifier.BITS)
        total = sum(f.values())
        margin = weights[-1] + classifier.SCALE * sum(weights[p] * math.sqrt(c / total) for p, c in f.items())
        want.add((i, round(1 / (1 + math.exp(-margin)), 9)))
    assert got == want


def test_empty_tables(spark, docs, empty, weights):
    none = spark.createDataFrame([], "doc_id long, quality int")
    plain = classifier.fit(docs, none, rounds=1)
    assert not plain.any() and {r["_score"] for r in classifier.score(docs, plain).collect()} == {0.5}
    assert classifier.score(empty, weights).count() == 0
    assert not classifier.fit(empty, none, rounds=1).any()


def test_odd_labels_and_repeated_rows(spark):
    docs = spark.createDataFrame([(1, "good text here"), (1, "good text here"), (2, "*** ***"), (3, None), (None, "x")], "doc_id long, text string")
    labels = spark.createDataFrame([(1, 1), (1, 1), (2, 0), (2, 1), (3, 7), (3, None), (None, 1), (9, 1)], "doc_id long, quality int")
    rows = classifier.training_rows(docs, labels, F.lit(True), "doc_id", "text", "quality", 18, 1000).collect()
    assert sorted(r["target"] for r in rows) == [0.5, 1.0]


def test_each_part_is_a_partition(spark):
    docs = spark.range(400).selectExpr("id as doc_id", "concat('word', id) as text")
    rows = classifier.training_rows(docs, docs.selectExpr("doc_id", "1 as quality"), F.lit(True), "doc_id", "text", "quality", 18, 1000)
    parts = classifier.dealt(rows).groupBy(F.spark_partition_id()).agg(F.collect_set("part").alias("p"), F.count("*").alias("n")).collect()
    assert sorted(p for r in parts for p in r["p"]) == list(range(classifier.WORKERS)) and len(parts) == classifier.WORKERS
    assert sum(r["n"] for r in parts) == 400


def test_sample_bound(spark):
    docs = spark.range(4000).selectExpr("id as doc_id", "concat('word', id) as text")
    labels = docs.selectExpr("doc_id", "1 as quality")
    n = classifier.training_rows(docs, labels, F.lit(True), "doc_id", "text", "quality", 18, 500).count()
    assert 400 < n < 600


def test_held_out_accuracy_and_no_leak(spark, tmp_path):
    out = op12.query(spark, SF)
    assert out.columns == ["doc_id", "held_out", "score", "predicted"]
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    pdf = out.join(labels, "doc_id").toPandas()
    held = pdf[pdf["held_out"]]
    rank = held["score"].rank()
    good = int(held["quality"].sum())
    auc = (rank[held["quality"] == 1].sum() - good * (good + 1) / 2) / (good * (len(held) - good))
    assert auc > 0.98 and (held["predicted"] == held["quality"]).mean() > 0.9
    # flipping every held-out label changes no score
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    labels.withColumn("quality", F.when(crc_mod("doc_id", 4) == 2, 1 - F.col("quality")).otherwise(F.col("quality"))).write.parquet(f"{tmp_path}/labels.parquet")
    again = op12.query(spark, str(tmp_path)).toPandas().merge(out.toPandas(), on="doc_id")
    assert (abs(again["score_x"] - again["score_y"]) < 1e-9).all()
