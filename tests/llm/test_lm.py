import math
import re
import time
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from vigie.llm import attention, lm
from vigie.llm.common import tokenizer_path

PATH = tokenizer_path("byte_bpe_50k.json")


def tokens(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x20\x09-\x0D]+", low) + ["<end>"]


def tiny_tables(vocab=12, end=0, head=8, classes=4):
    rng = np.random.default_rng(0)
    pair = np.array([a * 65536 + b for a in range(vocab) for b in range(vocab)])
    return attention.prior(pair, rng.integers(0, 20, len(pair)), vocab, end, head, classes)


def tiny_model(tables, seed=1):
    rng = np.random.default_rng(seed)
    p = attention.init(tables)
    return {k: (v + 0.3 * rng.standard_normal(v.shape)).astype(np.float32) for k, v in p.items()}


def naive(params, tables, ids):
    """log10 probability by the definition: window by window, id by id, no batches."""
    p = {k: v.astype(float) for k, v in params.items()}
    end = int(tables["end"])
    seq = [end, *ids, end]
    total = 0.0
    for at in range(len(seq) - 1):
        begin = max(0, at // attention.STRIDE * attention.STRIDE - attention.STRIDE)
        e = p["e"][tables["slot"][seq[begin : at + 1]]]
        q = e[-1] @ p["wq"]
        s = e @ p["wk"] @ q / math.sqrt(attention.KEY) + p["rel"][np.arange(at - begin, -1, -1)]
        s = np.exp(np.minimum(s, 60))
        o = (s / s.sum()) @ (e @ p["wv"])
        hid = np.maximum(o @ p["w1"] + e[-1] @ p["w2"] + p["b"], 0)
        prev, cur = tables["slot"][seq[at]], tables["slot"][seq[at + 1]]
        z = hid @ p["out"] + tables["bias"][prev]
        z = np.exp(z - z.max())
        total += math.log(z[tables["group"][cur]] / z.sum()) + tables["inside"][prev, cur] + tables["tail"][seq[at + 1]]
    return total / math.log(10)


def test_windows_score_each_token_once_with_its_context():
    tables = tiny_tables()
    model = tiny_model(tables)
    rng = np.random.default_rng(2)
    texts = [rng.integers(0, 12, n).astype(np.uint16) for n in (0, 1, 31, 32, 33, 63, 64, 65, 200, 0)]
    got = attention.Runner(model, tables).texts(texts)
    assert np.allclose(got, [naive(model, tables, t.tolist()) for t in texts], rtol=1e-4, atol=1e-3)


def test_probabilities_of_the_next_id_add_up():
    tables = tiny_tables()
    model = attention.Runner(tiny_model(tables), tables)
    before = [3, 9, 1]
    base = model.texts([np.array(before, np.uint16)])[0]
    # p(before + x) / p(before) over all x, without the end's own part
    w = naive(tiny_model(tables), tables, before)
    assert np.isclose(base, w, atol=1e-3)
    prev = tables["slot"][before[-1]]
    total = np.zeros(int(tables["group"].max()) + 1)
    for x in range(12):
        total[tables["group"][tables["slot"][x]]] += np.exp(tables["inside"][prev, tables["slot"][x]] + tables["tail"][x])
    assert np.allclose(total[np.unique(tables["group"][tables["slot"]])], 1, atol=1e-4)


def test_gradients_match_finite_differences(monkeypatch):
    tables = {k: v.astype(np.float64) if v.dtype == np.float32 else v for k, v in tiny_tables().items()}
    params = {k: v.astype(np.float64) for k, v in tiny_model(tiny_tables()).items()}
    rng = np.random.default_rng(3)
    slots = tables["slot"][rng.integers(0, 12, 70)]
    w = attention.windows(slots, np.array([0, 40]), np.array([40, 70]), len(params["e"]) - 1)
    classes = rng.integers(0, 4, (len(w), attention.STRIDE))
    classes[0, 5] = -1
    _, g = attention.gradients(params, tables, w, classes)
    for name, value in params.items():
        for at in rng.integers(0, value.size, 4):
            own = value.reshape(-1)
            kept = own[at]
            own[at] = kept + 1e-5
            up = attention.gradients(params, tables, w, classes)[0]
            own[at] = kept - 1e-5
            down = attention.gradients(params, tables, w, classes)[0]
            own[at] = kept
            assert np.isclose((up - down) / 2e-5, g[name].reshape(-1)[at], rtol=2e-2, atol=2e-5), name


class Rows(np.ndarray):
    """Notes how much of it a product takes."""

    taken: list[int] = []

    def __array_ufunc__(self, ufunc, method, *inputs, **kwargs):
        if ufunc is np.matmul:
            Rows.taken.append(self.size)
        kwargs = {k: tuple(x.view(np.ndarray) if isinstance(x, Rows) else x for x in v) if k == "out" else v for k, v in kwargs.items()}
        return getattr(ufunc, method)(*(x.view(np.ndarray) if isinstance(x, Rows) else x for x in inputs), **kwargs)


def test_a_training_step_does_not_project_every_id():
    tables = tiny_tables(vocab=900, head=800)
    params = tiny_model(tables)
    slots = np.resize(np.array([3, 9, 1, 7]), 70)
    w = attention.windows(slots, np.array([0, 40]), np.array([40, 70]), len(params["e"]) - 1)
    Rows.taken.clear()
    attention.gradients(params | {"e": params["e"].view(Rows)}, tables, w, np.zeros((len(w), attention.STRIDE), int))
    assert Rows.taken and max(Rows.taken) < params["e"].size / 2


def test_rows_are_summed_by_id():
    rng = np.random.default_rng(4)
    for kind in (np.float32, np.float64):
        for n, ids in ((7, rng.integers(0, 7, 300)), (7, rng.choice([0, 2, 5], 300)), (1, np.zeros(6, int))):
            x = rng.integers(-9, 9, (len(ids), 6)).astype(kind)
            want = np.zeros((n, 6), kind)
            np.add.at(want, ids, x)
            got = attention._by_id(x, ids, n)
            assert got.dtype == kind and np.array_equal(got, want)


def test_shuffles_of_past_rounds_are_deleted(spark):
    rng = np.random.default_rng(0)
    ids = [rng.integers(0, 300, 100 + i % 60).astype(np.uint16) for i in range(200)]
    df = spark.createDataFrame([(i, i * 1000003, bytearray(x.tobytes())) for i, x in enumerate(ids)], "doc_id long, text_hash long, ids binary").cache()
    df.count()
    files = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    held = lambda: set(re.findall(r"shuffle_(\d+)_", files.getAllFiles().mkString(" ")))
    before = held()
    lm.fit(df, rounds=6, head=64)
    for _ in range(50):
        if len(held() - before) <= 4:  # those of the last two rounds
            return
        time.sleep(0.1)
    raise AssertionError(held() - before)


def test_base_matches_brute_force(docs, rows):
    on = F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(7)) != 2, F.lit(True))
    got = lm.lm_scores(docs, PATH, rounds=1).collect()
    assert len(got) == len(rows)
    held = {r[0]: r[0] is not None and zlib.crc32(str(r[0]).encode()) % 7 == 2 for r in rows}
    count = Counter()
    for r in rows:
        if not held[r[0]]:
            count.update(tokens(r[1]))
    n, v = sum(count.values()), len(count)
    want = []
    for i, t, *_ in rows:
        own = tokens(t)
        want.append((i, held[i], len(own), sum(count[w] > 0 for w in own), n, sum(math.log10((count[w] + 1) / (n + v + 1)) for w in own)))
    got = sorted(((r["doc_id"], r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], r["base_score"], r["score"]) for r in got), key=lambda r: (str(r[0]), r[2]))
    for a, b in zip(got, sorted(want, key=lambda r: (str(r[0]), r[2]))):
        assert a[:5] == b[:5]
        assert math.isclose(a[5], b[5], rel_tol=1e-9)
        assert a[6] < 0
    assert on is not None


def test_base_of_a_file_stored_twice(spark, tmp_path):
    rows = [(i, f"a{i} b c{i % 3}") for i in range(1, 21)]
    for name in ("one", "two"):  # two tasks hold the same rows in the same order
        spark.createDataFrame(rows, "doc_id long, text string").coalesce(1).write.parquet(f"{tmp_path}/{name}")
    df = spark.read.parquet(f"{tmp_path}/one").union(spark.read.parquet(f"{tmp_path}/two"))
    every = lm.encoded(df, PATH, lm.crc_mod("doc_id", 7) != 2, 4).cache()
    held = [(i, t) for i, t in rows * 2]
    train = Counter(w for i, t in held if zlib.crc32(str(i).encode()) % 7 != 2 for w in tokens(t))
    n, v = sum(train.values()), len(train)
    got = {r["doc_id"]: r for r in lm.base_scores(every.where("part is not null").select("part", "block", "words", "times", "who")).collect()}
    for i, t in rows:
        own = tokens(t)
        r = got[i]
        assert r["train_tokens"] == n and r["n_known"] == sum(train[w] > 0 for w in own)
        assert r["log_sum"] - len(own) * r["log_all"] == pytest.approx(sum(math.log10((train[w] + 1) / (n + v + 1)) for w in own))


def test_empty_and_untrained(spark, docs, empty):
    assert lm.lm_scores(empty, PATH, rounds=1).count() == 0
    few = docs.where("doc_id in (1, 103)")
    got = {r["doc_id"]: r for r in lm.lm_scores(few, PATH, train=F.lit(False), rounds=1).collect()}
    assert got[1]["train_tokens"] == 0 and got[1]["n_known"] == 0 and got[1]["held_out"]
    assert math.isclose(got[103]["base_score"], 0.0, abs_tol=1e-12)
    assert got[1]["score"] < 0


def test_training_beats_the_bigram_prior_on_held_out_rows(spark):
    from vigie.llm.queries import op1

    df = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    every = lm.encoded(df, PATH, lm.crc_mod("doc_id", 7) != 2, 4).cache()
    texts = every.where("part is null").select("doc_id", "text_hash", "train", "n_tokens", "ids")
    params, tables, losses = lm.fit(texts.where("train"))
    assert losses[-1] < losses[0]
    held = texts.where("not train")
    trained = lm.scored(held, params, tables, ("doc_id",)).agg(F.sum("score")).first()[0]
    bigram = lm.scored(held, attention.init(tables), tables, ("doc_id",)).agg(F.sum("score")).first()[0]
    assert trained > 0.96 * bigram  # both are negative
    assert op1.NAME.startswith("op1_")


@pytest.mark.parametrize("every", [1, 4])
def test_training_windows_follow_the_texts(spark, every):
    ids = [np.arange(n, dtype=np.uint16) + 5 for n in (0, 10, 31, 32, 100, 500)]
    df = spark.createDataFrame([(i, i * 1000003, bytearray(x.tobytes())) for i, x in enumerate(ids)], "doc_id long, text_hash long, ids binary")
    got = [np.frombuffer(r["ids"], np.int32) for r in lm.training_windows(df, every).collect()]
    assert all(len(g) == attention.WINDOW + 1 for g in got)
    total = sum(-(-(len(x) + 1) // attention.STRIDE) for x in ids)
    assert len(got) == total if every == 1 else 0 < len(got) < total


@pytest.mark.parametrize("texts", [3, 400])
def test_every_window_is_trained_once_at_every_size(spark, monkeypatch, tmp_path, texts):
    monkeypatch.setattr(lm, "WORKER_WINDOWS", 8)
    monkeypatch.setattr(lm, "LEAST_WINDOWS", 100, raising=False)  # where a smaller share of the windows began
    real, folder = lm._train, str(tmp_path)

    def seen(*args):
        run = real(*args)

        def noted(group):
            got = run(group)
            with open(f"{folder}/{args[3]}-{got['worker'].iloc[0]}", "wb") as f:
                f.write(b"".join(np.frombuffer(x, np.uint16 if len(x) == 2 * attention.WINDOW + 2 else np.int32).astype(np.int32).tobytes() for x in group["ids"]))
            return got

        return noted

    monkeypatch.setattr(lm, "_train", seen)
    rng = np.random.default_rng(0)
    ids = [rng.integers(0, 300, 100 + i % 60).astype(np.uint16) for i in range(texts)]
    df = spark.createDataFrame([(i, i * 1000003, bytearray(x.tobytes())) for i, x in enumerate(ids)], "doc_id long, text_hash long, ids binary").cache()
    lm.fit(df, rounds=2, head=64)
    trained = np.concatenate([np.frombuffer(p.read_bytes(), np.int32).reshape(-1, attention.WINDOW + 1) for p in tmp_path.iterdir()])
    trained = np.where(trained == 0xFFFF, -1, trained)
    want = np.stack([np.frombuffer(r["ids"], np.int32) for r in lm.training_windows(df, 1).collect()])
    assert sorted(map(tuple, trained)) == sorted(map(tuple, want))
