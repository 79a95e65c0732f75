import random

from pyspark.sql import functions as F

from vigie.llm import lines


def key(line):
    k = line.strip(" \t\n\x0b\x0c\r")
    k = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in k)
    return k if len(k) >= 10 else None


def brute(rows):
    big = 2**63 - 1
    owner, held = {}, {}
    for i, t in rows:
        i = big if i is None else i
        for k in {key(x) for x in (t or "").split("\n")} - {None}:
            held.setdefault(k, set()).add(i)
    for k, ids in held.items():
        owner[k] = min(ids) if len(ids) > 1 else None
    out = []
    for i, t in rows:
        n = big if i is None else i
        own = (t or "").split("\n")
        kept = [x for x in own if not (key(x) in owner and owner[key(x)] is not None and owner[key(x)] != n)]
        out.append((i, len(own), len(own) - len(kept), "\n".join(kept)))
    return sorted(out, key=str)


def result(df):
    return sorted(((r["doc_id"], r["_n_lines"], r["_n_dropped"], r["text"] or "") for r in df.collect()), key=str)


def test_matches_brute_force(docs, rows, empty):
    out = lines.line_dedup(docs)
    assert out.columns == [*docs.columns, "_n_lines", "_n_dropped"]
    assert result(out) == brute([r[:2] for r in rows])
    assert lines.line_dedup(empty).count() == 0


def random_rows(seed, n, first=0):
    rng = random.Random(seed)
    pool = [f"Common line number {i} of the pool" for i in range(30)]
    return [(first + i, "\n".join(rng.choice(pool + ["short", "", f"own {first + i} {rng.random()}"]) for _ in range(rng.randint(1, 6)))) for i in range(n)]


def store_state(store):
    refs = sorted((bytes(r["key"]), r["refs"], r["owner"]) for r in store.refs.collect())
    held = {r["shard"]: lines.Cuckoo.load(bytes(r["cells"])) for r in store.filters.collect()}
    for r in store.refs.collect():  # no false negatives
        assert held[r["shard"]].contains([bytes(r["key"])]).all()
    return refs


def test_insert_and_delete_are_reversible(spark):
    schema = "doc_id long, text string"
    first, second = random_rows(1, 40, 10), random_rows(2, 30, 100) + random_rows(3, 5)
    a, b = spark.createDataFrame(first, schema), spark.createDataFrame(second, schema)
    store = lines.LineStore.build(lines.postings(a), shards=3)
    before = store_state(store)
    both = store.insert(lines.postings(b))
    assert store_state(both) == store_state(lines.LineStore.build(lines.postings(a.union(b)), shards=3))
    dropped = lines.apply_drops(a.union(b), lines.drop_lists(both.repeated(both.post)))
    assert result(dropped) == brute(first + second)
    back = both.delete(b.select("doc_id"))
    assert store_state(back) == before
    assert result(lines.apply_drops(a, lines.drop_lists(back.repeated(back.post)))) == brute(first)


def test_cuckoo_filter():
    rng = random.Random(4)
    keys = [rng.randbytes(16) for _ in range(5000)]
    f = lines.Cuckoo.of(keys)
    assert f.contains(keys).all()
    other = [rng.randbytes(16) for _ in range(5000)]
    assert f.contains(other).mean() < 0.01
    f.delete(keys[:2500])
    assert f.contains(keys[2500:]).all()
    assert f.contains(keys[:2500]).mean() < 0.01
    assert lines.Cuckoo.load(f.dump()).contains(keys[2500:]).all()


def test_frequent_line_is_summed_before_the_shuffle(spark):
    df = spark.range(20000).select(F.col("id").alias("doc_id"), F.lit("one very common line").alias("text"))
    out = lines.line_dedup(df).agg(F.sum("_n_dropped"), F.count("*")).first()
    assert tuple(out) == (19999, 20000)
