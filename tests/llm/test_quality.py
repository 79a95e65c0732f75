import re

import pytest

from vigie.llm import quality

SPACE = r"[^\x20\x09-\x0D]+"


def counts(text):
    text = text or ""
    words = re.findall(SPACE, text)
    lines = [x for x in text.split("\n") if re.search(SPACE, x)]
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    marked = {p for i, w in enumerate(windows) if windows.count(w) > 1 for p in (i, i + 1, i + 2)}
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(marked)


def test_measures_match_brute_force(docs, rows):
    short = [r for r in rows if len(r[1] or "") < 5000]
    got = quality.measures(docs.select("doc_id", "text")).select("doc_id", "text", "_q_n_words", "_q_word_chars", "_q_n_symbols", "_q_n_dup_lines", "_q_n_repeat_words").collect()
    assert len(got) == len(rows)
    assert sum(len(r["text"] or "") < 5000 for r in got) == len(short)
    for r in got:
        if len(r["text"] or "") < 5000:
            assert tuple(r)[2:] == counts(r["text"]), r["doc_id"]


def test_verdicts(docs, rows):
    out = quality.quality_rules(docs, min_group=10)
    assert out.columns[: len(docs.columns)] == docs.columns
    got = {r["doc_id"]: r for r in out.collect()}
    assert out.count() == len(rows)
    for bad in (103, 104, 105, 110, 111):
        assert got[bad]["_q_base_failed"] and not got[bad]["_q_kept"]
    assert not got[112]["_q_kept"]  # symbols
    clean = [r[0] for r in rows if r[0] and r[0] <= 60 and len(r[1].split()) >= 60]
    assert sum(got[i]["_q_kept"] for i in clean) >= 0.9 * len(clean)


def test_thresholds_by_hand(spark):
    """Quartiles of the sketch, the margin, and the fall back to language and to all rows."""
    data = [("a", "s", i) for i in range(1, 101)] + [("a", "t", 7)] + [("b", "u", 500)]
    df = spark.createDataFrame(data, "lang string, source string, _q_m long")
    cut = quality.thresholds(quality.sketches(df, margins={"m": 1}), min_group=100, margins={"m": 1})
    got = {(r["lang"], r["source"]): r["m"] for r in cut.collect()}
    bucket = lambda v: v >> max(0, v.bit_length() - 6) << max(0, v.bit_length() - 6)
    assert got[("a", "s")] == bucket(75) + 3 * (bucket(75) - bucket(25))
    both = sorted([*range(1, 101), 7])
    q1, q3 = (bucket(next(v for k, v in enumerate(both, 1) if k * 4 >= len(both) * q)) for q in (1, 3))
    assert got[("a", "t")] == q3 + 3 * (q3 - q1)
    assert set(got) == {("a", "s"), ("a", "t"), ("b", "u")}


def test_sketches_merge(spark):
    df = spark.range(1000).selectExpr("'a' as lang", "'s' as source", "id as _q_m")
    whole = quality.sketches(df, margins={"m": 1})
    halves = quality.sketches(df.where("_q_m < 300"), margins={"m": 1}).union(quality.sketches(df.where("_q_m >= 300"), margins={"m": 1}))
    merged = halves.groupBy("lang", "source", "measure", "bucket").sum("n")
    assert sorted(map(tuple, whole.collect())) == sorted(map(tuple, merged.collect()))


def test_empty(empty):
    assert quality.quality_rules(empty).count() == 0


@pytest.mark.parametrize("node", ["Python", "Pandas", "Arrow"])
def test_plan_is_native(docs, node):
    plan = quality.measures(docs)._jdf.queryExecution().executedPlan().toString()
    assert node not in plan
