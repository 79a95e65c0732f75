"""The pipeline, and each stage of it, against plain Python over the same rows."""

import importlib.util
import os
import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from test_jaccard import brute as near_groups
from test_lines import brute as line_brute
from test_quality import counts
from vigie.llm import quality
from vigie.llm.common import stored, tokenizer_path

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def rows_of(df):
    return sorted((tuple(r) for r in df.select(*COLUMNS).collect()), key=str)


def test_stages_in_order():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_rules", "language_id", "line_dedup", "jaccard_join", "best_fit_packing"]


def expected_cuts(rows):
    """Tukey fences from six-bit buckets, by hand."""
    bucket = lambda v: v >> max(0, v.bit_length() - 6) << max(0, v.bit_length() - 6)
    rates, groups = [], {}
    for _, text, lang, source, _ in rows:
        n, chars, symbols, dup, repeat = counts(text)
        n_lines = len([x for x in (text or "").split("\n") if x.strip(" \t\n\x0b\x0c\r")])
        upper = sum(c.isupper() for w in (text or "").split() for c in w)
        rate = lambda a, b: a * 1000 // b if b else 0
        own = {"symbol_rate": rate(symbols, n), "upper_rate": rate(upper, chars), "dup_line_rate": rate(dup, n_lines), "repeat_rate": rate(repeat, n)}
        rates.append((n, repeat, own, lang, source))
        for level in ((lang, source), (lang,), ()):
            groups.setdefault((len(level), level), []).append(own)

    def cut(level, name):
        values = sorted(bucket(o[name]) for o in groups[level])
        q = lambda k: next(v for i, v in enumerate(values, 1) if i * 4 >= len(values) * k)
        return q(3) + quality.FENCE * max(q(3) - q(1), quality.MARGINS[name])

    keep = []
    for n, repeat, own, lang, source in rates:
        level = next((k for k in ((2, (lang, source)), (1, (lang,))) if len(groups[k]) >= quality.MIN_GROUP), (0, ()))
        failed = n < 50 or 100 * repeat > 50 * n
        keep.append(not failed and all(own[k] <= cut(level, k) for k in own))
    return keep


@pytest.fixture(scope="module")
def run(spark, small_dir):
    """Every stage's input and output."""
    docs, out = spark.read.parquet(f"{small_dir}/documents.parquet"), []
    for name, stage in corpus_pipeline.STAGES:
        after = stored(stage(spark, docs, small_dir), name)
        out.append((docs, after))
        docs = after
    return out


def test_quality_stage(run):
    before, after = run[0]
    rows = [tuple(r) for r in before.select(*COLUMNS).collect()]
    assert rows_of(after) == sorted((r for r, k in zip(rows, expected_cuts(rows)) if k), key=str)
    assert after.columns == before.columns


def test_language_stage(run):
    before, after = run[1]
    assert after.columns == before.columns
    assert rows_of(after) == [r for r in rows_of(before) if any(c.isalpha() for c in r[1])]


def test_line_stage(run):
    before, after = run[2]
    want = {i: (n, t) for i, _, n, t in line_brute([(r["doc_id"], r["text"]) for r in before.collect()])}
    old = {r["doc_id"]: r for r in before.collect()}
    for r in after.collect():
        n, t = want[r["doc_id"]]
        assert r["text"] == t
        assert r["n_chars"] == (len(t) if n else old[r["doc_id"]]["n_chars"])
    assert after.count() == before.count()


def test_near_copy_stage(run):
    before, after = run[3]
    groups = near_groups([(r["doc_id"], r["text"]) for r in before.collect()])
    assert {r["doc_id"] for r in after.collect()} == {i for i, _, c in groups if i == c}


def test_packing_stage_and_run(spark, run, small_dir):
    before, after = run[4]
    library = Tokenizer.from_file(tokenizer_path())
    want = []
    for r in before.collect():
        ids = np.array(library.encode(r["text"], add_special_tokens=False).ids + [1], "<u4")
        want += [(r["doc_id"], k, at, len(ids[at : at + 4096]), zlib.crc32(ids[at : at + 4096].tobytes())) for k, at in enumerate(range(0, len(ids), 4096))]
    own = ["doc_id", "piece", "start", "length", "ids_crc32"]
    assert sorted(tuple(r) for r in after.select(*own).collect()) == sorted(want)
    whole = corpus_pipeline.run(spark, small_dir)
    assert sorted(tuple(r) for r in whole.select(*own).collect()) == sorted(want)


def test_stages_take_awkward_tables(spark, docs, empty, small_dir):
    """Nulls in any column, an empty table, extra columns with the names operators use, no error."""
    for table in (docs, empty, docs.drop("lang").selectExpr("*", "cast(null as string) as lang")):
        for _, stage in corpus_pipeline.STAGES:
            out = stage(spark, table, small_dir)
            n = out.count()
            assert n <= 3 * table.count()
            if stage is not corpus_pipeline.packing_stage:
                assert out.columns == table.columns


def test_entry_without_the_subpackage(tmp_path):
    """The entry module imports and lists the other queries when this subpackage is gone."""
    import shutil
    import subprocess
    import sys

    root = os.path.dirname(os.path.abspath(corpus_pipeline.__file__))
    shutil.copy(os.path.join(root, "__spark_entry__.py"), tmp_path)
    shutil.copytree(os.path.join(root, "vigie"), tmp_path / "vigie", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    code = "import __spark_entry__ as e; q = e.queries(); assert q and not any(n.startswith('op') or n == 'pipeline' for n in q); print(len(q))"
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env={k: v for k, v in os.environ.items() if k != "PYTHONPATH"}, capture_output=True, text=True)
    assert done.returncode == 0, done.stderr
    assert importlib.util.find_spec("vigie.llm")
