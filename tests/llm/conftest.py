"""Small fixtures with the awkward cases every operator has to take."""

import random

import pytest

SMALL = "/root/testdata/sf0.001"
#: Names that operators use inside; a caller's table may have them too.
CLASHING = ["key", "n", "part", "block", "shard", "size", "items", "token", "words", "bin", "node", "done", "label", "ids", "score", "_q_words", "_lang_pred"]


def prose(rng: random.Random, n: int, lang: str = "en") -> str:
    parts = {"en": "th er ing on ed and re ly".split(), "de": "sch ung ö ich en ver ü keit".split(), "fr": "eau é que ment è tion ai ou".split()}[lang]
    words = ["".join(rng.choice(parts) for _ in range(rng.randint(1, 4))) for _ in range(n)]
    lines = [" ".join(words[i : i + 20]) for i in range(0, n, 20)]
    return "\n".join(lines)


def make_rows() -> list[tuple]:
    rng = random.Random(5)
    rows = []
    for i in range(1, 61):
        lang = ["en", "de", "fr"][i % 3]
        rows.append((i, prose(rng, rng.randint(30, 200), lang), lang, f"src{i % 2}"))
    base = rows[0][1]
    words = base.split(" ")
    rows += [
        (101, base, "en", "src0"),  # exact copy
        (102, " ".join(words[:3] + ["changed"] + words[4:]), "en", "src0"),  # near copy
        (103, None, "en", "src0"),
        (104, "", "en", None),
        (105, " \t\n\x0b\x0c\r ", None, "src1"),
        (106, "12 34 !? 56", "de", "src1"),
        (107, "word", "fr", "src1"),
        (108, "A b c d", "en", "src1"),
        (109, "All rights reserved.\nLicensed under CC BY-NC 4.0.\nReleased under the MIT License.", "en", "src0"),
        (110, ("the same line of words again and again\n" * 40).strip(), "en", "src0"),
        (111, " ".join(["loop"] * 300), "en", "src1"),
        (112, "*** ### $$$ " * 60, "de", "src0"),
        (113, prose(rng, 6000, "en"), "en", "src0"),  # very long
        (114, "日本語 テキスト <|endoftext|> Ünï ÀÉ 'S we'll 3rd İΣ", "fr", "src0"),
        (115, "x" * 30000, "en", "src0"),  # one very long word
        (None, "a row without an id but with enough words to hold some shingles", "en", "src0"),
        (None, None, None, None),
    ]
    rows += [rows[1], rows[1]]  # repeated rows
    return rows


@pytest.fixture(scope="session")
def rows():
    return make_rows()


@pytest.fixture(scope="session")
def docs(spark, rows):
    """The rows as a table with extra columns of clashing names; stored, as operators read their input more than once."""
    import pyspark.sql.functions as F

    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").repartition(3)
    for c in CLASHING:
        df = df.withColumn(c, F.lit("x"))
    return df.cache()


@pytest.fixture(scope="session")
def empty(docs):
    return docs.limit(0)


@pytest.fixture(scope="session")
def small_dir(spark, rows, tmp_path_factory):
    """A folder with ``documents`` and ``labels`` as the registered queries read them."""
    path = tmp_path_factory.mktemp("tables")
    own = [r for r in rows if r[0] is not None]
    seen = {r[0]: r for r in own}
    spark.createDataFrame(list(seen.values()), "doc_id long, text string, lang string, source string").selectExpr("*", "cast(length(text) as bigint) as n_chars").write.parquet(f"{path}/documents.parquet")
    return str(path)
