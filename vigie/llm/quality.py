"""Quality rules with adaptive thresholds (DataFrame functions only).

Each document gets a few integer measures. Per (lang, source) every measure feeds a mergeable quantile sketch: a
histogram over integer buckets that keep the six leading bits of the value, so counts add up exactly under any merge
order and a quantile is off by at most one part in 32. Thresholds come from these sketches: upper quartile plus
``fence`` times the spread (at least the measure's ``margin``). A group of fewer than ``min_group`` documents borrows
the sketch of its language, and a small language that of all documents; both are sums of the group sketches.

A document is kept when the fixed base rule passes and no measure is above its group's threshold.

Null or empty text: no words, base rule fails. Null ``lang`` or ``source``: a group of its own (null-safe join).
Repeated rows are judged one by one. Extra columns pass through; one that has the name of an appended column is replaced by it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vigie.llm.common import SPACE_CHARS, SPACE_CLASS, stored

#: Measure (parts per thousand) and the least spread assumed for it.
MARGINS = {"symbol_rate": 100, "upper_rate": 100, "dup_line_rate": 200, "repeat_rate": 150}
FENCE = 3
MIN_GROUP = 200
BASE_MIN_WORDS = 50


def measures(df: DataFrame, text: str = "text", prefix: str = "_q_") -> DataFrame:
    """Append the measures to ``df`` as ``prefix`` + name; every other column stays as it is."""
    p, w, ln = prefix, f"{prefix}words_of_text", f"{prefix}lines_of_text"
    df = df.drop(w, ln)
    trimmed = F.coalesce(F.btrim(F.col(text), F.lit(SPACE_CHARS)), F.lit(""))
    words = F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, SPACE_CLASS + "+"))
    lines = F.filter(F.split(F.coalesce(F.col(text), F.lit("")), "\n"), lambda x: F.btrim(x, F.lit(SPACE_CHARS)) != "")
    out = df.withColumn(w, words).withColumn(ln, lines)
    joined = F.array_join(w, "")
    out = out.withColumns(
        {
            f"{p}n_words": F.size(w).cast("long"),
            f"{p}word_chars": F.length(joined).cast("long"),
            f"{p}n_symbols": F.regexp_count(joined, F.lit(r"[#*$%&|<>]")).cast("long"),
            f"{p}n_upper": F.regexp_count(joined, F.lit(r"\p{Lu}")).cast("long"),
            f"{p}n_lines": F.size(ln).cast("long"),
            f"{p}n_dup_lines": (F.size(ln) - F.size(F.array_distinct(ln))).cast("long"),
            f"{p}n_repeat_words": _repeat_words(w),
        }
    ).drop(w, ln)
    rate = lambda part, whole: F.coalesce(F.expr(f"try_divide({p}{part} * 1000, {p}{whole})").cast("long"), F.lit(0).cast("long"))
    return out.withColumns(
        {
            f"{p}symbol_rate": rate("n_symbols", "n_words"),
            f"{p}upper_rate": rate("n_upper", "word_chars"),
            f"{p}dup_line_rate": rate("n_dup_lines", "n_lines"),
            f"{p}repeat_rate": rate("n_repeat_words", "n_words"),
        }
    )


def _repeat_words(words: str) -> Column:
    """Words inside 3-word windows that occur at least twice.

    Windows are sorted by a 64-bit hash and their place; equal neighbours are compared word by word, so a hash
    collision marks nothing. Places that are marked cover up to three words each.
    """
    w = f"`{words}`"
    return F.expr(
        f"""
        CASE WHEN size({w}) < 4 THEN 0L ELSE
        transform(array(sort_array(transform(sequence(0, size({w}) - 3),
            i -> struct(xxhash64({w}[i], {w}[i + 1], {w}[i + 2]) AS h, i AS p)))), s ->
          aggregate(
            sort_array(transform(filter(s, (x, k) ->
                 (k > 0 AND s[greatest(k, 1) - 1].h = x.h
                  AND {w}[s[greatest(k, 1) - 1].p] = {w}[x.p] AND {w}[s[greatest(k, 1) - 1].p + 1] = {w}[x.p + 1]
                  AND {w}[s[greatest(k, 1) - 1].p + 2] = {w}[x.p + 2])
              OR (k + 1 < size(s) AND s[least(k + 1, size(s) - 1)].h = x.h
                  AND {w}[s[least(k + 1, size(s) - 1)].p] = {w}[x.p] AND {w}[s[least(k + 1, size(s) - 1)].p + 1] = {w}[x.p + 1]
                  AND {w}[s[least(k + 1, size(s) - 1)].p + 2] = {w}[x.p + 2])), x -> x.p)),
            struct(0L AS n, -3 AS last),
            (a, q) -> struct(a.n + least(3, q - a.last) AS n, q AS last),
            a -> a.n))[0] END"""
    )


def _bucket(value: Column) -> Column:
    """The value with all but its six leading bits cleared."""
    shift = F.greatest(F.length(F.bin(value)) - 6, F.lit(0))
    return F.call_function("shiftleft", F.call_function("shiftright", value, shift), shift)


def sketches(df: DataFrame, group: tuple[str, ...] = ("lang", "source"), prefix: str = "_q_", margins: dict | None = None) -> DataFrame:
    """Histogram sketches: one row per group, measure and bucket with its count. Union and sum merges two of them."""
    names = list(margins or MARGINS)
    packed = F.array(*[F.struct(F.lit(n).alias("measure"), F.col(prefix + n).alias("value")) for n in names])
    rows = df.select(*group, F.explode(packed).alias("m"))
    return rows.groupBy(*group, F.col("m.measure").alias("measure"), _bucket(F.col("m.value")).alias("bucket")).agg(F.count("*").alias("n"))


def thresholds(sketch: DataFrame, group: tuple[str, ...] = ("lang", "source"), fence: int = FENCE, min_group: int = MIN_GROUP, margins: dict | None = None) -> DataFrame:
    """One row per group with the largest accepted value of every measure."""
    margins = margins or MARGINS
    lang, source = group
    levels = [sketch.select(*group, "measure", "bucket", "n", F.lit(0).alias("level"))]
    levels.append(sketch.groupBy(lang, "measure", "bucket").agg(F.sum("n").alias("n")).selectExpr(f"`{lang}`", f"cast(null as string) as `{source}`", "measure", "bucket", "n", "1 as level"))
    levels.append(sketch.groupBy("measure", "bucket").agg(F.sum("n").alias("n")).selectExpr(f"cast(null as string) as `{lang}`", f"cast(null as string) as `{source}`", "measure", "bucket", "n", "2 as level"))
    allof = levels[0].unionByName(levels[1]).unionByName(levels[2])
    # a sketch has at most some hundred buckets a measure, so sorting the buckets of one group is bounded
    hist = allof.groupBy("level", lang, source, "measure").agg(F.sum("n").alias("total"), F.sort_array(F.collect_list(F.struct("bucket", "n"))).alias("h"))
    quant = lambda q: F.expr(
        f"aggregate(h, struct(0L AS seen, cast(null as bigint) AS v), (a, x) -> struct(a.seen + x.n AS seen, "
        f"CASE WHEN a.v IS NULL AND (a.seen + x.n) * 4 >= total * {q} THEN x.bucket ELSE a.v END AS v), a -> a.v)"
    )
    margin = F.coalesce(*[F.when(F.col("measure") == k, F.lit(v)) for k, v in margins.items()])
    cut = hist.select("level", lang, source, "measure", "total", quant(1).alias("q1"), quant(3).alias("q3")).withColumn(
        "cut", F.col("q3") + F.lit(fence) * F.greatest(F.col("q3") - F.col("q1"), margin)
    )
    wide = cut.groupBy("level", lang, source, F.lit(1).alias("one")).agg(F.max("total").alias("total"), *[F.max(F.when(F.col("measure") == k, F.col("cut"))).alias(k) for k in margins])
    own, by_lang, glob = (wide.where(F.col("level") == i).drop("level") for i in range(3))
    pick = lambda k: F.when(F.col("o.total") >= min_group, F.col(f"o.{k}")).when(F.col("l.total") >= min_group, F.col(f"l.{k}")).otherwise(F.col(f"g.{k}"))
    return (
        own.alias("o")
        .join(by_lang.alias("l"), F.col(f"o.{lang}").eqNullSafe(F.col(f"l.{lang}")), "left")
        .join(glob.alias("g"), F.col("o.one") == F.col("g.one"), "left")
        .select(F.col(f"o.{lang}"), F.col(f"o.{source}"), *[pick(k).alias(k) for k in margins])
    )


def judged(measured: DataFrame, cuts: DataFrame, group: tuple[str, ...] = ("lang", "source"), prefix: str = "_q_", margins: dict | None = None) -> DataFrame:
    """Append ``base_failed`` and ``kept`` (with ``prefix``) by joining each row with the thresholds of its group."""
    p = prefix
    renamed = cuts.select(*[F.col(c).alias(f"{p}cut_{c}") for c in cuts.columns])
    cond = F.lit(True)
    for g in group:
        cond = cond & F.col(g).eqNullSafe(F.col(f"{p}cut_{g}"))
    out = measured.join(renamed, cond, "left")
    base = (F.col(f"{p}n_words") < BASE_MIN_WORDS) | (100 * F.col(f"{p}n_repeat_words") > 50 * F.col(f"{p}n_words"))
    good = F.lit(True)
    for k in margins or MARGINS:
        good = good & (F.col(p + k) <= F.col(f"{p}cut_{k}"))
    return out.withColumn(f"{p}base_failed", base).withColumn(f"{p}kept", ~base & F.coalesce(good, F.lit(True))).drop(*renamed.columns)


def quality_rules(df: DataFrame, text: str = "text", group: tuple[str, str] = ("lang", "source"), prefix: str = "_q_", **limits) -> DataFrame:
    """``df`` with measures, ``base_failed`` and ``kept`` appended (names start with ``prefix``).

    The measured rows are written to the shared folder once; sketches and verdicts read that copy.
    """
    measured = stored(measures(df, text, prefix), "quality")
    cuts = stored(thresholds(sketches(measured, group, prefix), group, **limits), "cuts")
    return judged(measured, cuts, group, prefix)
