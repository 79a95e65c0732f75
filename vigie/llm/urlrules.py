"""URL filtering with explicit rules and mined association rules (DataFrame functions and Spark's FP-growth only).

Explicit rules name a host and a path: a rule fits its host and all subdomains if the path starts with the rule's, and
the longest fitting rule decides. For every other url, mined rules decide. They are learned from labelled urls: each is a
basket of tokens (scheme, host labels, path words, query keys, fragment, ending) plus its label; FP-growth finds the
frequent baskets, and a rule "tokens -> label" stays when its support, confidence and lift are high enough and no
shorter rule with the same label is as confident. Matching goes through an inverted index token -> rules: a rule fires
for a url that holds all its tokens. The most confident rule decides (then support, then ``block``); no rule: ``allow``.

Baskets are pruned first: tokens outside ``[min_support, MAX_SUPPORT]`` cannot help and are left out, so hot tokens
(``https``, ``com``) do not multiply the baskets.

Null urls and urls without ``://`` have empty host and path, no tokens and verdict ``allow``. Repeated rows are judged one
by one. With no labels (or an empty table) no rules are mined. Extra columns are ignored.
"""

from __future__ import annotations

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vigie.llm.common import stored

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
MIN_SUPPORT = 0.01
MAX_SUPPORT = 0.9
MIN_CONFIDENCE = 0.8
MIN_LIFT = 1.1
LABEL = "label="


def with_parts(df: DataFrame, url: str = "url") -> DataFrame:
    """``df`` plus ``_host`` and ``_path``."""
    at = F.instr(F.col(url), "://")
    rest = F.when(at > 0, F.expr(f"substring(`{url}`, instr(`{url}`, '://') + 3)")).otherwise(F.lit(""))
    df = df.withColumn("_rest", F.coalesce(rest, F.lit("")))
    df = df.withColumn("_raw", F.regexp_extract("_rest", r"^[^/?#]*", 0))
    df = df.withColumn("_tail", F.expr("substring(_rest, length(_raw) + 1)"))
    return df.withColumns({"_host": F.translate("_raw", UPPER, LOWER), "_path": F.regexp_extract("_tail", r"^[^?#]*", 0)}).drop("_rest", "_raw", "_tail")


def explicit(rules: list[tuple[str, str, str]]) -> tuple[Column, Column]:
    """Columns ``rule`` and ``verdict`` over ``_host`` and ``_path`` for ``(verdict, host, path)`` rules; null: none fits."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for says, host, path in sorted(rules, key=lambda r: len(r[1] + r[2])):  # the longest is tested first
        fits = ((F.col("_host") == host) | F.col("_host").endswith("." + host)) & F.col("_path").startswith(path)
        name = F.when(fits, F.lit(host + path)).otherwise(name)
        verdict = F.when(fits, F.lit(says)).otherwise(verdict)
    return name, verdict


def tokens(url: str = "url") -> Column:
    """The distinct tokens of a url with ``_host`` and ``_path``; numbers are one token."""
    u = F.col(url)
    tag = lambda name, parts: F.transform(F.filter(parts, lambda x: x != ""), lambda x: F.concat(F.lit(name), x))
    words = F.split(F.regexp_replace(F.lower("_path"), r"[0-9]+", "0"), r"[/._-]+")
    query = F.regexp_extract(u, r"^[^#?]*\?([^#]*)", 1)
    keys = F.transform(F.split(query, "&"), lambda x: F.substring_index(x, "=", 1))
    ending = F.regexp_extract("_path", r"\.([A-Za-z0-9]{1,5})$", 1)
    anchor = F.when(F.instr(u, "#") > 0, F.lit("yes")).otherwise(F.lit(""))
    both = F.concat(
        tag("scheme=", F.array(F.lower(F.substring_index(u, "://", 1)))),
        tag("host=", F.array(F.col("_host"))),
        tag("part=", F.split("_host", r"\.")),
        tag("word=", words),
        tag("key=", keys),
        tag("end=", F.array(ending)),
        tag("anchor=", F.array(anchor)),
    )
    return F.when(F.col("_host") == "", F.array().cast("array<string>")).otherwise(F.array_distinct(both))


def mine(labelled: DataFrame, min_support: float = MIN_SUPPORT, min_confidence: float = MIN_CONFIDENCE, min_lift: float = MIN_LIFT) -> DataFrame:
    """``(rule_id, antecedent, verdict, confidence, support)`` from ``labelled(tokens, label)``."""
    schema = "rule_id long, antecedent array<string>, verdict string, confidence double, support double"
    spark = labelled.sparkSession
    labelled = stored(labelled.where("label is not null").select("tokens", "label"), "labelled")
    n = labelled.count()
    if not n:
        return spark.createDataFrame([], schema)
    share = F.count("*") / F.lit(n)
    useful = labelled.select(F.explode("tokens").alias("token")).groupBy("token").agg(share.alias("share")).where(F.col("share").between(min_support, MAX_SUPPORT))
    # a token that stays is in a share of all urls, so these are at most (tokens a url) / min_support
    useful = F.array(*[F.lit(r["token"]) for r in useful.orderBy("token").collect()]).cast("array<string>")
    baskets = labelled.select(F.concat(F.array_intersect("tokens", useful), F.array(F.concat(F.lit(LABEL), "label"))).alias("items"))
    model = FPGrowth(itemsCol="items", minSupport=min_support, minConfidence=min_confidence).fit(baskets)
    rules = model.associationRules.where(F.col("consequent")[0].startswith(LABEL) & (F.col("lift") >= min_lift))
    rules = rules.select(F.array_sort("antecedent").alias("antecedent"), F.expr(f"substring(consequent[0], {len(LABEL) + 1})").alias("verdict"), "confidence", "support")
    rules = stored(rules.where(~F.exists("antecedent", lambda x: x.startswith(LABEL))), "rules")
    # a longer rule has to be more confident than every shorter one it contains; they share their first index token's rows
    short = rules.select(F.col("antecedent").alias("less"), F.col("verdict").alias("says"), F.col("confidence").alias("sure"), F.explode("antecedent").alias("by"))
    long = rules.select("antecedent", "verdict", "confidence", F.explode("antecedent").alias("by"))
    beaten = long.join(short, "by").where("verdict = says AND size(less) < size(antecedent) AND sure >= confidence AND size(array_except(less, antecedent)) = 0")
    kept = rules.join(beaten.select("antecedent", "verdict").distinct(), ["antecedent", "verdict"], "left_anti")
    return kept.select(F.xxhash64("antecedent", "verdict").alias("rule_id"), "antecedent", "verdict", "confidence", "support")


def fired(rows: DataFrame, rules: DataFrame) -> DataFrame:
    """``(rid, verdict)`` of the mined rule that decides each of ``rows(rid, tokens)``; rows without one are left out."""
    index = rules.select("rule_id", F.size("antecedent").alias("needs"), "verdict", "confidence", "support", F.explode("antecedent").alias("token"))
    hits = rows.select("rid", F.explode("tokens").alias("token")).join(index, "token")
    full = hits.groupBy("rid", "rule_id", "needs", "verdict", "confidence", "support").agg(F.count("*").alias("n")).where("n = needs")
    return full.groupBy("rid").agg(F.max(F.struct("confidence", "support", "verdict")).alias("best")).selectExpr("rid", "best.verdict as verdict")


def url_filter(pages: DataFrame, labels: DataFrame, rules: list[tuple[str, str, str]], page_id: str = "page_id", url: str = "url", **limits) -> DataFrame:
    """``(page_id, host, path, rule, verdict)`` for every row of ``pages``; ``labels(page_id, label)`` has allow or block."""
    name, says = explicit(rules)
    parts = with_parts(pages.select(F.col(page_id).alias("page_id"), F.col(url).alias("url")))
    rows = parts.select("page_id", "_host", "_path", name.alias("rule"), says.alias("says"), tokens("url").alias("tokens"))
    rows = stored(rows.withColumn("rid", F.monotonically_increasing_id()), "urls")  # numbered once, then read
    mined = stored(mine(rows.join(labels, "page_id").select("tokens", "label"), **limits), "rules")
    open_rows = rows.where("says is null")
    out = rows.join(fired(open_rows, mined).withColumnRenamed("verdict", "mined"), "rid", "left")
    return out.select("page_id", F.col("_host").alias("host"), F.col("_path").alias("path"), "rule", F.coalesce("says", "mined", F.lit("allow")).alias("verdict"))
