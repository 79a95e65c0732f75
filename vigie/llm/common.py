"""Helpers shared by the operators: table access, shared-folder tables, connected components."""

from __future__ import annotations

import gc
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vigie.session import ensure_checkpoint_dir
from vigie.sources.tables import read_table

#: White space of the word rules, as a Java character class and as the characters themselves.
SPACE_CLASS = r"[\x20\x09-\x0D]"
SPACE_CHARS = " \t\n\x0b\x0c\r"

#: Stands for a null id inside an operator; it sorts after every other id.
NULL_ID = 2**63 - 1


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "documents")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet under ``spark.checkpoint.dir`` and read it back: lineage ends, executors may be lost."""
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/vigie-llm/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def forgotten(spark: SparkSession) -> None:
    """Have the shuffle files of results that nothing refers to any more deleted: Spark does so only after a collection in the
    driver, which the few objects of a loop of large shuffles may not bring about for long."""
    gc.collect()  # plans are held by Python objects, some of them in cycles
    for _ in range(2):
        spark.sparkContext._jvm.System.gc()


def shielded(df: DataFrame, used: tuple[str, ...]) -> tuple[DataFrame, list[str]]:
    """``df`` with all columns but ``used`` renamed to names no operator uses, and the renamed columns in order.

    ``result.select(*names).toDF(*df.columns)`` brings the names back.
    """
    names = [c if c in used else f"_other_{i}_" for i, c in enumerate(df.columns)]
    return df.toDF(*names), names


def crc_mod(col: str, modulus: int):
    return F.pmod(F.crc32(F.col(col).cast("string").cast("binary")), F.lit(modulus))


def components(edges: DataFrame, name: str = "cc", max_rounds: int = 60) -> DataFrame:
    """Connected components of ``edges(a, b)`` as ``(node, component)`` with the smallest reachable node.

    Alternating large-star and small-star rounds, each written to the shared folder. Isolated nodes do not appear. Hub
    nodes are safe: a star round only needs ``min`` per node, which is combined before the shuffle, and the join with these
    (a stored table, so it has an exchange of its own on either side) is one that Spark may split.
    """
    cur = stored(edges.where("a <> b").selectExpr("greatest(a, b) as u", "least(a, b) as v").distinct(), name)
    last = None
    for _ in range(max_rounds):
        # large star: every larger neighbour of a node is tied to the smallest of its neighbourhood
        both = cur.union(cur.selectExpr("v as u", "u as v"))
        low = stored(both.groupBy("u").agg(F.min("v").alias("m")).selectExpr("u", "least(u, m) as m"), name)
        large = both.where("v > u").join(low, "u").selectExpr("v as u", "m as v")
        large = stored(large.distinct(), name)
        # small star: a node and its smaller neighbours are tied to the smallest of these
        low = stored(large.groupBy("u").agg(F.min("v").alias("m")), name)
        small = large.join(low, "u").selectExpr("v as u", "m as v").where("u <> v").union(low.selectExpr("u", "m as v"))
        cur = stored(small.distinct(), name)
        state = cur.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if tuple(state) == last:
            break
        last = tuple(state)
    else:
        raise RuntimeError("components did not settle")
    return cur.selectExpr("u as node", "v as component").union(cur.selectExpr("v as node", "v as component").distinct())


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    """Where the installed vocabulary file lies; every worker has the same package."""
    import public_tokenizers

    return public_tokenizers.path(name)
