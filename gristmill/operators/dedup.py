"""First-wins deduplication, exact and near, and benchmark decontamination."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gristmill.functions.text import normalize
from gristmill.operators.minhash import banded, signature, similarity
from gristmill.session import durable


def exact_first(df: DataFrame, text: str, order: str) -> DataFrame:
    """Rows with ``first``, the least ``order`` of the rows with the same normalized text.

    A row is kept by a first-wins scan exactly where ``first = order``.  Only hashes
    and orders are shuffled and combined on the map side; the texts stay.
    """
    keyed = df.withColumn("_k", F.sha2(normalize(F.col(text)), 256))
    firsts = keyed.groupBy("_k").agg(F.min(order).alias("first"))
    return keyed.join(firsts, "_k", "left").drop("_k").withColumn("first", F.coalesce("first", order))


def greedy_first_wins(nodes: DataFrame, edges: DataFrame, key: str) -> DataFrame:
    """``key`` of the rows a first-wins scan keeps when a row is compared with kept rows only.

    Smaller keys come first; ``edges (lo, hi)`` are the similar pairs.  That is the
    lexicographically first maximal independent set, not a component: if a ~ b and
    b ~ c but not a ~ c, both a and c stay.  Each round keeps every open node all
    of whose lower neighbours are dropped, and drops the open nodes with a kept lower
    neighbour; nodes without edges never enter the loop.  Every round is
    written to the shared folder.
    """
    e = durable(edges.where("lo < hi").select("lo", "hi").distinct())
    state = durable(e.select(F.explode(F.array("lo", "hi")).alias("node")).distinct().withColumn("s", F.lit(0)))  # 0 open, 1 kept, 2 dropped
    while state.where("s = 0").take(1):
        lower = state.select(F.col("node").alias("lo"), F.col("s").alias("ls"))
        seen = e.join(lower, "lo").groupBy(F.col("hi").alias("node")).agg(F.max((F.col("ls") == 1).cast("int")).alias("has_kept"), F.max((F.col("ls") == 0).cast("int")).alias("has_open"))
        s = F.when(F.col("s") != 0, F.col("s")).when(F.col("has_kept") == 1, 2).when(F.coalesce("has_open", F.lit(0)) == 0, 1).otherwise(0)
        state = durable(state.join(seen, "node", "left").select("node", s.alias("s")))
    dropped = state.where("s = 2").select(F.col("node").alias(key))
    return nodes.select(key).join(dropped, key, "left_anti")


def signed_texts(benchmark: DataFrame, text: str, family: str = "compat") -> DataFrame:
    """``_b, sig, hash`` of the distinct texts of a benchmark."""
    return benchmark.select(text).distinct().select(F.xxhash64(text).alias("_b"), signature(F.col(text), family).alias("sig"), F.sha2(normalize(F.col(text)), 256).alias("hash"))


def tainted(signed: DataFrame, key: str, theirs: DataFrame, threshold: float = 0.85) -> DataFrame:
    """``key`` of the signed rows (``key, sig, hash``) that equal or are near a signed benchmark text.

    The benchmark side is a held-out set of bounded size; its bands are joined
    by hash, and Spark broadcasts them where they are small.
    """
    exact = signed.join(theirs.select("hash").distinct(), "hash", "left_semi").select(key)
    cand = banded(signed, key).join(banded(theirs, "_b"), ["band", "h"]).select(key, "_b").distinct()
    both = cand.join(signed.select(key, F.col("sig").alias("_x")), key).join(theirs.select("_b", F.col("sig").alias("_y")), "_b")
    near = both.where(similarity(F.col("_x"), F.col("_y")) >= threshold).select(key)
    return exact.unionByName(near).distinct()


def decontaminate(df: DataFrame, key: str, text: str, benchmark: DataFrame, benchmark_text: str, threshold: float = 0.85, family: str = "compat") -> DataFrame:
    """``key`` of the rows whose text equals or is near a benchmark text."""
    ours = durable(df.select(key, signature(F.col(text), family).alias("sig"), F.sha2(normalize(F.col(text)), 256).alias("hash")))
    return tainted(ours, key, durable(signed_texts(benchmark, benchmark_text, family)), threshold)
