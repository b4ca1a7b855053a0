"""Acceptance of candidates: an ordered scan with a length limit, benchmark, duplicates and quotas."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gristmill.functions.messages import role_text
from gristmill.functions.text import normalize
from gristmill.operators.dedup import greedy_first_wins, signed_texts, tainted
from gristmill.operators.minhash import signature, similar_pairs
from gristmill.operators.stats import first_reason
from gristmill.session import durable


def accept(candidates: DataFrame, benchmark: DataFrame, benchmark_text: str, max_tokens: int, requested: int | dict[int, int | None] | None, threshold: float = 0.85, family: str = "compat") -> DataFrame:
    """Candidates with ``rank`` (bigint, unique, ascending), judged as a first-wins scan would.

    Adds ``reason``: null for an accepted row, else ``too_long``,
    ``benchmark_overlap`` or ``duplicate``, the first that applies.  A row is a
    duplicate only of an accepted row.  With ``requested``, rows after the one that
    fills it are not judged and not returned.  Candidates of several sources have
    an ascending ``source_no`` beside the rank, and ``requested`` is a mapping from it,
    None for a source without end; rows past a source's end block no later row.

    All texts are signed once, and their links found once, whatever the number of
    sources; a source that reaches its end costs one more pass over the links.
    """
    ends = requested if isinstance(requested, dict) else {0: requested}
    if isinstance(requested, int) and requested <= 0:
        return candidates.limit(0).withColumn("reason", F.lit(None).cast("string"))
    none = [k for k, n in ends.items() if n is not None and n <= 0]
    c = candidates if isinstance(requested, dict) else candidates.withColumn("source_no", F.lit(0))
    c = c.where(~F.col("source_no").isin(none)) if none else c
    user, every = role_text(F.col("messages"), ["user"]), role_text(F.col("messages"), ["user", "assistant"])
    short = c.where(F.col("token_count") <= max_tokens)
    signed = durable(short.select("rank", "source_no", signature(user, family).alias("user_sig"), F.sha2(normalize(user), 256).alias("user_hash"), signature(every, family).alias("sig"), F.sha2(normalize(every), 256).alias("hash")))
    theirs = durable(signed_texts(benchmark, benchmark_text, family))
    bad = durable(tainted(signed.select("rank", F.col("user_sig").alias("sig"), F.col("user_hash").alias("hash")), "rank", theirs, threshold))
    clean = durable(signed.join(bad, "rank", "left_anti").select("rank", "source_no", "sig"))
    pairs = durable(similar_pairs(clean, "rank", threshold).select("lo", "hi"))
    last: dict[int, int] = {}
    while True:
        cut = F.lit(False)
        for k, rank in last.items():
            cut = cut | ((F.col("source_no") == k) & (F.col("rank") > rank))
        open_ = clean.where(~cut)
        gone = clean.where(cut).select("rank")
        links = pairs if not last else pairs.join(gone.withColumnRenamed("rank", "lo"), "lo", "left_anti").join(gone.withColumnRenamed("rank", "hi"), "hi", "left_anti")
        kept = durable(greedy_first_wins(open_, links, "rank").join(open_.select("rank", "source_no"), "rank"))
        counts = {r["source_no"]: r["n"] for r in kept.groupBy("source_no").agg(F.count("*").alias("n")).collect()}  # a row for each source
        full = next((k for k in sorted(ends) if ends[k] is not None and k not in last and counts.get(k, 0) >= ends[k] > 0), None)
        if full is None:
            break
        last[full] = kept.where(F.col("source_no") == full).select("rank").orderBy("rank").limit(ends[full]).agg(F.max("rank")).first()[0]
        if counts[full] == ends[full] and not any(k > full for k in ends):
            break
    flags = c.join(bad.withColumn("_t", F.lit(True)), "rank", "left").join(kept.select("rank", F.lit(True).alias("_k")), "rank", "left")
    reason = first_reason(too_long=F.col("token_count") > max_tokens, benchmark_overlap=F.col("_t"), duplicate=F.col("_k").isNull())
    judged = flags.withColumn("reason", reason).drop("_t", "_k")
    for k, rank in last.items():
        judged = judged.where((F.col("source_no") != k) | (F.col("rank") <= rank))
    return judged if isinstance(requested, dict) else judged.drop("source_no")
