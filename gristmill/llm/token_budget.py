"""Problem 1: a token budget for each source, language and domain."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gristmill.llm.common import clean_language, example_key, latest_copy, slug
from gristmill.llm.vocab import Vocab, cut_texts, message_tokens, text_tokens
from gristmill.session import durable

#: What an example costs for each of its messages, beside their tokens.
TOKENS_PER_MESSAGE = 4


def message_lengths(examples: DataFrame, vocab: Vocab, keep: list[str], cut_chars: int = 1 << 18) -> DataFrame:
    """Exact token count of every message of every distinct example.

    Columns: ``key`` (see :func:`example_key`), the columns ``keep``,
    ``msg_tokens`` (array<int>, one entry for each message) and ``roles``.

    Messages of up to ``cut_chars`` characters are counted where they are
    scanned; their text is never shuffled.  A longer one is cut at boundaries
    that no token can cross, its parts are salted across all workers, and the
    exact counts of the parts are summed.  Repeated deliveries of an id are one
    example.  Null messages count as an empty list, null content as empty text,
    a row without id is known by the hash of its messages; an empty table gives
    an empty result.
    """
    scan = examples.select(
        example_key().alias("key"), *keep, "loaded_at",
        message_tokens(F.col("messages"), vocab, cut_chars).alias("msg_tokens"),
        F.transform("messages", lambda m: m.role).alias("roles"),
    )
    counted = durable(latest_copy(scan, "key", ["loaded_at"]))
    long = counted.where(F.array_contains("msg_tokens", -1)).select("key")
    if not long.take(1):
        return counted
    parts = (
        examples.where(F.exists("messages", lambda m: F.length(m.content) > cut_chars))
        .select(example_key().alias("key"), "messages", "loaded_at")
    )
    parts = (
        parts.select("key", "loaded_at", F.posexplode("messages").alias("at", "m"))
        .where(F.length("m.content") > cut_chars)
        .select("key", "loaded_at", "at", F.posexplode(cut_texts(F.col("m.content"), vocab, cut_chars)).alias("salt", "part"))
    )
    parts = (
        parts.repartition("key", "at", "salt")
        .select("key", "loaded_at", "at", text_tokens(F.col("part"), vocab).cast("long").alias("n"))
        .groupBy("key", "loaded_at", "at").agg(F.sum("n").cast("int").alias("n"))
        .groupBy("key", "at").agg(F.max_by("n", F.struct("loaded_at", "n")).alias("n"))
        .groupBy("key").agg(F.map_from_entries(F.collect_list(F.struct("at", "n"))).alias("sums"))
    )
    whole = F.transform("msg_tokens", lambda x, i: F.when(x >= 0, x).otherwise(F.col("sums")[i]))
    return durable(counted.join(parts, "key", "left").withColumn("msg_tokens", whole).drop("sums"))


def true_length(lengths: DataFrame) -> DataFrame:
    """Add ``tokens``: the sum over the messages plus ``TOKENS_PER_MESSAGE`` for each."""
    total = F.aggregate("msg_tokens", F.lit(0).cast("long"), lambda a, x: a + x + TOKENS_PER_MESSAGE)
    return lengths.withColumn("tokens", F.coalesce(total, F.lit(0).cast("long")))


def corrected_counts(examples: DataFrame, vocab: Vocab) -> DataFrame:
    """``key, id, token_count, tokens, source, language, domain`` for each distinct example."""
    cleaned = examples.select(
        "id", "messages", "loaded_at", "token_count",
        F.coalesce(slug(F.col("source")), F.lit("unknown")).alias("source"),
        clean_language(F.col("language")).alias("language"),
        F.coalesce(slug(F.col("metadata.domain")), F.lit("unknown")).alias("domain"),
    )
    got = true_length(message_lengths(cleaned, vocab, ["id", "token_count", "source", "language", "domain"]))
    return got.select("key", "id", "token_count", "tokens", "source", "language", "domain")


def wrong_counts(counts: DataFrame, tolerance: float = 0.1) -> DataFrame:
    """Ids whose recorded count is null or off by more than ``tolerance`` of the true length."""
    off = F.abs(F.col("token_count") - F.col("tokens")) > F.col("tokens") * tolerance
    return counts.where(F.col("id").isNotNull() & (F.col("token_count").isNull() | off)).select("id")


def token_budget(counts: DataFrame) -> DataFrame:
    """Examples and tokens by source, language and domain, and by each of them alone.

    A level that is summed away holds ``*``.  Rows are pre-aggregated before
    the shuffle, so a source with a third of all rows sends a handful of rows
    for each task.
    """
    fine = counts.groupBy("source", "language", "domain").agg(F.count("*").alias("n"), F.sum("tokens").alias("t"))
    cube = fine.groupingSets(
        [[F.col("source"), F.col("language"), F.col("domain")], [F.col("source"), F.col("language")],
         [F.col("source")], [F.col("language")], [F.col("domain")], []],
        F.col("source"), F.col("language"), F.col("domain"),
    ).agg(
        F.sum("n").alias("examples"), F.sum("t").alias("tokens"),
        *[F.grouping(c).alias(f"_{c}") for c in ("source", "language", "domain")],
    )
    star = [F.when(F.col(f"_{c}") == 1, "*").otherwise(F.col(c)).alias(c) for c in ("source", "language", "domain")]
    return cube.where(F.coalesce("examples", F.lit(0)) > 0).select(*star, F.col("examples").cast("long"), F.col("tokens").cast("long"))
