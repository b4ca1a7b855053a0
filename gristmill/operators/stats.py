"""Counts and statistics of a prepared corpus."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W


def counts_by(df: DataFrame, columns: list[str]) -> DataFrame:
    """``dimension, value, n`` for every column in one pass (grouping sets)."""
    sets = df.groupingSets([[F.col(c)] for c in columns], *[F.col(c) for c in columns])
    got = sets.agg(F.count("*").alias("n"), F.grouping_id().alias("_g"))
    last = len(columns) - 1
    mine = lambda i: F.col("_g") == ((1 << len(columns)) - 1 - (1 << (last - i)))
    name = F.coalesce(*[F.when(mine(i), c) for i, c in enumerate(columns)])
    value = F.coalesce(*[F.when(mine(i), F.col(c).cast("string")) for i, c in enumerate(columns)])
    return got.select(name.alias("dimension"), value.alias("value"), "n")


def token_stats(df: DataFrame, value: str, quantiles: dict[str, float] | None = None) -> DataFrame:
    """``min, p50, p90, p99, max`` by lower nearest rank, index ``int((n - 1) * p)``; zeros for no rows.

    The ranks come from counts of each distinct value, so the table is reduced to
    its distinct values, a bounded number for token counts, before anything is ordered.
    """
    q = quantiles or {"p50": 0.50, "p90": 0.90, "p99": 0.99}
    n = df.where(F.col(value).isNotNull()).groupBy(F.col(value).cast("long").alias("v")).agg(F.count("*").alias("n"))
    upto = n.withColumn("upto", F.sum("n").over(W.orderBy("v"))).withColumn("all", F.sum("n").over(W.partitionBy()))
    at = lambda p: F.min(F.when(F.col("upto") - 1 >= F.floor((F.col("all") - 1) * F.lit(float(p))), F.col("v")))
    out = upto.agg(F.min("v").alias("min"), *[at(p).alias(k) for k, p in q.items()], F.max("v").alias("max"))
    return out.select(*[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in out.columns])


def first_reason(**conditions: Column) -> Column:
    """Name of the first condition that holds, in order; null where none does."""
    out = None
    for name, c in conditions.items():
        out = (F if out is None else out).when(c, name)
    return out


def skips(df: DataFrame, reason: str, detail: str, order: list, most: int = 1000) -> tuple[DataFrame, DataFrame]:
    """Counts by reason, and the first ``most`` details in order (a capped report)."""
    bad = df.where(F.col(reason).isNotNull())
    return bad.groupBy(reason).agg(F.count("*").alias("n")), bad.orderBy(*order).limit(most).select(reason, detail)


def means(df: DataFrame, by: str, metrics: list[str]) -> DataFrame:
    """``metric, mean, n``: the mean of each metric over the rows that have it, 0 where none has."""
    long = df.unpivot([by], metrics, "metric", "value") if by else df.unpivot([], metrics, "metric", "value")
    return long.groupBy("metric").agg(F.coalesce(F.avg("value"), F.lit(0.0)).alias("mean"), F.count("value").alias("n"))
