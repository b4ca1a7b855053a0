"""Metrics of answers to repository tasks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gristmill.functions import arrays, diffs, text


def score(df: DataFrame, answer: str = "response") -> DataFrame:
    """Add the metrics that a row's kind of task has; the others are null.

    Localization of files and functions: recall at 1, 3 and 5 of a ranked list.
    Patches: whether the answer is a diff, and the precision of its files.
    Tests have no metric.
    """
    ranked = text.ranked_values(F.col(answer))
    patch = text.fenced_code(F.col(answer))
    none = F.array().cast("array<string>")
    out = df
    for kind, name, column in (("file_localization", "file", "changed_files"), ("function_localization", "function", "functions")):
        for k in (1, 3, 5):
            value = arrays.recall_at(F.coalesce(F.col(f"metadata.{column}"), none), ranked, k)
            out = out.withColumn(f"{name}_recall_at_{k}", F.when(F.col("task_type") == kind, value))
    is_patch = F.col("task_type") == "patch_generation"
    out = out.withColumn("valid_diff_rate", F.when(is_patch, diffs.is_diff(patch).cast("double")))
    precision = diffs.file_precision(F.coalesce("metadata.changed_files", none), diffs.changed_files(patch))
    return out.withColumn("changed_file_precision", F.when(is_patch, precision))


METRICS = [*(f"{n}_recall_at_{k}" for n in ("file", "function") for k in (1, 3, 5)), "valid_diff_rate", "changed_file_precision"]


def summary(scored: DataFrame) -> DataFrame:
    """``metric, mean, n``: the mean over the rows that have the metric, 0.0 where none has."""
    one = scored.agg(*[F.struct(F.coalesce(F.avg(m), F.lit(0.0)).alias("mean"), F.count(m).alias("n")).alias(m) for m in METRICS])
    return one.unpivot([], METRICS, "metric", "v").select("metric", "v.mean", "v.n")


def task_counts(rows: DataFrame) -> DataFrame:
    """``task_type, n`` of the evaluated rows."""
    return rows.groupBy("task_type").agg(F.count("*").alias("n"))


def solutions(responses: DataFrame) -> DataFrame:
    """``task_id, solution, raw_response`` from ``task_id, response``: one record for each sample, the solution its longest fenced block."""
    return responses.select("task_id", text.fenced_code(F.col("response")).alias("solution"), F.col("response").alias("raw_response"))
