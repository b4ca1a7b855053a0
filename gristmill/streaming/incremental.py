"""Extensions for streams; the batch operators do not need them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gristmill.functions.text import normalize


def exact_dedup(stream: DataFrame, text: str, event_time: str, within: str) -> DataFrame:
    """First row of each normalized text inside a watermark; state is dropped when the watermark passes."""
    keyed = stream.withColumn("text_key", F.sha2(normalize(F.col(text)), 256)).withWatermark(event_time, within)
    return keyed.dropDuplicatesWithinWatermark(["text_key"])


def counts_by_window(stream: DataFrame, by: str, event_time: str, late: str, width: str) -> DataFrame:
    """``window_start, by, n`` over tumbling windows; rows later than ``late`` are dropped."""
    got = stream.withWatermark(event_time, late).groupBy(F.window(event_time, width).alias("w"), by).agg(F.count("*").alias("n"))
    return got.select(F.col("w.start").alias("window_start"), by, "n")
