"""Expressions that several of the training-data operators share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gristmill.functions.language import ALIASES

# Spellings of a programming language beside those of the core, and the name they stand for.
LANGUAGE_SPELLINGS = ALIASES | {"golang": "go", "rs": "rust"}


def slug(c: Column) -> Column:
    """Lower case, outer blanks off, inner blanks and hyphens as ``_``; blank becomes null."""
    s = F.regexp_replace(F.trim(F.lower(F.regexp_replace(c, r"\s+", " "))), r"[ \-]+", "_")
    return F.when(s != "", s)


def clean_language(c: Column) -> Column:
    """Canonical programming language; null and blank become ``unknown``."""
    s = F.trim(F.lower(c))
    known = F.create_map(*[F.lit(x) for kv in LANGUAGE_SPELLINGS.items() for x in kv])
    return F.when(s.isNull() | (s == ""), F.lit("unknown")).otherwise(F.coalesce(F.try_element_at(known, s), s))


def example_key() -> Column:
    """Name of an example: its id or, where that is null, a hash of its messages."""
    return F.coalesce(F.col("id"), F.concat(F.lit("sha256:"), F.sha2(F.to_json(F.col("messages")), 256)))


def latest_copy(df: DataFrame, key: str, order: list[str]) -> DataFrame:
    """One row for each key: the greatest by ``order``, then by all other columns.

    The greatest struct is found with a partial aggregate on the map side, so a
    key that was delivered a million times sends one row for each task.
    """
    rest = [c for c in df.columns if c != key and c not in order]
    best = F.max(F.struct(*[F.col(c) for c in [*order, *rest]])).alias("_b")
    return df.groupBy(key).agg(best).select(key, "_b.*")
