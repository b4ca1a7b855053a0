"""Scores and tiers of judged rows."""

from __future__ import annotations

import json

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F


def test_score(c: Column, numeric: bool = False) -> Column:
    """Share of passed tests.

    A number passes unscaled.  Of a string the first number counts, its sign
    ignored; above 1 it is a percentage.  No number, or null, is 0.
    """
    if numeric:
        return F.coalesce(c.cast("double"), F.lit(0.0))
    found = F.regexp_extract(F.coalesce(c, F.lit("")), r"[0-9]+(?:\.[0-9]+)?", 0)
    v = F.when(found != "", found.cast("double"))
    return F.coalesce(F.when(v > 1.0, v / 100.0).otherwise(v), F.lit(0.0))


def judge_scores(c: Column) -> Column:
    """Every number under a ``score`` key at any depth, by pattern: ``array<double>``.

    Covers valid and broken JSON alike where scores are unsigned; a malformed
    number such as ``1.2.3`` is left out.  :func:`judge_scores_exact` walks the JSON.
    """
    raw = F.regexp_extract_all(F.coalesce(c, F.lit("")), F.lit(r'"score"\s*:\s*([0-9.]+)'), 1)
    return F.filter(F.transform(raw, lambda x: x.try_cast("double")), lambda x: x.isNotNull())


def _scores(value) -> list[float]:
    """Numbers under a ``score`` key, a mapping's own before those further in, in the order of the text."""
    found, waiting = [], [value]
    while waiting:
        v = waiting.pop()
        if isinstance(v, dict) and isinstance(v.get("score"), (int, float)):
            found.append(float(v["score"]))
        inner = v.values() if isinstance(v, dict) else v if isinstance(v, list) else ()
        waiting.extend(reversed([x for x in inner if isinstance(x, (dict, list))]))
    return found


def judge_scores_exact(c: Column) -> Column:
    """Scores by walking the JSON (signs, exponents, booleans); by pattern only where it cannot be read."""

    @F.arrow_udf("array<double>")
    def walk(col: pa.Array) -> pa.Array:
        out = []
        for x in col.to_pylist():
            try:
                out.append(_scores(json.loads(x)) if x is not None else [])
            except ValueError:
                out.append(None)
        return pa.array(out, pa.list_(pa.float64()))

    return F.coalesce(walk(c), judge_scores(c))


def tier(score: Column, least_judge: Column) -> Column:
    """``A`` to ``D`` by test score and the least judge score; null below."""
    return (
        F.when((score >= 1.0) & (least_judge >= 5.0), "A").when((score >= 1.0) & (least_judge >= 4.0), "B")
        .when((score >= 0.9) & (least_judge >= 4.0), "C").when((score >= 0.8) & (least_judge >= 4.0), "D")
    )


def least(scores: Column) -> Column:
    """Least score, 0 where there is none."""
    return F.coalesce(F.array_min(scores), F.lit(0.0))
