"""Array expressions: recall, subsequences, label masks."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from gristmill.functions.text import let


def count_where(a: Column, f) -> Column:
    """How many elements satisfy a condition."""
    return F.size(F.filter(a, f))


def recall_at(expected: Column, predicted: Column, k: int) -> Column:
    """Share of the expected values among the first ``k`` predicted; 0 where nothing is expected."""
    e = F.array_distinct(expected)
    return F.when(F.size(e) > 0, F.size(F.array_intersect(e, F.slice(predicted, 1, k))) / F.size(e)).otherwise(0.0)


def positions(values: Column, needle: Column) -> Column:
    """Zero-based starts of ``needle`` in ``values``; an empty needle has none."""
    last = F.size(values) - F.size(needle)
    every = F.when((last >= 0) & (F.size(needle) > 0), F.sequence(F.lit(0), last)).otherwise(F.array().cast("array<int>"))
    return F.filter(every, lambda i: F.slice(values, i + 1, F.size(needle)) == needle)


def mask_audit(ids: Column, labels: Column, system: Column, user: Column, response: Column) -> Column:
    """``struct<turns, fault>`` of an assistant-only label mask: the user turns checked, and the first fault, null where it is sound.

    A span is what lies from a system or user marker, or from the start, to the
    end of the next response marker; every label in it must be -100.
    """

    def check(at: Column) -> Column:
        ends = lambda i: F.array_min(F.filter(at["r"], lambda x: x > i)) + F.size(response)
        spans = lambda starts: F.transform(starts, lambda i: F.struct(i.alias("a"), ends(i).alias("b")))
        leaks = lambda starts: F.exists(spans(starts), lambda s: F.exists(F.slice(labels, s.a + 1, F.greatest(s.b - s.a, F.lit(0))), lambda x: x != -100))
        no_marker = F.exists(F.array(F.size(at["r"]), F.size(at["u"]), F.size(at["s"])), lambda n: n == 0)
        fault = (
            F.when(no_marker, "markers not found").when(F.exists(F.slice(labels, 1, at["r"][0] + F.size(response)), lambda x: x != -100), "initial tokens are supervised")
            .when(F.exists(F.concat(at["u"], at["s"]), lambda i: ends(i).isNull()), "turn without a response")
            .when(leaks(at["u"]), "user tokens are supervised").when(leaks(at["s"]), "system tokens are supervised")
        )
        return F.struct(F.size(at["u"]).alias("turns"), fault.alias("fault"))

    where = F.struct(positions(ids, response).alias("r"), positions(ids, user).alias("u"), positions(ids, system).alias("s"))
    return let(where, check)


def mask_violation(ids: Column, labels: Column, system: Column, user: Column, response: Column) -> Column:
    """First fault of an assistant-only label mask, null where it is sound (:func:`mask_audit`)."""
    return mask_audit(ids, labels, system, user, response)["fault"]
