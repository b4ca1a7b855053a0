"""Problem 7: a training mix in which each source holds its target weight.

Pfair scheduling: the k-th block of a source of weight w may not run before slot
floor((k - 1) / w) and must run before slot ceil(k / w).  Taking, in each slot,
the released block with the earliest deadline keeps every source within one
block of its share at every moment of the mix.  The schedule of rational
weights repeats, so one period, or the mix where that is shorter, is planned on
the driver and each block finds its slot by arithmetic; the mix may have any
number of blocks.  A document that reaches over blocks has a piece in each.
"""

from __future__ import annotations

import heapq
import math
from fractions import Fraction

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from gristmill.llm.common import slug
from gristmill.llm.vocab import Vocab, row_tokens
from gristmill.session import durable

#: Tokens of a block.
BLOCK_TOKENS = 8192
#: Slots that are planned at most.  Weights of a longer period are exact in a mix of up to so many slots; for a longer mix they are rounded to
#: 1/PERIOD, and no source to less than one slot of a period.
PERIOD = 200_000
#: Documents that one task puts in order; the number of tasks follows from the data.
ROWS_PER_SLOT = 500_000
#: Sources are few; more than this is taken for a wrong column.
MAX_SOURCES = 10_000


def exact_shares(weights: dict[str, float]) -> dict[str, Fraction]:
    """Weights as fractions that add up to 1; every weight above zero keeps a share."""
    raw = {s: Fraction(str(w)) for s, w in weights.items() if w and w > 0}
    total = sum(raw.values())
    return {s: w / total for s, w in raw.items()}


def planned_shares(shares: dict[str, Fraction], slots: int) -> dict[str, Fraction]:
    """The shares that a schedule of ``slots`` slots is planned with.

    They are the exact ones where their common period or the schedule has at
    most ``PERIOD`` slots, else multiples of 1/PERIOD that add up to 1, of at least one.
    """
    if slots <= PERIOD or not shares or math.lcm(*[f.denominator for f in shares.values()]) <= PERIOD:
        return shares
    units = {s: max(1, math.floor(f * PERIOD)) for s, f in shares.items()}
    over = sum(units.values()) - PERIOD
    error = sorted(shares, key=lambda s: (units[s] - shares[s] * PERIOD, s))
    for s in error[: max(0, -over)]:
        units[s] += 1
    for s in sorted(units, key=lambda s: (-units[s], s)):  # what the least sources were given comes off the largest
        off = min(max(0, over), units[s] - 1)
        units[s], over = units[s] - off, over - off
    return {s: Fraction(u, PERIOD) for s, u in units.items()}


def pfair_period(shares: dict[str, Fraction], slots: int | None = None) -> list[str]:
    """Source of each slot of one period, or of the first ``slots``: the released block with the earliest deadline."""
    if not shares:
        return []
    period = math.lcm(*[f.denominator for f in shares.values()])
    waiting = [(0, s, 1) for s in sorted(shares)]  # release, source, block
    heapq.heapify(waiting)
    ready: list[tuple[int, str, int]] = []
    out = []
    for t in range(period if slots is None else min(period, slots)):
        while waiting and waiting[0][0] <= t:
            _, s, k = heapq.heappop(waiting)
            heapq.heappush(ready, (math.ceil(k / shares[s]), s, k))
        deadline, s, k = heapq.heappop(ready)
        assert deadline > t, "a block misses its deadline"
        out.append(s)
        heapq.heappush(waiting, (math.floor(k / shares[s]), s, k + 1))
    return out


def _targets(spark, weights: DataFrame, sizes: DataFrame) -> tuple[list, dict[str, Fraction], float]:
    rows = weights.groupBy("source").agg(F.max("weight").alias("weight"), F.max("max_repeats").alias("max_repeats")).join(sizes, "source", "full").limit(MAX_SOURCES + 1).collect()
    if len(rows) > MAX_SOURCES:
        raise ValueError("more sources than a mix is planned for")
    usable = {r["source"]: r["weight"] for r in rows if (r["available"] or 0) > 0 and (r["weight"] or 0) > 0 and (r["max_repeats"] or 0) > 0}
    shares = exact_shares(usable) if usable else {}
    by = {r["source"]: r for r in rows}
    total = min((by[s]["available"] * by[s]["max_repeats"] / float(f) for s, f in shares.items()), default=0.0)
    return rows, shares, total


def mix(documents: DataFrame, weights: DataFrame, vocab: Vocab, block_tokens: int = BLOCK_TOKENS, seed: int = 3407) -> tuple[DataFrame, DataFrame]:
    """``(mix, shares)`` of the largest mix in which every source reaches its share.

    ``mix``: ``doc_id, source, copy, piece, tokens, slot, at``, one row for each
    piece of each use of a document; a piece lies in one slot, and the slot's
    pieces have at most ``block_tokens`` tokens, so a document of any length
    keeps the bound.  Sorted by ``slot, at`` it is the interleaved stream.  ``shares``:
    what each source was to hold and holds.  The total is bounded by the source
    that runs out first with all its documents used ``max_repeats`` times; a
    source without documents cannot hold a share and leaves its weight to the
    others in proportion, which ``shares`` shows.  Documents without a known
    source are not in the mix; ``shares`` counts them as ``unknown``.  A
    document without tokens takes no room.  Order inside a source is by a seeded
    hash, anew for each pass; its running token sums come from sums of hash
    slots plus a sum inside the slot, so a source with a third of all rows is
    spread over many tasks.
    """
    spark = documents.sparkSession
    source = F.coalesce(slug(F.col("source")), F.lit("unknown"))
    docs = durable(row_tokens(documents.where("doc_id is not null").select("doc_id", source.alias("source"), "text"), ["doc_id"], "text", vocab).select("doc_id", "source", F.coalesce("tokens", F.lit(0).cast("long")).alias("tokens")))
    sizes = docs.groupBy("source").agg(F.sum("tokens").alias("available"), F.count("*").alias("docs"), F.max("tokens").alias("longest"))
    clean = weights.select(slug(F.col("source")).alias("source"), "weight", "max_repeats").where("source is not null")
    rows, shares, total = _targets(spark, clean, sizes)
    blocks = {s: math.ceil(float(f) * total / block_tokens) + 1 for s, f in shares.items()}  # a document may end behind the quota
    needed = math.ceil(max((blocks[s] / float(f) for s, f in shares.items()), default=0)) + len(shares)
    longest = max((by_source["longest"] or 0 for by_source in rows), default=0)
    needed += math.ceil(max((longest / block_tokens / float(f) for f in shares.values()), default=0))
    slots = pfair_period(planned_shares(shares, needed), min(needed, PERIOD))
    per: dict[str, list[int]] = {s: [] for s in shares}
    for t, s in enumerate(slots):
        per[s].append(t)
    by = {r["source"]: r for r in rows}
    most = max((by[s]["docs"] for s in shares), default=0)
    hash_slots = 16 * (1 + most // ROWS_PER_SLOT)
    plan = spark.createDataFrame(
        [(s, float(f) * total, int(by[s]["available"]), max(1, min(int(by[s]["max_repeats"]), math.ceil(float(f) * total / by[s]["available"] - 1e-9))), len(per[s])) for s, f in shares.items()],
        "source string, quota double, available long, passes int, in_period int",
    )
    period = spark.createDataFrame([(s, k, t) for s in per for k, t in enumerate(per[s])], "source string, k int, slot_in_period int")
    uses = docs.join(F.broadcast(plan), "source").withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("passes"))))
    uses = uses.withColumn("h", F.xxhash64(F.lit(seed), "copy", "doc_id")).withColumn("hs", F.pmod("h", F.lit(hash_slots)))
    sums = uses.groupBy("source", "copy", "hs").agg(F.sum("tokens").alias("n"))
    before = W.partitionBy("source", "copy").orderBy("hs").rowsBetween(W.unboundedPreceding, -1)
    sums = sums.withColumn("base", F.coalesce(F.sum("n").over(before), F.lit(0))).drop("n")
    inside = F.sum("tokens").over(W.partitionBy("source", "copy", "hs").orderBy("h", "doc_id").rowsBetween(W.unboundedPreceding, -1))
    placed = uses.withColumn("inside", F.coalesce(inside, F.lit(0))).join(sums, ["source", "copy", "hs"])
    start = (F.col("copy") - 1) * F.col("available") + F.col("base") + F.col("inside")
    taken = placed.withColumn("start", start).where(F.col("start") + F.col("tokens") / 2 <= F.col("quota"))
    of = lambda c: F.floor(c / block_tokens)
    last = F.greatest(F.col("start"), F.col("start") + F.col("tokens") - 1)
    pieces = taken.select("*", F.posexplode(F.sequence(of(F.col("start")), of(last))).alias("piece", "block")).withColumn("k", F.pmod("block", "in_period").cast("int"))
    begin, end = F.greatest(F.col("start"), F.col("block") * block_tokens), F.least(F.col("start") + F.col("tokens"), (F.col("block") + 1) * block_tokens)
    slot = F.floor(F.col("block") / F.col("in_period")) * len(slots) + F.col("slot_in_period")
    placed = pieces.join(F.broadcast(period), ["source", "k"])
    mixed = durable(placed.select("doc_id", "source", "copy", "piece", (end - begin).cast("long").alias("tokens"), slot.alias("slot"), F.pmod(begin, F.lit(block_tokens)).cast("long").alias("at")))

    used = mixed.groupBy("source").agg(F.sum("tokens").alias("used"), F.count_if(F.col("piece") == 0).alias("uses"), F.max("copy").alias("copies"))
    aims = spark.createDataFrame([(r["source"], r["weight"], r["max_repeats"], float(shares.get(r["source"], 0)), int(r["docs"] or 0), int(r["available"] or 0)) for r in rows], "source string, weight double, max_repeats int, target double, docs long, available long")
    report = aims.join(used, "source", "left")
    whole = F.sum("used").over(W.partitionBy())  # a row for each source
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("long").alias(c)
    return mixed, report.select(
        "source", "weight", "max_repeats", "target", "docs", "available", zero("used"), zero("uses"), zero("copies"),
        F.coalesce(F.col("used") / F.when(whole > 0, whole), F.lit(0.0)).alias("share"),
    )
