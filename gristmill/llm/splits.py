"""Problem 4: splits that keep all examples of related repositories together."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from gristmill.llm.common import latest_copy
from gristmill.llm.forest import spanning_forest
from gristmill.session import durable

# Spellings of the recorded split.
SPLIT_SPELLINGS = {"train": "train", "validation": "validation", "val": "validation", "valid": "validation", "dev": "validation", "test": "test"}
#: Units that one task ranks; the number of tasks follows from the data.
UNITS_PER_SLOT = 500_000


def repo_names(repo_id: Column) -> Column:
    """Distinct repositories that a ``repo_id`` names, as sorted ``owner/name`` in lower case.

    Parted by ``,`` or ``;``; scheme, user, host, port, ``.git``, blanks and
    stray slashes are removed.  Null and blank give an empty list.
    """

    def clean(x: Column) -> Column:
        s = F.regexp_replace(F.lower(x), r"\s+", "")
        has_host = s.rlike(r"^[a-z+]+://|^[^/@]+@")
        s = F.regexp_replace(s, r"^[a-z+]+://", "")
        s = F.regexp_replace(s, r"^[^/@]+@", "")
        s = F.regexp_replace(F.regexp_replace(s, r":\d+/", "/"), ":", "/")
        s = F.regexp_replace(s, r"[?#].*$", "")
        s = F.regexp_replace(F.regexp_replace(s, "/+", "/"), r"^/+|(/|\.git)+$", "")
        three = s.rlike(r"^[^/]*\.[^/]*/[^/]+/[^/]+")
        s = F.when(has_host | three, F.regexp_replace(s, r"^[^/]+/", "")).otherwise(s)
        s = F.regexp_replace(s, r"^([^/]+/[^/]+)/.*$", "$1")
        return F.regexp_replace(s, r"(/|\.git)+$", "")

    parts = F.transform(F.split(F.coalesce(repo_id, F.lit("")), "[,;]"), clean)
    return F.array_sort(F.array_distinct(F.filter(parts, lambda x: x != "")))


def clean_split(c: Column) -> Column:
    """``train``, ``validation`` or ``test``; null where the spelling is none of them."""
    known = F.create_map(*[F.lit(x) for kv in SPLIT_SPELLINGS.items() for x in kv])
    return F.try_element_at(known, F.trim(F.lower(c)))


def _examples(examples: DataFrame) -> DataFrame:
    # A row without id is known by its source and repository; the messages need not be read.
    unnamed = F.concat(F.lit("row:"), F.hex(F.xxhash64("source", "source_id", "repo_id", "content_sha256")))
    wanted = examples.select(
        F.coalesce("id", unnamed).alias("key"), "id", "loaded_at",
        repo_names(F.col("repo_id")).alias("repos"), clean_split(F.col("split")).alias("old_split"),
    )
    return durable(latest_copy(wanted, "key", ["loaded_at"]))


def repo_sets(found: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(sets, forest)``: ``repo, root`` of every repository, and the spanning forest of the ties."""
    lists = durable(found.where(F.size("repos") > 0).select("repos").distinct())
    chain = F.transform(F.sequence(F.lit(1), F.size("repos") - 1), lambda i: F.struct(F.col("repos")[i - 1].alias("u"), F.col("repos")[i].alias("v")))
    labels, forest = spanning_forest(lists.where(F.size("repos") > 1).select(F.explode(chain).alias("e")).select("e.*"))
    repos = lists.select(F.explode("repos").alias("repo")).distinct()
    sets = repos.join(labels.withColumnRenamed("node", "repo"), "repo", "left").select("repo", F.coalesce("root", "repo").alias("root"))
    return durable(sets), forest


def torn_repositories(examples: DataFrame) -> DataFrame:
    """Repositories (``repo``) of every set whose examples carry more than one recorded split."""
    found = _examples(examples)
    sets, _ = repo_sets(found)
    seen = found.where("old_split is not null and size(repos) > 0").select(F.col("repos")[0].alias("repo"), "old_split").distinct()
    torn = seen.join(sets, "repo").groupBy("root").agg(F.min("old_split").alias("lo"), F.max("old_split").alias("hi")).where("lo <> hi").select("root")
    return sets.join(torn, "root", "left_semi").select("repo")


def _plan(bands: list, share: dict[str, float]) -> list[tuple[int, float, float]]:
    """Rates (validation, test) of each size band, from the largest units down.

    A band with too few units to give one away goes to train as a whole, and
    the bands below make up for it.
    """
    out, seen, done = [], 0, {"validation": 0.0, "test": 0.0}
    for b in sorted(bands, key=lambda r: -r["band"]):
        seen += b["examples"]
        rates = {}
        for s in done:
            rates[s] = min(0.45, max(0.0, (share[s] * seen - done[s]) / b["examples"]))
        if int(b["units"] * sum(rates.values())) < 2 and b["band"] > 0:
            rates = dict.fromkeys(rates, 0.0)
        for s in done:
            done[s] += rates[s] * b["examples"]
        out.append((b["band"], rates["validation"], rates["test"]))
    return out


def grouped_splits(examples: DataFrame, validation: float = 0.05, test: float = 0.05, seed: int = 3407) -> DataFrame:
    """``key, id, unit, split``: a split for every distinct example.

    A unit is a set of repositories tied by any ``repo_id``, or one example
    that names none; a unit never is torn.  Units are put into bands by the
    power of two of their size, ordered in a band by a seeded hash, and dealt
    systematically: every 1/rate-th unit leaves train.  Ranks come from counts
    of hash slots plus a rank inside the slot, so neither a band nor the single
    examples are gathered in one task.  An empty table gives an empty result.
    """
    spark = examples.sparkSession
    found = _examples(examples)
    sets, _ = repo_sets(found)
    first = found.withColumn("repo", F.when(F.size("repos") > 0, F.col("repos")[0]))
    tied = first.where("repo is not null").join(sets, "repo").select("key", "id", F.concat(F.lit("repo:"), "root").alias("unit"))
    alone = first.where("repo is null").select("key", "id", F.concat(F.lit("example:"), "key").alias("unit"))
    members = durable(tied.unionByName(alone))
    units = members.groupBy("unit").agg(F.count("*").alias("size"))
    units = durable(units.select("unit", "size", F.floor(F.log2("size")).cast("int").alias("band"), F.xxhash64(F.lit(seed), "unit").alias("h")))
    bands = units.groupBy("band").agg(F.count("*").alias("units"), F.sum("size").alias("examples")).collect()  # at most 63 rows
    plan = _plan(bands, {"validation": validation, "test": test})
    rates = spark.createDataFrame(plan or [(0, 0.0, 0.0)], "band int, rv double, rt double")
    slots = max(1, sum(b["units"] for b in bands) // UNITS_PER_SLOT + 1) * 16
    placed = units.withColumn("slot", F.pmod("h", F.lit(slots)))
    before = placed.groupBy("band", "slot").agg(F.count("*").alias("n"))
    before = before.withColumn("before", F.coalesce(F.sum("n").over(W.partitionBy("band").orderBy("slot").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))).drop("n")
    rank = F.row_number().over(W.partitionBy("band", "slot").orderBy("h", "unit")) - 1
    dealt = placed.withColumn("r", rank).join(F.broadcast(before), ["band", "slot"]).join(F.broadcast(rates), "band")
    r, away = F.col("r") + F.col("before"), F.col("rv") + F.col("rt")
    nth = F.floor(r * away)
    leaves = (away > 0) & (F.floor((r + 1) * away) > nth)
    to_validation = F.floor((nth + 1) * F.col("rv") / away) > F.floor(nth * F.col("rv") / away)
    split = F.when(~leaves, "train").when(to_validation, "validation").otherwise("test")
    return members.join(dealt.select("unit", F.coalesce(split, F.lit("train")).alias("split")), "unit").select("key", "id", "unit", "split")


def split_shares(splits: DataFrame) -> DataFrame:
    """Examples, units and share of each split."""
    n = splits.groupBy("split", "unit").agg(F.count("*").alias("n")).groupBy("split").agg(F.sum("n").alias("examples"), F.count("*").alias("units"))
    return n.withColumn("share", F.col("examples") / F.sum("examples").over(W.partitionBy()))  # three rows
