"""The mixture of refined and broad instructions and commits."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from gristmill.functions import diffs, language, quality
from gristmill.functions.hashing import DEFAULT_SEED, hash_hex, hash_split
from gristmill.functions.messages import make_messages, message_tokens
from gristmill.functions.text import strip
from gristmill.operators import sampling
from gristmill.operators.accept import accept
from gristmill.session import durable


def latest(df: DataFrame, keys: list[str]) -> DataFrame:
    """One row for each key where rows were delivered repeatedly: the one loaded first."""
    if "loaded_at" not in df.columns:
        return df.dropDuplicates(keys)
    rest = [c for c in df.columns if c not in keys]
    first = F.min_by(F.struct(*rest), F.struct("loaded_at", F.xxhash64(*rest)))
    return df.groupBy(*keys).agg(first.alias("_r")).select(*keys, "_r.*")


def with_tier(rows: DataFrame, exact: bool = False) -> DataFrame:
    """Add ``tier`` of a judged row (null below ``D``), and the scores behind it."""
    scores = quality.judge_scores_exact(F.col("llm_judgement")) if exact else quality.judge_scores(F.col("llm_judgement"))
    d = rows.withColumn("test_score", quality.test_score(F.col("average_test_score"))).withColumn("least_judge", quality.least(scores))
    return d.withColumn("tier", quality.tier(F.col("test_score"), F.col("least_judge")))


def instruction_examples(rows: DataFrame, source: str, tier, seed: int = DEFAULT_SEED) -> DataFrame:
    """Canonical examples of instruction rows; null texts count as empty.  Rows without id have no example."""
    key = F.concat(F.lit(f"{source}:"), "id")
    text = lambda c: F.coalesce(F.col(c), F.lit(""))
    messages = make_messages(text("input"), text("output"))
    meta = F.struct("domain", "generation_algorithm", "average_test_score")
    return rows.where("id is not null").select(
        key.alias("id"), F.lit(source).alias("source"), F.col("id").alias("source_id"), F.lit(None).cast("string").alias("repo_id"),
        language.infer_language(text("output")).alias("language"), F.lit("code_generation").alias("task_type"), tier.alias("quality_tier"),
        hash_split(key, seed).alias("split"), messages.alias("messages"), message_tokens(messages).alias("token_count"), F.to_json(meta).alias("metadata"),
    )


def commit_examples(rows: DataFrame, seed: int = DEFAULT_SEED, keep: list[str] | None = None) -> DataFrame:
    """Canonical examples of commits: the task, the old file and, as answer, the diff; no diff, no example.  Columns of ``keep`` stay."""
    some = lambda c, default: F.coalesce(F.nullif(F.col(c), F.lit("")), default)
    old_file = some("old_file", F.lit("file"))
    d = rows.withColumn("_old", old_file).withColumn("_new", some("new_file", old_file))
    d = d.withColumn("_patch", diffs.unified_diff(F.col("old_contents"), F.col("new_contents"), F.col("_old"), F.col("_new"))).where(F.length(strip(F.col("_patch"))) > 0)
    task = F.coalesce(F.nullif(F.col("subject"), F.lit("")), F.nullif(F.col("message"), F.lit("")), F.lit("Apply the requested change."))
    lang = F.coalesce("lang", F.lit(""))
    # The layout of the prompt, and the task of a commit that states none.
    prompt = F.concat(
        F.lit("Repository file: "), "_old", F.lit("\n\nTask: "), task, F.lit("\n\nCurrent content:\n```"), lang, F.lit("\n"), F.coalesce("old_contents", F.lit("")),
        F.lit("\n```\n\nReturn the smallest correct unified diff."),
    )
    messages = make_messages(prompt, F.col("_patch"))
    sid = F.coalesce(F.nullif(F.col("commit"), F.lit("")), F.sha2("_patch", 256))
    repo = F.nullif(F.col("repos"), F.lit(""))
    own = language.infer_language(F.lit(""), F.coalesce("lang", F.lit("unknown")))
    meta = F.struct(F.col("_old").alias("old_file"), F.col("_new").alias("new_file"), "license", own.alias("source_language"))
    return d.select(
        F.concat(F.lit("commitpackft:"), sid, F.lit(":"), "_new").alias("id"), F.lit("commitpackft").alias("source"), sid.alias("source_id"), repo.alias("repo_id"),
        language.infer_language(F.coalesce("new_contents", F.lit("")), own).alias("language"), F.lit("code_edit").alias("task_type"), F.lit("filtered").alias("quality_tier"),
        hash_split(F.coalesce(repo, sid), seed).alias("split"), messages.alias("messages"), message_tokens(messages).alias("token_count"), F.to_json(meta).alias("metadata"), *(keep or []),
    )


def mixture(refined: DataFrame, broad: DataFrame, commits: DataFrame, benchmark: DataFrame, benchmark_text: str, counts: dict[str, int], tier_weights: dict[str, float],
            language_weights: dict[str, float], max_tokens: int = 8192, multiplier: float = 1.5, seed: int = DEFAULT_SEED) -> tuple[DataFrame, DataFrame]:
    """``(examples, judged)``: the accepted mixture in hash order, and every judged candidate with its reason.

    Sources come in a fixed order, refined, broad tier by tier, commits language
    by language, and an earlier row wins over a later one that is the same or near.
    Commits beyond a language's quota wait as overflow, and fill what is missing.
    All candidates are signed and linked once.
    """
    draw = sampling.candidate_count
    ends: dict[int, int | None] = {}
    parts: list[DataFrame] = []

    def add(examples: DataFrame, name: str, end: int | None) -> None:
        parts.append(examples.withColumn("source_no", F.lit(len(ends))).withColumn("_quota_of", F.lit(name)))
        ends[len(ends)] = end

    some = sampling.priority_sample(latest(refined, ["id"]), F.col("id"), draw(counts["refined"], multiplier), seed, "id")
    add(instruction_examples(some, "eer6_refined", F.lit("refined"), seed), "refined", counts["refined"])

    targets = sampling.largest_remainder(counts["broad"], tier_weights)
    limits = {t: draw(n, multiplier) for t, n in targets.items() if n > 0}
    tiers = durable(sampling.stratified_sample(with_tier(latest(broad, ["id"])), "tier", limits, F.col("id"), seed, "id"))
    for tier, n in targets.items():
        add(instruction_examples(tiers.where(F.col("tier") == tier), "eer6_broad", F.lit(tier), seed), tier, n)

    first_commit = len(ends)
    quotas = sampling.largest_remainder(counts["commits"], language_weights)
    lang = language.infer_language(F.lit(""), F.coalesce("lang", F.lit("unknown")))
    named = durable(latest(commits, ["commit", "new_file"]).withColumn("_lang", lang))
    drawn = sampling.stratified_sample(named, "_lang", {k: draw(n, multiplier) for k, n in quotas.items() if n > 0}, sampling.sample_key(named, "commit"), seed, "new_file")
    of_language = durable(commit_examples(drawn, seed, ["_lang"]))
    for name in quotas:
        add(of_language.where(F.col("_lang") == name).drop("_lang"), name, None)
    every = parts[0]
    for p in parts[1:]:
        every = every.unionByName(p)
    every = durable(every)
    # ids and hashes alone are put in order, a bounded draw of each source; the texts stay where they are
    place = F.row_number().over(W.partitionBy("source_no").orderBy(hash_hex(F.col("source_id"), seed), "id")).cast("long")
    ranks = every.select("source_no", "id", "source_id").select("source_no", "id", (place + F.col("source_no") * F.lit(1 << 40)).alias("rank"))
    judged = durable(accept(durable(every.join(ranks, ["source_no", "id"])), benchmark, benchmark_text, max_tokens, ends))
    taken = judged.where("reason is null")
    commits_taken = sampling.backfill(taken.where(F.col("source_no") >= first_commit), "_quota_of", quotas, ["rank"], F.col("id"), seed).drop("filled")
    examples = taken.where(F.col("source_no") < first_commit).unionByName(commits_taken).drop("reason", "rank", "source_no", "_quota_of")
    return examples.orderBy(hash_hex(F.col("id"), seed)), judged.drop("source_no", "_quota_of")
