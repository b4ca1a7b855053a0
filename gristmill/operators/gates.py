"""Reports, gates and probe results."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SECTIONS = ["", "benchmarks", "metrics", "repo", "smoke"]


def metrics(report: DataFrame) -> DataFrame:
    """``report, metric, value`` from ``report, section, metric, value``: of equal names the first section counts.

    Root values have the section ``""``.
    """
    place = F.array_position(F.array(*[F.lit(s) for s in SECTIONS]), F.coalesce("section", F.lit("")))
    best = F.min_by("value", place)
    return report.where(place > 0).groupBy("report", "metric").agg(best.alias("value"))


def compare(report: DataFrame, stage: str, baseline: str = "baseline", candidate: str = "candidate") -> DataFrame:
    """``check_name, passed`` of a candidate's report against a baseline's, and ``all`` for the gate.

    Stage 1: mean gain of the core metrics of at least one point, no regression of
    more than two, and three smoke flags (a missing flag fails).  Stage 2: a gain of
    five points in file recall or patch rate instead of the mean gain.
    """
    core = ["humaneval_plus_pass_at_1", "mbpp_plus_pass_at_1"]
    m = metrics(report)
    at = lambda r, k: F.max(F.when((F.col("report") == r) & (F.col("metric") == k), F.col("value")))
    gain = sum(at(candidate, k) for k in core) / 2 - sum(at(baseline, k) for k in core) / 2
    worst = F.greatest(*[at(baseline, k) - at(candidate, k) for k in core])
    repo = F.greatest(*[at(candidate, k) - at(baseline, k) for k in ("file_recall_at_3", "patch_apply_rate")])
    smoke = lambda k: F.max(F.when((F.col("report") == candidate) & (F.col("metric") == k), F.col("value")))
    # The names of the checks and their thresholds.
    if stage == "stage1":
        checks = {
            "core_average_gain_at_least_1pp": gain >= 0.01, "no_core_regression_over_2pp": worst <= 0.02,
            "finite_validation_loss": F.coalesce(smoke("finite_validation_loss") != 0, F.lit(False)),
            "no_repetition_regression": F.coalesce(smoke("repetition_regression") == 0, F.lit(False)),
            "no_termination_regression": F.coalesce(smoke("termination_regression") == 0, F.lit(False)),
        }
    else:
        checks = {"repo_gain_at_least_5pp": repo >= 0.05, "no_core_regression_over_2pp": worst <= 0.02}
    one = m.agg(*[F.coalesce(c, F.lit(False)).alias(k) for k, c in checks.items()])
    one = one.withColumn("all", F.forall(F.array(*checks), lambda x: x))
    return one.unpivot([], [*checks, "all"], "check_name", "passed")


def largest_passing(probes: DataFrame, headroom: float = 0.10) -> DataFrame:
    """``selected``: the greatest length that succeeded with enough headroom, 0 where none did."""
    ok = F.col("success") & (F.coalesce("headroom_fraction", F.lit(0.0)) >= headroom)
    return probes.agg(F.coalesce(F.max(F.when(ok, F.col("length"))), F.lit(0)).cast("int").alias("selected"))


#: Characters of a failed probe's output that are kept.
ERROR_TAIL = 4_000


def probe_lengths(probes: DataFrame) -> DataFrame:
    """``lengths``: the distinct lengths to probe, ascending."""
    return probes.agg(F.array_sort(F.collect_set("length")).alias("lengths"))


def probe_results(output: DataFrame, marker: str) -> DataFrame:
    """``probe, length, success, headroom_fraction, error`` from ``probe, line_no, line`` and, where there are, ``stream, length, exit_code``.

    The JSON after the marker on the last marked line of the output counts; a
    probe without one, or with an exit code other than 0, failed, and keeps the last
    ``ERROR_TAIL`` characters of its error stream, or of its output where that is empty.
    """
    d = output
    for name, default in (("stream", F.lit("out")), ("length", F.lit(None).cast("int")), ("exit_code", F.lit(0))):
        d = d if name in d.columns else d.withColumn(name, default)
    said = F.col("stream") == "out"
    body = F.when(said & F.col("line").startswith(marker), F.substring(F.col("line"), len(marker) + 1, 1 << 30))
    joined = lambda c: F.array_join(F.transform(F.array_sort(F.collect_list(F.when(c, F.struct("line_no", "line")))), lambda x: x.line), "\n")
    last = d.groupBy("probe").agg(F.max_by(body, F.when(body.isNotNull(), F.col("line_no"))).alias("json"), F.max("length").alias("asked"), F.max("exit_code").alias("code"), joined(~said).alias("err"), joined(said).alias("out"))
    parsed = F.from_json("json", "length int, success boolean, headroom_fraction double")
    ok = F.col("json").isNotNull() & (F.col("code") == 0)
    tail = F.coalesce(F.nullif(F.col("err"), F.lit("")), F.col("out"))
    return last.withColumn("r", F.when(ok, parsed)).select(
        "probe", F.coalesce("r.length", "asked").alias("length"), F.coalesce("r.success", F.lit(False)).alias("success"), "r.headroom_fraction", F.when(~ok, F.right(tail, F.lit(ERROR_TAIL))).alias("error")
    )


def select_profile(profiles: DataFrame, vram_gb: float) -> DataFrame:
    """``name`` of the profile with the greatest requirement that the hardware meets; ties by greater name."""
    return profiles.where(F.col("min_vram_gb") <= vram_gb).agg(F.max(F.struct("min_vram_gb", "name")).alias("b")).select("b.name")


# The projections of each module family.
FAMILIES = {
    "full_attention": ["q_proj", "k_proj", "v_proj", "o_proj"],
    "linear_attention": ["in_proj_qkv", "in_proj_z", "in_proj_b", "in_proj_a", "out_proj"],
    "mlp": ["gate_proj", "up_proj", "down_proj"],
}


def parameter_audit(modules: DataFrame) -> DataFrame:
    """``family, modules, trainable, total`` from ``name, numel, trainable``; other modules are ``other``."""
    leaf = F.substring_index("name", ".", -1)
    family = None
    for k, names in FAMILIES.items():
        family = (F if family is None else family).when(leaf.isin(names), k)
    return modules.groupBy(family.otherwise("other").alias("family")).agg(
        F.count("*").alias("modules"), F.sum(F.when(F.col("trainable"), F.col("numel")).otherwise(0)).alias("trainable"), F.sum("numel").alias("total")
    )


# What the name of a vision parameter holds.
VISION = [".visual.", ".vision_", "vision_model"]


def audit_faults(modules: DataFrame) -> DataFrame:
    """``fault, names``: families without a module, vision parameters that are trained, and a model of which nothing is trained."""
    leaf = F.substring_index("name", ".", -1)
    vision = F.lit(False)
    for mark in VISION:
        vision = vision | F.lower("name").contains(mark)
    one = modules.agg(
        *[F.count_if(leaf.isin(names)).alias(k) for k, names in FAMILIES.items()],
        F.array_sort(F.collect_set(F.when(F.col("trainable") & vision, F.col("name")))).alias("seen"),
        F.coalesce(F.sum(F.when(F.col("trainable"), F.col("numel"))), F.lit(0)).alias("trained"),
    )
    missing = F.array_compact(F.array(*[F.when(F.col(k) == 0, k) for k in FAMILIES]))
    faults = F.array(
        F.struct(F.lit("missing projection families").alias("fault"), missing.alias("names"), (F.size(missing) > 0).alias("bad")),
        F.struct(F.lit("vision parameters are trainable").alias("fault"), F.col("seen").alias("names"), (F.size("seen") > 0).alias("bad")),
        F.struct(F.lit("nothing is trainable").alias("fault"), F.array().cast("array<string>").alias("names"), (F.col("trained") == 0).alias("bad")),
    )
    return one.select(F.explode(faults).alias("f")).where("f.bad").select("f.fault", "f.names")


def last_checkpoint(paths: DataFrame) -> DataFrame:
    """``path`` of the checkpoint with the greatest step; names without a whole number are ignored."""
    step = F.regexp_extract("path", r"checkpoint-(\d+)/*\z", 1)
    return paths.where(step != "").agg(F.max_by("path", step.cast("bigint")).alias("path"))


def resolve_length(requested: int, selected: int, minimum: int) -> tuple[int, bool]:
    """Length to train with and whether it is below the request; below the minimum is an error."""
    got = min(requested, selected)
    if got < minimum:
        raise ValueError(f"the profiled length {selected} is below the minimum {minimum}")
    return got, got < requested


def finite(df: DataFrame, column: str) -> DataFrame:
    """Rows whose value is not a finite number."""
    c = F.col(column)
    return df.where(c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
