"""Contracts between the steps of a training run: settings, manifests, lineage, bundles.

Each check is a table of faults, so that a run with many artifacts is judged at
once and an empty table means that all is well.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gristmill.functions.diffs import safe_repository
from gristmill.operators.gates import FAMILIES

# What a validated run is set to.
RANK, ALPHA, DROPOUT = 32, 32, 0.0
LENGTHS = (512, 262_144)
#: Settings of a run as columns; null means that the setting is absent.
SETTINGS = "run string, load_in_4bit boolean, load_in_16bit boolean, bf16 boolean, rank int, alpha int, dropout double, target_modules array<string>, max_length int"


def _faults(df: DataFrame, key: str, **conditions: Column) -> DataFrame:
    """``key, fault`` for every condition that holds."""
    every = F.array_compact(F.array(*[F.when(F.coalesce(c, F.lit(False)), name) for name, c in conditions.items()]))
    return df.select(key, F.explode(every).alias("fault"))


def setting_faults(settings: DataFrame) -> DataFrame:
    """``run, fault`` of settings (columns of ``SETTINGS``) that a run may not have; an absent setting has its default."""
    c = F.col
    given = lambda name, default: F.coalesce(c(name), F.lit(default))
    needed = F.array(*[F.lit(x) for names in FAMILIES.values() for x in names])
    length = given("max_length", 0)
    return _faults(
        settings, "run", quantized=given("load_in_4bit", False), not_16bit=~given("load_in_16bit", True), not_bf16=~given("bf16", False),
        adapter_size=(given("rank", RANK) != RANK) | (given("alpha", ALPHA) != ALPHA), dropout=given("dropout", DROPOUT) != DROPOUT,
        missing_projections=c("target_modules").isNotNull() & (F.size(F.array_except(needed, c("target_modules"))) > 0), length=(length < LENGTHS[0]) | (length > LENGTHS[1]),
    )


def manifest_faults(manifests: DataFrame) -> DataFrame:
    """``name, fault`` of manifests (``name, present, complete``): one that is missing, or not complete in so many words."""
    return _faults(manifests, "name", missing=~F.coalesce("present", F.lit(False)), incomplete=F.col("present") & ~F.col("complete").eqNullSafe(F.lit("true")))


def lineage_faults(runs: DataFrame) -> DataFrame:
    """``run, fault`` of runs by the stage their parts come from.

    ``run, stage, gate_required, gate_present, gate_stage, gate_passed,
    adapter_present, adapter_stage``: a second stage needs a first stage's gate
    that passed, where a gate is required or there, and its adapter; a
    publication needs a second stage's adapter.
    """
    c, yes = F.col, lambda name: F.coalesce(F.col(name), F.lit(False))
    second, out = c("stage") == "stage2", c("stage") == "publish"
    passed = c("gate_stage").eqNullSafe(F.lit("stage1")) & c("gate_passed").eqNullSafe(F.lit(True))
    needs = F.coalesce("gate_required", F.lit(True))
    return _faults(
        runs, "run", gate_missing=second & needs & ~yes("gate_present"), gate_not_passed=second & yes("gate_present") & ~passed,
        adapter_missing=(second | out) & ~yes("adapter_present"), adapter_stage=yes("adapter_present") & ~c("adapter_stage").eqNullSafe(F.when(second, "stage1").when(out, "stage2").otherwise(c("adapter_stage"))),
    )


def layout_faults(bundles: DataFrame) -> DataFrame:
    """``bundle, fault`` of bundles (``bundle, stage1_path, repo_path``): unresolved variables, or data in two directories."""
    parent = lambda name: F.regexp_replace(F.col(name), r"/[^/]*\z", "")
    return _faults(bundles, "bundle", unresolved=F.contains(F.concat_ws(" ", "stage1_path", "repo_path"), F.lit("$")), two_directories=parent("stage1_path") != parent("repo_path"))


def layout(bundles: DataFrame) -> DataFrame:
    """``bundle, name``: the four files of a bundle, two data sets, each with its manifest beside it."""
    file = lambda name: F.substring_index(name, "/", -1)
    manifest = lambda name: F.concat(F.regexp_replace(file(name), r"(?<=.)\.[^.]*\z", ""), F.lit(".manifest.json"))
    return bundles.select("bundle", F.explode(F.array(*[f(n) for n in ("stage1_path", "repo_path") for f in (file, manifest)])).alias("name"))


def bundle_faults(bundles: DataFrame, files: DataFrame, manifests: DataFrame) -> DataFrame:
    """``bundle, name, fault``: files of the layout that are not among ``files (bundle, name)``, and manifests that are not complete."""
    lost = layout(bundles).join(files.select("bundle", "name"), ["bundle", "name"], "left_anti").withColumn("fault", F.lit("missing file"))
    bad = layout(bundles).join(manifests.where(~F.col("complete").eqNullSafe(F.lit("true"))).select("bundle", "name"), ["bundle", "name"]).withColumn("fault", F.lit("incomplete manifest"))
    return lost.unionByName(bad)


#: What two descriptions of a bundle must share.
DESCRIPTION = ["version", "files", "file_sha256", "examples", "source_revisions"]


def description_faults(remote: DataFrame, local: DataFrame) -> DataFrame:
    """``bundle, field``: fields of ``DESCRIPTION`` that differ between two descriptions, absent ones included."""
    both = local.alias("l").join(remote.alias("r"), "bundle", "left")
    return both.select("bundle", F.explode(F.array_compact(F.array(*[F.when(~F.col(f"l.{x}").eqNullSafe(F.col(f"r.{x}")), x) for x in DESCRIPTION]))).alias("field"))


def repository_id_faults(ids: DataFrame, column: str) -> DataFrame:
    """Ids that are not of the form ``namespace/name``."""
    return ids.where(~F.coalesce(safe_repository(F.col(column)), F.lit(False))).select(column)


def output_faults(left: DataFrame, right: DataFrame) -> DataFrame:
    """``probe`` of the probes whose outputs (``probe, outputs array<string>``) are not the same, in the same order, on both sides."""
    l, r = left.alias("l"), right.alias("r")  # noqa: E741
    return l.join(r, F.col("l.probe") == F.col("r.probe"), "full").where(~F.col("l.outputs").eqNullSafe(F.col("r.outputs"))).select(F.coalesce("l.probe", "r.probe").alias("probe"))
