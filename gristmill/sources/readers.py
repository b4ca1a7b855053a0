"""Reading rows, conversations, file trees, reports and settings."""

from __future__ import annotations

import json
import os
import re
from pathlib import Path
from urllib.parse import quote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gristmill.functions.diffs import safe_path
from gristmill.functions.messages import violation

MESSAGES = "array<struct<role:string,content:string>>"
METADATA = (
    "struct<domain:string,generation_algorithm:string,average_test_score:string,old_file:string,new_file:string,license:string,source_language:string,commit:string,"
    "changed_files:array<string>,functions:array<string>,tests:array<string>,position_bucket:int,target_context_tokens:int,repository_tree_truncated:boolean,image_name:string>"
)
#: Schema of the canonical example; declared, so that nothing is inferred and scans are pruned.
EXAMPLE = (
    f"id string, source string, source_id string, repo_id string, language string, task_type string, quality_tier string, split string, messages {MESSAGES}, "
    f"token_count int, content_sha256 string, metadata {METADATA}"
)
INSTRUCTION = "id string, input string, output string, domain string, generation_algorithm string, average_test_score string, llm_judgement string"
COMMIT = "commit string, old_file string, new_file string, old_contents string, new_contents string, subject string, message string, lang string, repos string, license string"

# Names that a language has in the file layout of a source.
COMMIT_DIRS = {"cpp": "c++"}
TASK_SUFFIXES = {"python": "py", "javascript": "js", "typescript": "ts", "cpp": "cpp", "rust": "rs"}


def read_rows(spark: SparkSession, path: str | list[str], schema: str) -> DataFrame:
    """JSON lines or parquet (by suffix) with a declared schema; blank lines are skipped, absent columns are null."""
    paths = [path] if isinstance(path, str) else path
    if all(p.rstrip("/").endswith(".parquet") for p in paths):
        return spark.read.schema(schema).parquet(*paths)
    return spark.read.schema(schema).json(paths)


def read_examples(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Canonical examples from JSON lines."""
    return read_rows(spark, path, EXAMPLE)


def read_valid_examples(spark: SparkSession, path: str | list[str]) -> tuple[DataFrame, DataFrame]:
    """``(examples, faults)``: the canonical examples that keep every rule, and ``id, violation`` of the others."""
    rows = read_examples(spark, path)
    checked = rows.withColumn("violation", violation(F.col("messages"), **{c: F.col(c) for c in ("id", "source", "source_id", "split", "token_count", "content_sha256")}))
    return checked.where("violation is null").drop("violation"), checked.where("violation is not null").select("id", "violation")


def read_by_language(spark: SparkSession, root: str, languages: list[str], schema: str, names: dict[str, str]) -> DataFrame:
    """One scan of a directory for each language below ``root``; adds ``language``.

    ``names`` gives directories that are called otherwise, such as ``c++``; the
    name of the file a row is from may have it percent-encoded.
    """
    if not languages:
        raise ValueError("no language is given")
    folder = {k: names.get(k, k) for k in languages}
    path = F.col("_metadata.file_path")
    found = None
    for name, f in folder.items():
        here = F.contains(path, F.lit(f"/{f}/")) | F.contains(path, F.lit(f"/{quote(f)}/"))
        found = (F if found is None else found).when(here, name)
    return read_rows(spark, [f"{root.rstrip('/')}/{f}" for f in folder.values()], schema).select("*", found.alias("language"))


def read_files(spark: SparkSession, root: str, max_bytes: int) -> DataFrame:
    """``path, content`` of the text files below ``root``: relative safe paths, no NUL, at most ``max_bytes``."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root)
    base = re.escape(root.rstrip("/")).replace("\\/", "/")
    path = F.regexp_replace("path", rf"^.*?{base}/", "")
    ok = (F.col("length") <= max_bytes) & (F.position(F.lit(b"\x00"), F.col("content")) == 0) & safe_path(path)
    return files.where(ok).select(path.alias("path"), F.decode("content", "UTF-8").alias("content"))


def read_report(spark: SparkSession, name: str, path: str) -> DataFrame:
    """``report, section, metric, value`` of a report's JSON: its numbers and flags, one section deep."""
    text = spark.read.text(path, wholetext=True)
    top = text.select(F.explode(F.from_json("value", "map<string,string>")).alias("k", "v"))
    inner = F.from_json("v", "map<string,string>")
    number = lambda c: F.when(c == "true", 1.0).when(c == "false", 0.0).otherwise(c.try_cast("double"))
    root = top.select(F.lit("").alias("section"), F.col("k").alias("metric"), number(F.col("v")).alias("value"))
    deep = top.where(F.col("v").startswith("{")).select(F.col("k").alias("section"), F.explode(inner).alias("metric", "v")).select("section", "metric", number(F.col("v")).alias("value"))
    return root.unionByName(deep).where("value is not null").select(F.lit(name).alias("report"), "*")


def merge_settings(*layers: dict) -> dict:
    """Nested mappings merged from left to right; a later value wins, mappings are merged."""
    out: dict = {}
    for layer in layers:
        if not isinstance(layer, dict):
            raise ValueError("settings must be a mapping")
        for k, v in layer.items():
            out[k] = merge_settings(out[k], v) if isinstance(v, dict) and isinstance(out.get(k), dict) else v
    return out


def load_settings(*paths: str) -> dict:
    """Settings of JSON files, and of YAML files where a YAML library is installed, merged in order."""
    layers = []
    for p in paths:
        text = Path(p).read_text(encoding="utf-8")
        if p.endswith(".json"):
            layers.append(json.loads(text))
        else:
            try:
                import yaml
            except ImportError as e:
                raise RuntimeError("reading YAML needs a YAML library; give JSON") from e
            layers.append(yaml.safe_load(text) or {})
    return merge_settings(*layers)


def expand(value):
    """Environment variables expanded in every string of a nested value."""
    if isinstance(value, dict):
        return {k: expand(v) for k, v in value.items()}
    if isinstance(value, list):
        return [expand(v) for v in value]
    return os.path.expandvars(value) if isinstance(value, str) else value
