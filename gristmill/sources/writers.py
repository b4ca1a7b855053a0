"""Writing examples and manifests, and bundles of files with their hashes."""

from __future__ import annotations

import json
import os
import re
from pathlib import Path

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


def guard(path: str) -> str:
    """The path, if it is safe to write to: resolved, neither root nor home, at least three levels deep."""
    full = os.path.abspath(os.path.expanduser(re.sub(r"^[a-z][a-z0-9+.-]*://[^/]*", "", path)))
    if "$" in path or full in ("/", os.path.expanduser("~")) or len(Path(full).parts) < (4 if full == os.path.abspath(os.path.expanduser(path.removeprefix("file://"))) else 2):
        raise ValueError(f"refusing to write to {path!r}")
    return path


def write_examples(df: DataFrame, path: str, order: list | None = None, one_file: bool = False) -> int:
    """JSON lines in ``order``; returns the number of rows, observed while writing, without a second pass.

    By default every task writes its range, so the files in name order are the
    order; one file only where the caller knows that it is small.
    """
    seen = Observation()
    out = df.orderBy(*order) if order else df
    out = out.coalesce(1) if one_file else out
    out.observe(seen, F.count(F.lit(1)).alias("n")).write.mode("overwrite").json(guard(path))
    return int(seen.get["n"])


def _file_system(path: str):
    """Hadoop file system and path, so that any scheme the cluster knows can be written."""
    spark = SparkSession.active()
    full = spark._jvm.org.apache.hadoop.fs.Path(path)
    return full.getFileSystem(spark._jsc.hadoopConfiguration()), full


def write_text(text: str, path: str) -> None:
    """A small file, on whatever file system the path names; its folders are made."""
    fs, full = _file_system(guard(path))
    out = fs.create(full, True)
    try:
        out.write(bytearray(text, "utf-8"))
    finally:
        out.close()


def write_json(value: dict, path: str) -> None:
    """A small document, keys sorted, indented by two."""
    write_text(json.dumps(value, indent=2, sort_keys=True), path)


def write_settings(settings: dict, path: str) -> None:
    """Resolved settings as YAML in their order where a YAML library is installed, else as JSON."""
    try:
        import yaml

        write_text(yaml.safe_dump(settings, sort_keys=False), path)
    except ImportError:
        write_json(settings, path)


def write_if_complete(df: DataFrame, expected: int, path: str, manifest: dict, manifest_path: str) -> int:
    """Data only if it has the expected number of rows; the manifest always; then an error if it has not.

    The rows are counted while they are written beside the target, which is renamed to it only when it is complete: the plan runs once.
    """
    beside = f"{guard(path).rstrip('/')}.incomplete"
    n = write_examples(df, beside)
    write_json(manifest | {"complete": n == expected, "examples": n, "expected": expected}, manifest_path)
    fs, from_ = _file_system(beside)
    if n != expected:
        fs.delete(from_, True)
        raise RuntimeError(f"{n} of {expected} examples: the manifest is written, the data is not")
    _, to = _file_system(path)
    fs.delete(to, True)
    if not fs.rename(from_, to):
        raise RuntimeError(f"{beside} is complete, but cannot be renamed")
    return n


def bundle(spark: SparkSession, files: list[str]) -> DataFrame:
    """``name, sha256, bytes`` of the files of a bundle; a missing file is an error."""
    got = spark.read.format("binaryFile").load(files)
    return got.select(F.substring_index("path", "/", -1).alias("name"), F.sha2("content", 256).alias("sha256"), F.col("length").alias("bytes"))


def bundle_differences(left: DataFrame, right: DataFrame) -> DataFrame:
    """``name`` of every file that only one of two bundles has, or whose hash or size differs."""
    l, r = left.alias("l"), right.alias("r")  # noqa: E741
    same = F.col("l.sha256").eqNullSafe(F.col("r.sha256")) & F.col("l.bytes").eqNullSafe(F.col("r.bytes"))
    return l.join(r, F.col("l.name") == F.col("r.name"), "full").where(~same).select(F.coalesce("l.name", "r.name").alias("name"))
