"""Unified diffs and what they say about files and functions."""

from __future__ import annotations

import difflib

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from gristmill.functions.text import SPACE

# The headers of a diff and the names in them.
GIT_HEADER = r"(?dm)^diff --git a/(.*?) b/(.*?)$"
NEW_FILE = r"(?dm)^\+\+\+ b/(.*?)$"
HUNK = r"(?dm)^@@.*?@@\s*(.*)$"
NAMED = r"(?:def|class|function|func|fn)\s+([A-Za-z_$][\p{L}\p{N}_$]*)|(?:[\p{L}\p{N}_:<>,*&]+\s+)+([A-Za-z_$][\p{L}\p{N}_$]*)\s*\("


def unified_diff(old: Column, new: Column, old_file: Column, new_file: Column) -> Column:
    """Diff with three lines of context and ``a/``, ``b/`` names; empty where nothing changes, nulls as empty text.

    No built-in finds the matching blocks, so whole batches go to ``difflib`` as Arrow.
    """

    @F.arrow_udf("string")
    def diff(a: pa.Array, b: pa.Array, fa: pa.Array, fb: pa.Array) -> pa.Array:
        rows = zip(*(x.to_pylist() for x in (a, b, fa, fb)))
        return pa.array(
            ["".join(difflib.unified_diff((x or "").splitlines(True), (y or "").splitlines(True), f"a/{p or 'file'}", f"b/{q or p or 'file'}")) for x, y, p, q in rows],
            pa.string(),
        )

    return diff(old, new, old_file, new_file)


def changed_files(patch: Column) -> Column:
    """Files a patch changes, each once, in order: by git headers, else by ``+++`` lines without ``/dev/null``."""
    git = F.regexp_extract_all(patch, F.lit(GIT_HEADER), 2)
    plain = F.filter(F.regexp_extract_all(patch, F.lit(NEW_FILE), 1), lambda x: x != "/dev/null")
    return F.array_distinct(F.when(F.size(git) > 0, git).otherwise(plain))


def changed_functions(patch: Column) -> Column:
    """Functions and classes that the hunk headers name, each once, in order."""
    headers = F.regexp_extract_all(patch, F.lit(HUNK), 1)
    named = F.transform(headers, lambda h: F.coalesce(*[F.nullif(F.regexp_extract(h, NAMED, k), F.lit("")) for k in (1, 2)]))
    return F.array_distinct(F.filter(named, lambda x: x.isNotNull()))


def test_paths(fail_to_pass: Column, pass_to_pass: Column) -> Column:
    """Test files: what stands before ``::``, each once, in order; nulls and empty names out."""
    none = F.array().cast("array<string>")
    both = F.concat(F.coalesce(fail_to_pass, none), F.coalesce(pass_to_pass, none))
    return F.array_distinct(F.transform(F.filter(both, lambda x: x.isNotNull() & (x != "")), lambda x: F.substring_index(x, "::", 1)))


def revision(repo: Column) -> Column:
    """``struct<github_repo, commit>`` of ``swesmith/owner__name.commit``; null where it is no safe identifier."""
    part = lambda k: F.regexp_extract(F.coalesce(repo, F.lit("")), r"\A(?:swesmith/)?(.*?)__(.*)\.([^.]*)\z", k)
    name, commit = F.concat(part(1), F.lit("/"), part(2)), F.lower(part(3))
    return F.when(safe_repository(name) & commit.rlike(r"\A[0-9a-f]{7,40}\z"), F.struct(name.alias("github_repo"), commit.alias("commit")))


def safe_repository(c: Column) -> Column:
    """``owner/name`` of letters, digits, ``_``, ``.`` and ``-`` only."""
    return c.rlike(r"\A[A-Za-z0-9_.-]+/[A-Za-z0-9_.-]+\z")


def safe_path(c: Column) -> Column:
    """Neither absolute nor with a ``..`` part."""
    return ~c.startswith("/") & ~F.array_contains(F.split(c, "/"), "..")


def is_diff(patch: Column) -> Column:
    """Has both file headers of a unified diff."""
    return patch.rlike(r"(?dm)^--- ") & patch.rlike(r"(?dm)^\+\+\+ ")


def file_precision(expected: Column, predicted: Column) -> Column:
    """Share of the predicted files that were expected; 0 where none is predicted."""
    p = F.array_distinct(predicted)
    return F.when(F.size(p) > 0, F.size(F.array_intersect(expected, p)) / F.size(p)).otherwise(0.0)


_IMPORTS = [
    r"(?:from|import)\s+([A-Za-z_][\p{L}\p{N}_.]*)", r"(?:require\(|from\s+)[\"']([^\"']+)[\"']",
    r"#include\s*[<\"]([^>\"]+)[>\"]", r"(?:use|mod)\s+([A-Za-z_][\p{L}\p{N}_:]*)",
]  # fmt: skip  # Fixed values: how sources name what they use.


def referenced_names(content: Column) -> Column:
    """Identifiers that imports, includes and uses name, parted at ``.``, ``/`` and ``:``."""
    found = F.concat(*[F.regexp_extract_all(content, F.lit(p), 1) for p in _IMPORTS])
    return F.array_distinct(F.filter(F.flatten(F.transform(found, lambda x: F.split(x, "[./:]"))), lambda x: x != ""))


def file_block(path: Column, content: Column, language: Column) -> Column:
    """A file as a titled fenced block."""
    return F.concat(F.lit("### FILE: "), path, F.lit("\n```"), language, F.lit("\n"), content, F.lit("\n```"))
