"""Repository tasks: from an issue, a patch and a snapshot's files to a bounded prompt."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from gristmill.functions import diffs, language
from gristmill.functions.hashing import DEFAULT_SEED, hash_bucket, hash_hex, hash_split
from gristmill.functions.messages import make_messages, message_tokens
from gristmill.functions.text import strip, token_count, truncate_tokens

# What each kind of task asks for, and the share of other files before the changed ones.
INSTRUCTIONS = {
    "file_localization": "Rank the files that must change. Return only a numbered file list.",
    "function_localization": "Rank the functions or classes that must change. Return only a numbered list.",
    "test_localization": "List the tests that validate this issue. Return only a numbered test list.",
    "patch_generation": "Produce the smallest correct unified diff and no unrelated changes.",
}
RATIOS = [0.1, 0.3, 0.5, 0.7, 0.9]
MOST_FILES, TREE_PATHS, LEAST_BLOCK, RESERVE, LEAST_CONTEXT = 80, 4000, 64, 256, 512


def task_type(source_id: Column, functions: Column, tests: Column, seed: int = DEFAULT_SEED) -> Column:
    """Kind of task by hash bucket (40, 20, 30 and 10 of 100); a patch where there is nothing to name."""
    b = hash_bucket(source_id, 100, seed)
    return (
        F.when(b < 40, "file_localization").when((b < 60) & (F.size(functions) > 0), "function_localization")
        .when(b < 90, "patch_generation").when(F.size(tests) > 0, "test_localization").when(b.isNotNull(), "patch_generation")
    )


def position_bucket(source_id: Column, seed: int = DEFAULT_SEED) -> Column:
    """0 to 4: how late the changed files stand in the context."""
    return hash_bucket(F.concat(F.lit("position:"), source_id), 5, seed).cast("int")


def target_tokens(source_id: Column, seed: int = DEFAULT_SEED) -> Column:
    """16,384, 24,576 or 32,768 tokens for 6, 2 and 2 of 10 hash buckets."""
    b = hash_bucket(F.concat(F.lit("length:"), source_id), 10, seed)
    return F.when(b < 6, 16384).when(b < 8, 24576).when(b.isNotNull(), 32768)


def _numbered(values: Column) -> Column:
    return F.array_join(F.transform(values, lambda x, i: F.concat((i + 1).cast("string"), F.lit(". "), x)), "\n")


def response(kind: Column, patch: Column, files: Column, functions: Column, tests: Column) -> Column:
    """The answer: a numbered list, or the stripped patch."""
    return (
        F.when(kind == "file_localization", _numbered(files)).when(kind == "function_localization", _numbered(functions))
        .when(kind == "test_localization", _numbered(tests)).otherwise(strip(patch))
    )


def arrange(relevant: Column, others: Column, bucket: Column) -> Column:
    """The changed files spliced into the others at the bucket's ratio, rounded half to even."""
    ratio = F.element_at(F.array(*[F.lit(r) for r in RATIOS]), bucket + 1)
    before = F.bround(F.size(others) * ratio, 0).cast("int")
    return F.concat(F.slice(others, F.lit(1), before), relevant, F.slice(others, before + 1, F.size(others)))


def pack_blocks(blocks: Column, budget: Column) -> Column:
    """Fold over ``array<struct<path, text>>``: each cut to its share and to what is left, skipped where it does not fit.

    The fold stops when less than ``LEAST_BLOCK`` tokens are left.  Every step
    depends on what the cut before it left, so no window sum expresses it; whole
    batches are folded as Arrow, with white-space tokens.
    """

    @F.arrow_udf("array<struct<path:string,text:string>>")
    def fold(col: pa.Array, budgets: pa.Array) -> pa.Array:
        out = []
        for items, budget in zip(col.to_pylist(), budgets.to_pylist()):
            if items is None or budget is None:
                out.append(None)
                continue
            share, used, kept = max(LEAST_BLOCK, budget // max(1, len(items))), 0, []
            for item in items:
                limit = min(share, budget - used)
                t = item["text"].split()
                text, n = item["text"], len(t)
                if n > limit:
                    if limit < 32:
                        text, n = " ".join(t[:limit]), max(0, limit)
                    else:
                        left = limit * 2 // 3
                        text = " ".join(t[:left]) + "\n...<TRUNCATED>...\n" + " ".join(t[left - limit :])
                        n = limit + 1
                if n <= 0 or used + n > budget:
                    continue
                kept.append({"path": item["path"], "text": text})
                used += n
                if budget - used < LEAST_BLOCK:
                    break
            out.append(kept)
        return pa.array(out, pa.list_(pa.struct([("path", pa.string()), ("text", pa.string())])))

    return fold(blocks, budget)


def task_rows(tasks: DataFrame, seed: int = DEFAULT_SEED) -> DataFrame:
    """What the task rows alone tell: revision, changed files, functions, tests, kind, buckets; ``skip`` names a fault."""
    d = tasks.withColumn("rev", diffs.revision(F.col("repo"))).withColumn("patch", F.coalesce("patch", F.lit("")))
    d = d.withColumn("changed_files", diffs.changed_files(F.col("patch"))).withColumn("functions", diffs.changed_functions(F.col("patch")))
    d = d.withColumn("tests", diffs.test_paths(F.col("fail_to_pass"), F.col("pass_to_pass")))
    d = d.withColumn("source_id", F.coalesce(F.nullif(F.col("instance_id"), F.lit("")), F.concat("rev.github_repo", F.lit(":"), "rev.commit")))
    skip = F.when(F.col("rev").isNull(), "unsafe repository").when(F.size("changed_files") == 0, "no changed files")
    sid = F.col("source_id")
    return d.withColumn("skip", skip).select(
        "source_id", "rev", "patch", "problem_statement", "image_name", "changed_files", "functions", "tests", "skip", task_type(sid, F.col("functions"), F.col("tests"), seed).alias("task_type"),
        position_bucket(sid, seed).alias("position_bucket"), target_tokens(sid, seed).alias("target_tokens"), hash_split(F.col("rev.github_repo"), seed).alias("split"),
    )


def dependencies(files: DataFrame, relevant: DataFrame) -> DataFrame:
    """``source_id, path`` of the files whose stem a changed file's imports name, changed files left out.

    ``files``: ``source_id, path``; ``relevant``: ``source_id, path, content``.
    """
    named = relevant.select("source_id", F.explode(diffs.referenced_names(F.col("content"))).alias("stem")).distinct()
    stem = F.regexp_replace(F.regexp_extract("path", r"([^/]*)\z", 1), r"(?<=.)\.[^.]*\z", "")
    return files.withColumn("stem", stem).join(named, ["source_id", "stem"], "left_semi").select("source_id", "path").join(relevant.select("source_id", "path"), ["source_id", "path"], "left_anti")


def sound_tasks(tasks: DataFrame, lang: str | None = None, seed: int = DEFAULT_SEED) -> tuple[DataFrame, DataFrame]:
    """:func:`task_rows` with ``lang``, and of the tasks without a fault what their files are joined on.

    Without a given language a task has that of its first changed file.
    """
    own = F.lit(lang) if lang else language.path_language(F.try_element_at("changed_files", F.lit(1)))
    t = task_rows(tasks, seed).withColumn("lang", own)
    return t, t.where("skip is null").select("source_id", F.col("rev.github_repo").alias("repo"), F.col("rev.commit").alias("commit"), "changed_files", "tests", "lang")


def context_paths(good: DataFrame, files: DataFrame, seed: int = DEFAULT_SEED, max_bytes: int = 200_000) -> tuple[DataFrame, DataFrame]:
    """``(chosen, trees)`` for sound tasks over ``files (repo, commit, path, content)``.

    ``chosen``: ``source_id, repo, commit, path, relevant, place``: the readable
    changed files in the order of the patch, and of the others at most
    ``MOST_FILES``: tests in their order, dependencies by path, files of the task's
    language by hash.  ``trees``: ``source_id, paths``, the first ``TREE_PATHS``.
    Paths alone are ranked; the only contents that are read are those of the
    changed files, for their imports.
    """
    readable = (F.length("content") <= max_bytes) & ~F.contains("content", F.lit("\x00")) & diffs.safe_path(F.col("path"))
    listed = files.select("repo", "commit", "path", readable.alias("readable")).distinct()
    have = good.join(listed, ["repo", "commit"])
    first = have.select("source_id", "path").distinct().withColumn("_p", F.row_number().over(W.partitionBy("source_id").orderBy("path"))).where(F.col("_p") <= TREE_PATHS)
    trees = first.groupBy("source_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("_p", "path"))), lambda x: x.path).alias("paths"))
    at = F.array_position("changed_files", F.col("path"))
    changed = have.where(F.col("readable") & (at > 0)).select("source_id", "repo", "commit", "path", F.lit(True).alias("relevant"), at.cast("int").alias("place"))
    contents = changed.join(files.select("repo", "commit", "path", "content"), ["repo", "commit", "path"])
    deps = dependencies(have.select("source_id", "path"), contents.select("source_id", "path", "content")).distinct().withColumn("dep", F.lit(True))
    rest = have.where(F.col("readable") & (at == 0)).join(deps, ["source_id", "path"], "left")
    test_at = F.array_position("tests", F.col("path"))
    kind = F.when(test_at > 0, 0).when(F.col("dep"), 1).when(language.path_language(F.col("path")) == F.col("lang"), 2)
    order = F.when(kind == 0, F.lpad(test_at.cast("string"), 12, "0")).when(kind == 1, F.col("path")).otherwise(hash_hex(F.concat("source_id", F.lit(":"), "path"), seed))
    ranked = rest.withColumn("c", kind).where("c is not null").withColumn("o", order)
    ranked = ranked.withColumn("place", F.row_number().over(W.partitionBy("source_id").orderBy("c", "o", "path"))).where(F.col("place") <= MOST_FILES)
    return changed.unionByName(ranked.select("source_id", "repo", "commit", "path", F.lit(False).alias("relevant"), "place")), trees


def build(tasks: DataFrame, files: DataFrame, lang: str | None = None, seed: int = DEFAULT_SEED, max_bytes: int = 200_000) -> DataFrame:
    """Examples of tasks over ``files (repo, commit, path, content)``, unique by path; a faulty task keeps its ``skip`` instead.

    Files are joined on repository and commit, ranked by path and cut before any
    content is gathered (:func:`context_paths`).
    """
    t, good = sound_tasks(tasks, lang, seed)
    chosen, trees = context_paths(good, files, seed, max_bytes)
    texts = chosen.join(files.select("repo", "commit", "path", "content"), ["repo", "commit", "path"])
    block = F.struct("path", diffs.file_block(F.col("path"), F.col("content"), language.path_language(F.col("path"))).alias("text"))
    entry = F.struct("place", block.alias("b"))
    in_order = lambda c: F.transform(F.array_sort(F.collect_list(F.when(c, entry))), lambda x: x.b)
    lists = texts.groupBy("source_id").agg(in_order(F.col("relevant")).alias("relevant"), in_order(~F.col("relevant")).alias("others"))
    d = t.join(trees, "source_id", "left").join(lists, "source_id", "left")
    empty = F.array().cast("array<struct<path:string,text:string>>")
    d = d.withColumn("others", F.coalesce("others", empty)).withColumn("skip", F.coalesce("skip", F.when(F.coalesce(F.size("relevant"), F.lit(0)) <= 0, "no readable changed files")))
    raw = F.array_join(F.coalesce("paths", F.array().cast("array<string>")), "\n")
    d = d.withColumn("raw_tree", raw).withColumn("tree", truncate_tokens(raw, F.greatest(F.lit(512), F.floor(F.col("target_tokens") / 8)).cast("int")))
    instruct = F.create_map(*[F.lit(x) for kv in INSTRUCTIONS.items() for x in kv])[F.col("task_type")]
    # Fixed value: the layout of the prompt.
    fixed = F.concat(F.lit("Repository: "), "rev.github_repo", F.lit("@"), "rev.commit", F.lit("\n\nRepository tree:\n"), "tree", F.lit("\n\nIssue:\n"), strip(F.coalesce("problem_statement", F.lit(""))), F.lit("\n\nTask:\n"), instruct, F.lit("\n\nRepository context:\n"))
    d = d.withColumn("fixed", fixed).withColumn("answer", response(F.col("task_type"), F.col("patch"), F.col("changed_files"), F.col("functions"), F.col("tests")))
    d = d.withColumn("budget", (F.col("target_tokens") - token_count(F.col("answer")) - token_count(F.col("fixed")) - RESERVE).cast("int"))
    d = d.withColumn("skip", F.coalesce("skip", F.when(F.col("budget") < LEAST_CONTEXT, "no room for the context")))
    packed = F.when(F.col("skip").isNull(), arrange(F.col("relevant"), F.col("others"), F.col("position_bucket")))
    d = d.withColumn("packed", pack_blocks(packed, F.col("budget")))
    lost = F.size(F.array_except(F.transform("relevant", lambda b: b.path), F.transform("packed", lambda b: b.path))) > 0
    d = d.withColumn("skip", F.coalesce("skip", F.when(lost, "budget omitted changed files")))
    messages = make_messages(F.concat("fixed", F.array_join(F.transform("packed", lambda b: b.text), "\n\n")), F.col("answer"))
    d = d.withColumn("messages", F.when(F.col("skip").isNull(), messages)).withColumn("token_count", message_tokens(F.col("messages")))
    d = d.withColumn("skip", F.coalesce("skip", F.when(F.col("token_count") > F.col("target_tokens"), "longer than the target")))
    return d.select(
        F.concat(F.lit("swesmith:"), "source_id", F.lit(":"), "task_type").alias("id"), F.lit("swe_smith").alias("source"), "source_id", F.col("rev.github_repo").alias("repo_id"),
        F.col("lang").alias("language"), "task_type", F.lit("executable_source").alias("quality_tier"), "split", "messages", "token_count", "skip",
        F.struct(F.col("rev.commit").alias("commit"), "changed_files", "functions", "tests", "position_bucket", F.col("target_tokens").alias("target_context_tokens"), (F.col("tree") != F.col("raw_tree")).alias("repository_tree_truncated"), "image_name").alias("metadata"),
    )
