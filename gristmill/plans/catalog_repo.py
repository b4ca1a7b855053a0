"""Queries over repository tasks, and the SQL that says the same.

The task rows name revisions, not their files, so the queries take a tree that
is made of the rows themselves: the files a patch changes, the tests it is
judged by, and a few fixed files of every repository.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gristmill.functions import diffs, language
from gristmill.operators import sampling, stats
from gristmill.plans import mixture, repo_context
from gristmill.plans.catalog import _GIT, _HEADS, _NEW, _ORDERED, _REPO, _TEST_PATHS, _hex, _mod, _quote, _split, _strip, query
from gristmill.session import table

#: Files that every repository of the queries has.
LIBRARY = {
    "README.md": "A tool.", "src/helpers.py": "def help(): ...", "src/shapes.py": "import helpers", "lib/helpers.js": "export const h = 1;", "lib/wheel.ts": "import { h } from './helpers'",
    "core/engine.go": "package core", "core/gear.rs": "mod gear;", "app/Main.java": "class Main {}", "app/frame.cpp": "#include <frame.h>", "tools/run.sh": "echo run", "db/tables.sql": "select 1", "../outside.py": "no",
}


def tasks(spark: SparkSession, d: str) -> DataFrame:
    return mixture.latest(table(spark, d, "repo_tasks"), ["instance_id"])


def tree(rows: DataFrame) -> DataFrame:
    """``repo, commit, path, content`` of the tree that the task rows stand for."""
    of = repo_context.task_rows(rows).where("rev is not null").select(F.col("rev.github_repo").alias("repo"), F.col("rev.commit").alias("commit"), "changed_files", "tests", "patch")
    changed = of.select("repo", "commit", F.explode("changed_files").alias("path"), F.concat(F.lit("import helpers\n"), "patch").alias("content"))
    tests = of.select("repo", "commit", F.explode("tests").alias("path")).withColumn("content", F.concat(F.lit("use "), "path"))
    fixed = F.explode(F.array(*[F.struct(F.lit(k).alias("path"), F.lit(v).alias("content")) for k, v in LIBRARY.items()]))
    shared = of.select("repo", "commit").distinct().select("repo", "commit", fixed.alias("f")).select("repo", "commit", "f.*")
    return changed.unionByName(tests).unionByName(shared).groupBy("repo", "commit", "path").agg(F.min("content").alias("content"))


_PATH_LANGUAGE = (
    "case " + " ".join(f"when lower(regexp_extract(regexp_extract({{0}}, '([^/]*)/*$', 1), '^.+(\\.[^.]+)$', 1)) in ({', '.join(map(_quote, v))}) then '{k}'" for k, v in language.SUFFIXES.items()) + " else 'unknown' end"
)


def _path_language(c: str) -> str:
    return _PATH_LANGUAGE.replace("{0}", c)


_CHANGED = _ORDERED.format(f"(case when len({_GIT}) > 0 then {_GIT} else {_NEW} end)")
_TESTS = _ORDERED.format(f"list_transform({_TEST_PATHS}, lambda x: split_part(x, '::', 1))")
_IMPORTED = "list_concat(" + ", ".join(f"regexp_extract_all(content, {_quote(p)}, 1)" for p in diffs._IMPORTS) + ")"
_BUCKETS = f"""{_mod('instance_id', 100)} as b, {_mod("'position:' || instance_id", 5)}::int as position_bucket, {_mod("'length:' || instance_id", 10)} as l"""
#: Tasks without a fault, their tree, and the files chosen for each.
_CONTEXT = rf"""
with recursive one as (select distinct on (instance_id) * exclude (patch), coalesce(patch, '') as patch from repo_tasks where instance_id <> '' order by instance_id, loaded_at),
parsed as (select instance_id as source_id, {_REPO.format(1)} || '/' || {_REPO.format(2)} as repo, lower({_REPO.format(3)}) as commit, {_CHANGED} as changed, {_TESTS} as tests,
  {_ORDERED.format(f'list_filter({_HEADS}, lambda x: x is not null)')} as functions, patch, problem_statement, {_BUCKETS} from one),
task as (select *, case when b < 40 then 'file_localization' when b < 60 and len(functions) > 0 then 'function_localization' when b < 90 then 'patch_generation' when len(tests) > 0 then 'test_localization' else 'patch_generation' end as task_type,
  case when l < 6 then 16384 when l < 8 then 24576 else 32768 end as target, {_path_language('changed[1]')} as lang from parsed
  where regexp_full_match(repo, '[A-Za-z0-9_.-]+/[A-Za-z0-9_.-]+') and regexp_full_match(commit, '[0-9a-f]{{7,40}}')),
files as (select repo, commit, path, min(content) as content, min(content) is not null and path not like '/%' and not list_contains(string_split(path, '/'), '..') as readable from (
  select repo, commit, unnest(changed) as path, 'import helpers' || chr(10) || patch as content from task union all
  select repo, commit, path, 'use ' || path from (select repo, commit, unnest(tests) as path from task) union all
  select repo, commit, path, content from (select distinct repo, commit from task), (values {', '.join(f'({_quote(k)}, {_quote(v)})' for k, v in LIBRARY.items())}) l(path, content)) group by repo, commit, path),
sound as (select * from task where len(changed) > 0),
have as (select source_id, changed, tests, lang, files.* from sound join files using (repo, commit)),
relevant as (select source_id, path, content, list_position(changed, path) as place from have where readable and list_contains(changed, path)),
stems as (select distinct source_id, unnest(flatten(list_transform({_IMPORTED}, lambda x: string_split_regex(x, '[./:]')))) as stem from relevant),
kinds as (select have.source_id, path, content, tests, case when list_contains(tests, path) then 0 when stem is not null then 1 when {_path_language('path')} = lang then 2 end as c
  from have left join stems on stems.source_id = have.source_id and stem <> '' and stem = regexp_replace(regexp_extract(path, '([^/]*)$', 1), '^(.+)\.[^.]*$', '\1') where readable and not list_contains(changed, path)),
others as (select source_id, path, content, row_number() over (partition by source_id order by c, case c when 0 then lpad(list_position(tests, path)::varchar, 12, '0') when 1 then path else {_hex("(source_id || ':' || path)")} end, path) as place from kinds where c is not null),
chosen as (select source_id, path, content, true as relevant, place from relevant union all select source_id, path, content, false, place from others where place <= {repo_context.MOST_FILES})
"""


@query(_CONTEXT + "select source_id, path, relevant, place::int as place from chosen")
def repo_context_paths(spark, d):
    rows = tasks(spark, d)
    _, good = repo_context.sound_tasks(rows)
    return repo_context.context_paths(good, tree(rows))[0].select("source_id", "path", "relevant", "place")


@query(_CONTEXT + f", listed as (select source_id, path, row_number() over (partition by source_id order by path) as k from have) select source_id, array_to_string(list(path order by path), chr(10)) as tree from listed where k <= {repo_context.TREE_PATHS} group by source_id")
def repo_trees(spark, d):
    rows = tasks(spark, d)
    _, good = repo_context.sound_tasks(rows)
    return repo_context.context_paths(good, tree(rows))[1].select("source_id", F.array_join("paths", "\n").alias("tree"))


_ARRANGED = """, lists as (select sound.source_id, position_bucket, coalesce(list({0} order by place) filter (where relevant), []) as r, coalesce(list({0} order by place) filter (where not relevant), []) as o from sound join chosen using (source_id) group by all),
arranged as (select source_id, list_concat(o[1:n], r, o[n + 1:]) as arranged from (select *, round_even(len(o) * [0.1, 0.3, 0.5, 0.7, 0.9][position_bucket + 1], 0)::int as n from lists) where len(r) > 0)
"""


@query(_CONTEXT + _ARRANGED.format("path") + "select source_id, arranged from arranged")
def repo_arranged(spark, d):
    rows = tasks(spark, d)
    t, good = repo_context.sound_tasks(rows)
    chosen = repo_context.context_paths(good, tree(rows))[0]
    of = lambda c: F.transform(F.array_sort(F.collect_list(F.when(c, F.struct("place", "path")))), lambda x: x.path)
    lists = chosen.groupBy("source_id").agg(of(F.col("relevant")).alias("r"), of(~F.col("relevant")).alias("o")).where(F.size("r") > 0)
    return lists.join(t.select("source_id", "position_bucket"), "source_id").select("source_id", repo_context.arrange(F.col("r"), F.col("o"), F.col("position_bucket")).alias("arranged"))


_TOKENS = rf"case when {_strip('{0}')} = '' then 0 else len(string_split_regex({_strip('{0}')}, '[\s\x1c-\x1f\x85\p{{{{Z}}}}]+')) end"


def _tokens(c: str) -> str:
    return _TOKENS.replace("{0}", c).replace("{{", "{").replace("}}", "}")


_NUMBERED = "array_to_string(list_transform({0}, lambda x, i: i::varchar || '. ' || x), chr(10))"
_LEFT = "least(greatest(64, budget // greatest(1, len(arranged))), budget - acc.used)"
_MARK = "chr(10) || '...<TRUNCATED>...' || chr(10)"
#: The fold over the blocks: each cut to its share and to what is left, skipped where it does not fit, until hardly anything is left.
_CUT = f"""case when len(x.w) <= {_LEFT} then {{'n': len(x.w), 'text': x.text}} when {_LEFT} < 32 then {{'n': greatest(0, {_LEFT}), 'text': array_to_string(x.w[1:{_LEFT}], ' ')}}
  else {{'n': {_LEFT} + 1, 'text': array_to_string(x.w[1:{_LEFT} * 2 // 3], ' ') || {_MARK} || array_to_string(x.w[len(x.w) - ({_LEFT} - {_LEFT} * 2 // 3) + 1:], ' ')}} end"""
_BLOCK = f"{{'path': path, 'text': '### FILE: ' || path || chr(10) || '```' || {_path_language('path')} || chr(10) || content || chr(10) || '```'}}"


@query(
    _CONTEXT
    + _ARRANGED.format(_BLOCK)
    + rf""", trees as (select source_id, array_to_string(list(path order by path), chr(10)) as raw from (select source_id, path, row_number() over (partition by source_id order by path) as k from have) where k <= {repo_context.TREE_PATHS} group by source_id),
    heads as (select sound.*, case task_type {' '.join(f'when {_quote(k)} then {_quote(v)}' for k, v in repo_context.INSTRUCTIONS.items())} end as instruct, raw as tree,
      case task_type when 'file_localization' then {_NUMBERED.format('changed')} when 'function_localization' then {_NUMBERED.format('functions')} when 'test_localization' then {_NUMBERED.format('tests')} else {_strip('patch')} end as answer
      from sound join trees using (source_id) where {_tokens('raw')} <= greatest(512, target // 8)),
    fixed as (select *, 'Repository: ' || repo || '@' || commit || chr(10) || chr(10) || 'Repository tree:' || chr(10) || tree || chr(10) || chr(10) || 'Issue:' || chr(10) || {_strip("coalesce(problem_statement, '')")} || chr(10) || chr(10) || 'Task:' || chr(10) || instruct
      || chr(10) || chr(10) || 'Repository context:' || chr(10) as fixed from heads),
    budgets as (select source_id, task_type, fixed, answer, target - {_tokens('answer')} - {_tokens('fixed')} - {repo_context.RESERVE} as budget,
      list_transform(arranged, lambda x: {{'text': x.text, 'w': string_split_regex({_strip('x.text')}, '[\s]+')}}) as arranged from fixed join arranged using (source_id)),
    folded as (select *, list_reduce(arranged, lambda acc, x: case when acc.stop then acc else [case when cut.n <= 0 or acc.used + cut.n > budget then acc
        else {{'used': acc.used + cut.n, 'stop': budget - acc.used - cut.n < {repo_context.LEAST_BLOCK}, 'kept': list_append(acc.kept, cut.text)}} end for cut in [{_CUT}]][1] end,
        {{'used': 0::bigint, 'stop': false, 'kept': []::varchar[]}}) as pack from budgets where budget >= {repo_context.LEAST_CONTEXT})
    select source_id, task_type, sha256({_strip("fixed || array_to_string(pack.kept, chr(10) || chr(10))")}) as prompt, sha256({_strip('answer')}) as answer from folded"""
)
def repo_examples(spark, d):
    rows = tasks(spark, d)
    e = repo_context.build(rows, tree(rows)).where("skip is null")
    return e.select("source_id", "task_type", F.sha2(F.col("messages")[1]["content"], 256).alias("prompt"), F.sha2(F.col("messages")[2]["content"], 256).alias("answer"))


@query(_CONTEXT + f""", all_tasks as (select *, {_split('repo')} as split from sound) select split, lang as language, task_type, position_bucket, count(*) as n from all_tasks group by all""")
def repo_counts(spark, d):
    rows = tasks(spark, d)
    t, _ = repo_context.sound_tasks(rows)
    return t.where("skip is null").groupBy("split", F.col("lang").alias("language"), "task_type", "position_bucket").agg(F.count("*").alias("n"))


@query(
    f"""with one as (select distinct on (instance_id) * exclude (patch), coalesce(patch, '') as patch from repo_tasks order by instance_id, loaded_at),
    p as (select instance_id, {_REPO.format(1)} || '/' || {_REPO.format(2)} as name, lower({_REPO.format(3)}) as c, {_CHANGED} as changed from one),
    s as (select case when not (regexp_full_match(name, '[A-Za-z0-9_.-]+/[A-Za-z0-9_.-]+') and regexp_full_match(c, '[0-9a-f]{{7,40}}')) then 'unsafe repository' when len(changed) = 0 then 'no changed files' else 'none' end as skip from p)
    select skip, count(*) as n from s group by skip"""
)
def task_skips(spark, d):
    return stats.skips(repo_context.task_rows(tasks(spark, d)).withColumn("skip", F.coalesce("skip", F.lit("none"))), "skip", "source_id", ["source_id"])[0]


#: Wanted rows of each split and shares of the languages; the shares of the rare ones are more than there is.
DESIRED = {"train": 400, "validation": 30, "test": 30}
SHARES = {"python": 0.3, "rust": 0.3, "go": 0.2, "sql": 0.2}
_TARGETS = [(s, k, n) for s, total in DESIRED.items() for k, n in sampling.largest_remainder(total, SHARES).items()]


@query(
    f"""with one as (select distinct on (id) id, lower(trim(language)) as language, {_split('id')} as split from normalized_examples where id is not null order by id),
    t as (select * from (values {', '.join(f"('{s}', '{k}', {n}, {list(SHARES).index(k)})" for s, k, n in _TARGETS)}) t(split, language, n, k)),
    d as (select * from (values {', '.join(f"('{s}', {n})" for s, n in DESIRED.items())}) d(split, wanted)),
    r as (select id, split, language, n, k, row_number() over (partition by split, language order by {_hex('id')}, id) as rank from one join t using (split, language)),
    kept as (select split, language, id from r where rank <= n),
    short as (select split, wanted, wanted - count(id) as short from d left join kept using (split) group by split, wanted),
    pool as (select *, row_number() over (partition by split order by k, rank) as o from r where rank > n),
    fill as (select split, language, id, row_number() over (partition by split order by {_hex('id')}, id) as f, short from pool join short using (split) where o <= wanted)
    select split, language, id, false as filled from kept union all select split, language, id, true from fill where f <= short"""
)
def repo_quotas(spark, d):
    from gristmill.functions import hashing

    one = table(spark, d, "normalized_examples").where("id is not null").groupBy("id").agg(F.first("language").alias("language"))
    rows = one.select("id", F.lower(F.trim("language")).alias("language"), hashing.hash_split(F.col("id")).alias("split"), hashing.hash_hex(F.col("id")).alias("h"))
    return sampling.repo_backfill(rows, DESIRED, SHARES, ["h", "id"], F.col("id")).select("split", "language", "id", "filled")
