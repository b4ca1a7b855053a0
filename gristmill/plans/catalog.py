"""Queries over the operators of the core, and the SQL that says the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from gristmill.functions import arrays, diffs, hashing, language, messages, quality, text
from gristmill.operators import accept as accepting
from gristmill.operators import dedup, gates, minhash, sampling, stats
from gristmill.plans import evaluation, mixture, repo_context
from gristmill.session import table
from gristmill.sources import writers

SAMPLE = 200
TIERS = {"A": 0.5, "B": 0.3, "C": 0.15, "D": 0.05}
LANGUAGES = {"python": 0.35, "javascript": 0.15, "typescript": 0.15, "java": 0.10, "cpp": 0.10, "go": 0.08, "rust": 0.05, "shell": 0.01, "sql": 0.01}
_Q: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
_SQL: dict[str, str] = {}

# --- SQL fragments -------------------------------------------------------------

_NORM = r"trim(regexp_replace(lower({0}), '[^\p{{L}}\p{{N}}_]+', ' ', 'g'))"
_SP = r"[\s\x0b\x1c-\x1f\x85\p{Z}]"
_STRIP = rf"regexp_replace({{0}}, '^{_SP.replace('{', '{{').replace('}', '}}')}+|{_SP.replace('{', '{{').replace('}', '}}')}+$', '', 'g')"
_HEX = "substr(sha256('3407:' || {0}), 1, 16)"
_BUCKET100 = "((('0x' || substr({h}, 1, 8))::bigint % 100) * 96 + ('0x' || substr({h}, 9, 8))::bigint) % 100"


def _norm(c: str) -> str:
    return _NORM.format(c)


def _strip(c: str) -> str:
    return _STRIP.format(c)


def _hex(c: str) -> str:
    return _HEX.format(c)


def _mod(c: str, m: int) -> str:
    h = _hex(c)
    return f"((('0x' || substr({h}, 1, 8))::bigint % {m}) * {(1 << 32) % m} + ('0x' || substr({h}, 9, 8))::bigint) % {m}"


def _split(c: str) -> str:
    return f"case when {_mod(c, 100)} < 90 then 'train' when {_mod(c, 100)} < 95 then 'validation' when {c} is not null then 'test' end"


def _quote(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _aliases(c: str) -> str:
    return f"case {c} " + " ".join(f"when {_quote(k)} then {_quote(v)}" for k, v in language.ALIASES.items()) + f" else {c} end"


def _infer(c: str, fallback: str = "'unknown'") -> str:
    label = f"regexp_extract({c}, {_quote(language.FENCE_LABEL)}, 1)"
    signs = " ".join(f"when regexp_matches({c}, {_quote('(?ims)' + p)}) then {_quote(n)}" for n, p in language.SIGNS)
    return f"case when {label} <> '' then {_aliases(f'lower({label})')} {signs} else {_aliases(f'lower({_strip(fallback)})')} end"


_SHINGLES = "case when len(w) = 0 then [] when len(w) < 5 then [array_to_string(w, ' ')] else list_distinct([array_to_string(w[i:i + 4], ' ') for i in range(1, len(w) - 3)]) end"
_WORDS = f"case when {_norm('text')} = '' then [] else string_split({_norm('text')}, ' ') end"
_SIGNED = f"""
with w as (select doc_id, {_WORDS} as w from documents where text is not null),
runs as (select doc_id, unnest({_SHINGLES}) as r from w),
v as (select doc_id, ('0x' || substr(sha256(r), 1, 15))::bigint % {minhash.PRIME} as v from runs),
sig as (select doc_id, [{', '.join(f'min((v + ((v >> 29) | 1) * {s + 1} + {s * s}) % {minhash.PRIME})' for s in range(minhash.SLOTS))}] as sig from v group by doc_id)
"""
_TEST_PATHS = "list_filter(list_concat(coalesce(fail_to_pass, []), coalesce(pass_to_pass, [])), lambda x: x is not null and x <> '')"
_BAND = "len(list_filter(range(8), lambda z: {0}[z * 8 + 1:z * 8 + 8] = {1}[z * 8 + 1:z * 8 + 8])) > 0 and len(list_filter(list_zip({0}, {1}), lambda z: z[1] = z[2])) >= 0.85 * 64"


def _near_sql(a: str, b: str) -> str:
    """Two signatures share a band and enough slots."""
    return _BAND.replace("{0}", a).replace("{1}", b)


def _signed_sql(name: str, source: str) -> str:
    """CTE ``name(key, sig)``: signatures of ``source (key, t)`` over SHA-256; a text without words has zeros."""
    slots = ", ".join(f"min((v + ((v >> 29) | 1) * {k + 1} + {k * k}) % {minhash.PRIME})" for k in range(minhash.SLOTS))
    return f"""{name}_w as (select key, case when {_norm('t')} = '' then [] else string_split({_norm('t')}, ' ') end as w from {source}), {name}_r as (select key, unnest({_SHINGLES}) as r from {name}_w),
    {name}_s as (select key, [{slots}] as sig from (select key, ('0x' || substr(sha256(r), 1, 15))::bigint % {minhash.PRIME} as v from {name}_r) group by key),
    {name} as (select {name}_w.key, coalesce(sig, [0 for i in range({minhash.SLOTS})]) as sig from {name}_w left join {name}_s using (key))"""


#: DuckDB's list_distinct gives no order: the first of each kept by position.
_ORDERED = "list_filter({0}, lambda x, i: list_position({0}, x) = i)"


def query(sql: str | None = None):
    def add(f):
        _Q[f.__name__] = f
        if sql is not None:
            _SQL[f.__name__] = sql
        return f

    return add


def _docs(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").where("text is not null")


# --- text and hashes -------------------------------------------------------------


@query(f"select doc_id, {_norm('text')} as norm from documents where text is not null")
def normalize_text(spark, d):
    return _docs(spark, d).select("doc_id", text.normalize(F.col("text")).alias("norm"))


@query(f"with w as (select doc_id, {_WORDS} as w from documents where text is not null) select doc_id, len({_SHINGLES}) as n, len(w) as words from w")
def shingle_counts(spark, d):
    return _docs(spark, d).select("doc_id", F.size(text.shingles(F.col("text"))).cast("long").alias("n"), F.size(text.words(F.col("text"))).cast("long").alias("words"))


@query(f"select doc_id, {_hex('doc_id::varchar')} as h, {_mod('doc_id::varchar', 100)} as bucket, {_split('doc_id::varchar')} as split from documents")
def stable_hash_split(spark, d):
    c = F.col("doc_id")
    return table(spark, d, "documents").select("doc_id", hashing.hash_hex(c).alias("h"), hashing.hash_bucket(c, 100).alias("bucket"), hashing.hash_split(c).alias("split"))


@query(f"select lang, {_split('doc_id::varchar')} as split, count(*) as n from documents group by all")
def split_distribution(spark, d):
    return table(spark, d, "documents").groupBy("lang", hashing.hash_split(F.col("doc_id")).alias("split")).agg(F.count("*").alias("n"))


@query("select id, sha256(to_json(list_transform(messages, lambda m: {'content': m.content, 'role': m.role}))::varchar) as h from normalized_examples where not list_contains([m.content is null for m in messages], true)")
def content_hash(spark, d):
    e = table(spark, d, "normalized_examples").where(~F.exists("messages", lambda m: m.content.isNull()))
    return e.select("id", hashing.messages_hash(F.col("messages")).alias("h"))


@query(
    f"""with o as (select id, commit_rows.* exclude (loaded_at, produced_at) from (select 1 as id) cross join commit_rows)
    select commit, new_file, {_infer("coalesce(new_contents, '')", "coalesce(lang, 'unknown')")} as language, {_infer("''", "coalesce(lang, 'unknown')")} as own from o"""
)
def infer_language(spark, d):
    c = table(spark, d, "commit_rows")
    own = F.coalesce("lang", F.lit("unknown"))
    return c.select("commit", "new_file", language.infer_language(F.coalesce("new_contents", F.lit("")), own).alias("language"), language.infer_language(F.lit(""), own).alias("own"))


@query(f"select doc_id, {_infer('text')} as language from documents where text is not null")
def document_language(spark, d):
    return _docs(spark, d).select("doc_id", language.infer_language(F.col("text")).alias("language"))


@query(
    "with s as (select new_file, lower(regexp_extract(regexp_extract(new_file, '([^/]*)/*$', 1), '^.+(\\.[^.]+)$', 1)) as s from commit_rows) select new_file, case "
    + " ".join(f"when s in ({', '.join(map(_quote, v))}) then '{k}'" for k, v in language.SUFFIXES.items())
    + " else 'unknown' end as language, count(*) as n from s group by all"
)
def path_language(spark, d):
    return table(spark, d, "commit_rows").groupBy("new_file", language.path_language(F.col("new_file")).alias("language")).agg(F.count("*").alias("n"))


_FENCED = r"regexp_extract_all({0}, '(?s)```(?:[A-Za-z0-9_+.#-]+)?\s*\n(.*?)```', 1)"


def _longest(c: str) -> str:
    f = _FENCED.replace("{0}", c)
    return _strip(f"coalesce(list_filter({f}, lambda x: length(x) = list_max(list_transform({f}, lambda y: length(y))))[1], {c})")


@query(f"select id, {_longest('output')} as code from instruction_rows where output is not null")
def fenced_code(spark, d):
    return table(spark, d, "instruction_rows").where("output is not null").select("id", text.fenced_code(F.col("output")).alias("code"))


# --- diffs and tasks ---------------------------------------------------------------


@query()
def unified_diff(spark, d):
    c = table(spark, d, "commit_rows")
    patch = diffs.unified_diff(F.col("old_contents"), F.col("new_contents"), F.col("old_file"), F.col("new_file"))
    return c.select("commit", "new_file", patch.alias("patch"))


_GIT = r"regexp_extract_all(patch, '(?m)^diff --git a/(.*?) b/(.*?)$', 2)"
_NEW = r"list_filter(regexp_extract_all(patch, '(?m)^\+\+\+ b/(.*?)$', 1), lambda x: x <> '/dev/null')"


@query(
    f"""select instance_id, {_ORDERED.format(f"(case when len({_GIT}) > 0 then {_GIT} else {_NEW} end)")} as changed_files, {_ORDERED.format(f"list_transform({_TEST_PATHS}, lambda x: split_part(x, '::', 1))")} as tests,
    regexp_matches(patch, '(?m)^--- ') and regexp_matches(patch, '(?m)^\\+\\+\\+ ') as is_diff from repo_tasks where patch is not null"""
)
def patch_facts(spark, d):
    t = table(spark, d, "repo_tasks").where("patch is not null")
    return t.select("instance_id", diffs.changed_files(F.col("patch")).alias("changed_files"), diffs.test_paths(F.col("fail_to_pass"), F.col("pass_to_pass")).alias("tests"), diffs.is_diff(F.col("patch")).alias("is_diff"))


_HEADS = r"list_transform(regexp_extract_all(patch, '(?m)^@@.*?@@\s*(.*)$', 1), lambda h: coalesce(nullif(regexp_extract(h, '" + diffs.NAMED + r"', 1), ''), nullif(regexp_extract(h, '" + diffs.NAMED + r"', 2), '')))"


@query(f"select instance_id, {_ORDERED.format(f'list_filter({_HEADS}, lambda x: x is not null)')} as functions from repo_tasks where patch is not null")
def patch_functions(spark, d):
    return table(spark, d, "repo_tasks").where("patch is not null").select("instance_id", diffs.changed_functions(F.col("patch")).alias("functions"))


_REPO = r"regexp_extract(coalesce(repo, ''), '^(?:swesmith/)?(.*?)__(.*)\.([^.]*)$', {0})"


@query(
    f"""with p as (select instance_id, {_REPO.format(1)} || '/' || {_REPO.format(2)} as name, lower({_REPO.format(3)}) as c from repo_tasks),
    ok as (select instance_id, case when regexp_full_match(name, '[A-Za-z0-9_.-]+/[A-Za-z0-9_.-]+') and regexp_full_match(c, '[0-9a-f]{{7,40}}') then name end as github_repo, c from p)
    select instance_id, github_repo, case when github_repo is not null then c end as commit from ok"""
)
def repo_revisions(spark, d):
    return table(spark, d, "repo_tasks").withColumn("r", diffs.revision(F.col("repo"))).select("instance_id", "r.github_repo", "r.commit")


@query(
    f"""with f as (select instance_id, {_HEADS} as hf, list_transform({_TEST_PATHS}, lambda x: x) as t from repo_tasks where patch is not null and instance_id <> ''),
    b as (select instance_id, len(list_filter(hf, lambda x: x is not null)) as nf, len(t) as nt, {_mod('instance_id', 100)} as b, {_mod("'position:' || instance_id", 5)} as p, {_mod("'length:' || instance_id", 10)} as l from f)
    select instance_id, case when b < 40 then 'file_localization' when b < 60 and nf > 0 then 'function_localization' when b < 90 then 'patch_generation' when nt > 0 then 'test_localization' else 'patch_generation' end as task_type,
    p::int as position_bucket, case when l < 6 then 16384 when l < 8 then 24576 else 32768 end as target_tokens from b"""
)
def task_plan(spark, d):
    t = table(spark, d, "repo_tasks").where("patch is not null and instance_id <> ''")
    return repo_context.task_rows(t).select(F.col("source_id").alias("instance_id"), "task_type", "position_bucket", "target_tokens")


# --- quality -------------------------------------------------------------------------

_FOUND = "regexp_extract(coalesce(average_test_score, ''), '[0-9]+(?:\\.[0-9]+)?')"
_TEST = f"coalesce(case when {_FOUND} = '' then 0.0 when {_FOUND}::double > 1.0 then {_FOUND}::double / 100.0 else {_FOUND}::double end, 0.0)"
_JUDGE = "list_filter(list_transform(regexp_extract_all(coalesce(llm_judgement, ''), '\"score\"\\s*:\\s*([0-9.]+)', 1), lambda x: try_cast(x as double)), lambda x: x is not null)"
_TIERED = f"""with s as (select id, loaded_at, {_TEST} as test_score, coalesce(list_min({_JUDGE}), 0.0) as least_judge from instruction_rows),
tiered as (select *, case when test_score >= 1 and least_judge >= 5 then 'A' when test_score >= 1 and least_judge >= 4 then 'B' when test_score >= 0.9 and least_judge >= 4 then 'C' when test_score >= 0.8 and least_judge >= 4 then 'D' end as tier from s)
"""


@query(_TIERED + "select id, test_score, least_judge, tier from tiered")
def quality_tier(spark, d):
    return mixture.with_tier(table(spark, d, "instruction_rows")).select("id", "test_score", "least_judge", "tier")


@query(
    """with r as (select row_number() over () as k, id, llm_judgement as j from instruction_rows),
    walked as (select k, list(try_cast(t.value as double) order by t.id) as s from r, json_tree(r.j) t where json_valid(r.j) and t.key = 'score' and t.type in ('UBIGINT', 'BIGINT', 'DOUBLE', 'HUGEINT') group by k)
    select r.id, case when j is null then [] when json_valid(j) then coalesce(s, []) else """
    + _JUDGE.replace("llm_judgement", "j")
    + """ end as scores from r left join walked using (k)"""
)
def judge_scores_exact(spark, d):
    return table(spark, d, "instruction_rows").select("id", quality.judge_scores_exact(F.col("llm_judgement")).alias("scores"))


# --- sampling and quotas ---------------------------------------------------------------


@query(f"select doc_id from documents order by {_hex('doc_id::varchar')}, doc_id limit {SAMPLE}")
def priority_sample(spark, d):
    return sampling.priority_sample(table(spark, d, "documents").select("doc_id"), F.col("doc_id"), SAMPLE, tie="doc_id")


@query(
    _TIERED
    + f""", one as (select id, min(tier) as tier from tiered where tier is not null group by id),
    q as (select * from (values ('A', 75), ('B', 45), ('C', 23), ('D', 8)) t(tier, n)),
    r as (select id, one.tier, row_number() over (partition by one.tier order by {_hex('id')}, id) as rank, n from one join q on q.tier = one.tier)
    select tier, id, rank from r where rank <= n"""
)
def stratified_sample(spark, d):
    rows = mixture.with_tier(table(spark, d, "instruction_rows")).where("tier is not null").groupBy("id").agg(F.min("tier").alias("tier"))
    limits = {t: sampling.candidate_count(n, 1.5) for t, n in sampling.largest_remainder(100, TIERS).items()}
    return sampling.stratified_sample(rows, "tier", limits, F.col("id"), tie="id").select("tier", "id", F.col("_rank").cast("long").alias("rank"))


@query(
    """with n as (select source, count(*)::double as w from documents where source is not null group by source), x as (select source, 1000.0::double * w / sum(w) over () as x from n),
    f as (select source, x, floor(x) as f from x), r as (select *, row_number() over (order by x - f desc, source) as r, 1000 - sum(f) over () as left_over from f)
    select source, (f + case when r <= left_over then 1 else 0 end)::bigint as quota from r"""
)
def largest_remainder(spark, d):
    n = table(spark, d, "documents").where("source is not null").groupBy("source").agg(F.count("*").cast("double").alias("w"))
    return sampling.apportion(n, "source", "w", 1000)


@query(
    f"""with have as (select lang, count(*) as have from documents where lang in ('en', 'de', 'fr', 'es') group by lang), en as (select have from have where lang = 'en'),
    q as (select lang, case when lang = 'de' then have + (select have from en) // 10 else have // 5 end as n, have from have),
    r as (select doc_id, documents.lang, n, row_number() over (partition by documents.lang order by doc_id) as rank from documents join q on q.lang = documents.lang),
    short as (select sum(greatest(0, n - have)) as s from q),
    rest as (select doc_id, lang, row_number() over (order by {_hex('doc_id::varchar')}, doc_id) as k from r where rank > n)
    select doc_id, lang, false as filled from r where rank <= n union all select doc_id, lang, true from rest where k <= (select s from short)"""
)
def quota_backfill(spark, d):
    docs = table(spark, d, "documents").select("doc_id", "lang")
    have = {r["lang"]: r["n"] for r in docs.where(F.col("lang").isin("en", "de", "fr", "es")).groupBy("lang").agg(F.count("*").alias("n")).collect()}  # four rows
    quotas = {k: n + have.get("en", 0) // 10 if k == "de" else n // 5 for k, n in have.items()}  # more of one language than there is
    return sampling.backfill(docs, "lang", quotas, ["doc_id"], F.col("doc_id"))


@query(
    f"""with o as (select distinct on (id) id from normalized_examples where lower(trim(split)) = 'train' order by id) select id from o order by {_hex('id')}, id limit 556"""
)
def rehearsal(spark, d):
    e = table(spark, d, "normalized_examples").select("id", F.lower(F.trim("split")).alias("split")).distinct()
    return sampling.rehearsal(e, F.col("id"), tie="id").select("id")


@query(
    """with a as (select lang as key, count(*) as actual from documents where lang is not null group by 1), w as (select unnest(['en', 'de', 'fr', 'es', 'it']) as key, 300 as wanted)
    select w.key as lang, wanted - coalesce(actual, 0) as missing from w left join a using (key) where wanted > coalesce(actual, 0)"""
)
def shortages(spark, d):
    wanted = spark.createDataFrame([(x, 300) for x in ("en", "de", "fr", "es", "it")], "lang string, wanted long")
    actual = table(spark, d, "documents").where("lang is not null").groupBy("lang").agg(F.count("*").alias("actual"))
    return sampling.shortages(wanted, actual, "lang")


# --- deduplication -----------------------------------------------------------------------


@query(f"select min(doc_id) as doc_id from documents where text is not null group by sha256({_norm('text')})")
def exact_dedup(spark, d):
    return dedup.exact_first(_docs(spark, d).select("doc_id", "text"), "text", "doc_id").where("first = doc_id").select("doc_id")


@query(_SIGNED + "select doc_id, sig from sig")
def minhash_signature(spark, d):
    return _docs(spark, d).select("doc_id", minhash.signature(F.col("text"), "sha").alias("sig"))


@query()
def minhash_compat(spark, d):
    return _docs(spark, d).select("doc_id", minhash.signature(F.col("text")).alias("sig"))


#: The low 64 bits of a product.
_LOW64 = "& 18446744073709551615::uhugeint"


@query(
    f"""with w as (select doc_id, {_WORDS} as w from documents where text is not null),
    runs as (select doc_id, unnest({_SHINGLES}) as r from w),
    v as (select doc_id, ('0x' || substr(sha256(r), 1, 15))::bigint % {minhash.PRIME} as v from runs),
    slots as (select unnest(range(64)) as slot),
    x as (select doc_id, slot, ((v::uhugeint + (slot + 1)::uhugeint * {0x9E3779B97F4A7C15}::uhugeint) {_LOW64})::ubigint as x from v, slots),
    a as (select doc_id, slot, (xor(x, x >> 30)::uhugeint * {0xBF58476D1CE4E5B9}::uhugeint {_LOW64})::ubigint as x from x),
    b as (select doc_id, slot, (xor(x, x >> 27)::uhugeint * {0x94D049BB133111EB}::uhugeint {_LOW64})::ubigint as x from a),
    m as (select doc_id, slot, min((xor(x, x >> 31) % {minhash.PRIME}::ubigint)::bigint) as m from b group by doc_id, slot)
    select doc_id, list(m order by slot) as sig from m group by doc_id"""
)
def minhash_independent(spark, d):
    return _docs(spark, d).select("doc_id", minhash.signature(F.col("text"), "sha_independent").alias("sig"))


@query(
    _SIGNED
    + """, reps as (select sig, min(doc_id) as rep from sig group by sig),
    b as (select rep, band, sig[band * 8 + 1:band * 8 + 8] as k from reps, range(8) t(band)),
    cand as (select distinct x.rep as lo, y.rep as hi from b x join b y on x.band = y.band and x.k = y.k and x.rep < y.rep),
    sim as (select lo, hi, len(list_filter(list_zip(l.sig, r.sig), lambda z: z[1] = z[2]))::double / 64 as similarity from cand join reps l on l.rep = lo join reps r on r.rep = hi)
    select lo, hi, similarity from sim where similarity >= 0.85 union all select rep, doc_id, 1.0 from sig join reps using (sig) where doc_id <> rep"""
)
def lsh_pairs(spark, d):
    return minhash.similar_pairs(_docs(spark, d).select("doc_id", minhash.signature(F.col("text"), "sha").alias("sig")), "doc_id")


_PAIRS = (
    """, reps as (select sig, min(doc_id) as rep from sig group by sig),
    b as (select rep, band, sig[band * 8 + 1:band * 8 + 8] as k from reps, range(8) t(band)),
    cand as (select distinct x.rep as lo, y.rep as hi from b x join b y on x.band = y.band and x.k = y.k and x.rep < y.rep),
    near as (select lo, hi from cand join reps l on l.rep = lo join reps r on r.rep = hi where len(list_filter(list_zip(l.sig, r.sig), lambda z: z[1] = z[2])) >= 0.85 * 64
      union all select rep, doc_id from sig join reps using (sig) where doc_id <> rep)"""
)
#: A first-wins scan as a fold over the linked documents in order: one is dropped if an earlier one it is linked to was kept.
_FIRST_WINS = """, lower as (select hi as x, list(lo) as before from near group by hi), node as (select x, coalesce(before, []) as before from (select lo as x from near union select hi from near) left join lower using (x)),
    kept as (select list_reduce(list({'x': x, 'before': before} order by x), lambda acc, n: case when list_has_any(acc, n.before) then acc else list_append(acc, n.x) end, []::bigint[]) as kept from node)"""


@query(_SIGNED + _PAIRS + _FIRST_WINS + " select doc_id from sig, kept where not exists (select 1 from near where hi = doc_id or lo = doc_id) or list_contains(kept, doc_id)")
def near_dedup_greedy(spark, d):
    signed = _docs(spark, d).select("doc_id", minhash.signature(F.col("text"), "sha").alias("sig"))
    return dedup.greedy_first_wins(signed, minhash.similar_pairs(signed, "doc_id"), "doc_id")


_ITEMS = "items as (select min(item_id) as key, text as t from benchmark where text is not null group by text)"


@query(
    f"""with docs as (select doc_id as key, text as t from documents where text is not null), {_ITEMS}, {_signed_sql('ours', 'docs')}, {_signed_sql('theirs', 'items')}
    select distinct ours.key as doc_id from ours join theirs on {_near_sql('ours.sig', 'theirs.sig')} union select key from docs where {_norm('t')} in (select {_norm('t')} from items)"""
)
def benchmark_overlap(spark, d):
    return dedup.decontaminate(_docs(spark, d), "doc_id", "text", table(spark, d, "benchmark"), "text", family="sha")


@query(f"select dataset, item_id, {_strip('text')} as prompt from benchmark where dataset = 'stepcheck' union all select dataset, item_id, {_strip('text')} from benchmark where dataset <> 'stepcheck'")
def eval_problems(spark, d):
    b = table(spark, d, "benchmark").select("dataset", "item_id", text.strip(F.col("text")).alias("prompt"))
    return b.where("dataset = 'stepcheck'").unionByName(b.where("dataset <> 'stepcheck'"))


_LONG = 120


@query(
    f"""with n as (select doc_id, lang, {_norm('text')} as n, len({_WORDS}) as words from documents where text is not null),
    f as (select *, min(doc_id) over (partition by n) as first from n),
    r as (select doc_id, lang, {_split('doc_id::varchar')} as split, case when words > {_LONG} then 'too_long' when n in (select {_norm('text')} from benchmark) then 'benchmark_overlap' when first <> doc_id then 'duplicate' else 'accepted' end as reason from f)
    select lang, split, reason, count(*) as n from r group by all"""
)
def funnel(spark, d):
    norm = text.normalize(F.col("text"))
    rows = _docs(spark, d).select("doc_id", "lang", norm.alias("n")).select("doc_id", "lang", F.sha2("n", 256).alias("k"), F.when(F.col("n") == "", 0).otherwise(F.size(F.split("n", " "))).alias("words"))
    bench = table(spark, d, "benchmark").select(F.sha2(norm, 256).alias("k")).distinct().withColumn("hit", F.lit(True))
    firsts = rows.groupBy("k").agg(F.min("doc_id").alias("first"))
    judged = rows.join(firsts, "k").join(bench, "k", "left")  # ids, hashes and numbers only
    reason = stats.first_reason(too_long=F.col("words") > _LONG, benchmark_overlap=F.col("hit"), duplicate=F.col("first") != F.col("doc_id"))
    return judged.groupBy("lang", hashing.hash_split(F.col("doc_id")).alias("split"), F.coalesce(reason, F.lit("accepted")).alias("reason")).agg(F.count("*").alias("n"))


# --- counts and statistics ------------------------------------------------------------------


@query(
    """with r as (select token_count as v, row_number() over (order by token_count) - 1 as i, count(*) over () as n from normalized_examples where token_count is not null)
    select min(v)::bigint as min, min(v) filter (where i = floor((n - 1) * 0.5::double))::bigint as p50, min(v) filter (where i = floor((n - 1) * 0.9::double))::bigint as p90, min(v) filter (where i = floor((n - 1) * 0.99::double))::bigint as p99, max(v)::bigint as max from r"""
)
def token_stats(spark, d):
    return stats.token_stats(table(spark, d, "normalized_examples"), "token_count")


@query(
    "\nunion all ".join(f"select '{c}' as dimension, {c} as value, count(*) as n from normalized_examples group by {c}" for c in ("source", "split", "language", "quality_tier"))
)
def manifest_counts(spark, d):
    return stats.counts_by(table(spark, d, "normalized_examples"), ["source", "split", "language", "quality_tier"])


@query("select source, count(*) as n, count(*) filter (where token_count > 8192) as dropped from normalized_examples group by source")
def length_filter(spark, d):
    return table(spark, d, "normalized_examples").groupBy("source").agg(F.count("*").alias("n"), F.count_if(F.col("token_count") > 8192).alias("dropped"))


# --- conversations ---------------------------------------------------------------------------


@query(
    "select id, array_to_string([coalesce(m.content, '') for m in messages if m.role = 'user'], chr(10)) as user_text, array_to_string([coalesce(m.content, '') for m in messages if m.role in ('user', 'assistant')], chr(10)) as dedup_text from normalized_examples"
)
def role_texts(spark, d):
    m = F.col("messages")
    return table(spark, d, "normalized_examples").select("id", messages.role_text(m, ["user"]).alias("user_text"), messages.role_text(m, ["user", "assistant"]).alias("dedup_text"))


@query(
    """select id, case when coalesce(id, '') = '' or coalesce(source, '') = '' or coalesce(source_id, '') = '' then 'id, source, and source_id are required'
    when split is null or split not in ('train', 'validation', 'test') then 'unsupported split' when token_count < 0 then 'negative token count' when messages is null or len(messages) = 0 or coalesce(messages[-1].role, '') <> 'assistant' then 'no assistant response at the end'
    when len([1 for m in messages if coalesce(m.role, '') not in ('system', 'user', 'assistant', 'tool')]) > 0 then 'invalid role' when len([1 for m in messages if m.content is null]) > 0 then 'content is missing'
    when coalesce(content_sha256, '') <> '' and content_sha256 <> sha256(to_json(list_transform(messages, lambda m: {'content': m.content, 'role': m.role}))::varchar) then 'hash does not match' end as violation from normalized_examples"""
)
def schema_violations(spark, d):
    e = table(spark, d, "normalized_examples")
    cols = {c: F.col(c) for c in ("id", "source", "source_id", "split", "token_count", "content_sha256")}
    return e.select("id", messages.violation(F.col("messages"), **cols).alias("violation"))


_MARK = "[7, 8]"


@query(
    """with e as (select o_orderkey as k, list(l_linenumber order by l_linenumber) as ids from orders join lineitem on l_orderkey = o_orderkey group by 1)
    select k, [i - 1 for i in range(1, len(ids)) if ids[i] = 2 and ids[i + 1] = 3] as at, len([x for x in ids if x <> 4]) as supervised from e"""
)
def subsequences(spark, d):
    e = table(spark, d, "orders").join(table(spark, d, "lineitem"), F.col("l_orderkey") == F.col("o_orderkey")).groupBy(F.col("o_orderkey").alias("k")).agg(F.sort_array(F.collect_list("l_linenumber")).alias("ids"))
    needle = F.array(F.lit(2), F.lit(3))
    return e.select("k", F.transform(arrays.positions(F.col("ids"), needle), lambda x: x.cast("long")).alias("at"), arrays.count_where(F.col("ids"), lambda x: x != 4).cast("long").alias("supervised"))


# --- evaluation --------------------------------------------------------------------------------

_ANSWER = "messages[-1].content"
_RANKED = r"""list_filter(list_transform(string_split(answer, chr(10)), lambda x: trim(trim(regexp_replace(x, '^\s*(?:[-*]|\d+[.)])\s*', '')), '`''')), lambda x: x <> '')"""
_RECALL = "case when len(list_distinct(expected)) > 0 then len(list_intersect(list_distinct(expected), ranked[1:{k}]))::double / len(list_distinct(expected)) else 0.0 end"


@query(
    f"""with a as (select distinct on (id) id, task_type, {_ANSWER} as answer, coalesce(case task_type when 'file_localization' then metadata.changed_files else metadata.functions end, []) as expected
      from normalized_examples where task_type in ('file_localization', 'function_localization') and {_ANSWER} is not null order by id),
    r as (select id, task_type, expected, {_RANKED} as ranked from a)
    select id, {', '.join(f'{_RECALL.format(k=k)} as recall_at_{k}' for k in (1, 3, 5))} from r"""
)
def recall_at_k(spark, d):
    e = table(spark, d, "normalized_examples").where("task_type in ('file_localization', 'function_localization')")
    e = e.select("id", "task_type", F.element_at("messages", -1)["content"].alias("response"), F.struct("metadata.changed_files", "metadata.functions").alias("metadata")).where("response is not null").dropDuplicates(["id"])
    s = evaluation.score(e)
    return s.select("id", *[F.coalesce(f"file_recall_at_{k}", f"function_recall_at_{k}").alias(f"recall_at_{k}") for k in (1, 3, 5)])


_CODE = _longest("answer")
_PREDICTED = f"case when len({_GIT.replace('patch', 'code')}) > 0 then {_GIT.replace('patch', 'code')} else {_NEW.replace('patch', 'code')} end"
_SCORED = f"""with a as (select distinct on (id) id, task_type, {_ANSWER} as answer, metadata from normalized_examples where id is not null and {_ANSWER} is not null order by id),
    f as (select *, {_CODE} as code, {_RANKED} as ranked, coalesce(metadata.changed_files, []) as files, coalesce(metadata.functions, []) as functions from a),
    s as (select *, list_distinct({_PREDICTED}) as predicted from f)"""


@query(
    _SCORED
    + " union all ".join(
        [f" select 'file_recall_at_{k}' as metric, coalesce(avg({_RECALL.format(k=k).replace('expected', 'files')}), 0.0) as mean, count(*) as n from s where task_type = 'file_localization'" if k == 1 else f" select 'file_recall_at_{k}', coalesce(avg({_RECALL.format(k=k).replace('expected', 'files')}), 0.0), count(*) from s where task_type = 'file_localization'" for k in (1, 3, 5)]
        + [f" select 'function_recall_at_{k}', coalesce(avg({_RECALL.format(k=k).replace('expected', 'functions')}), 0.0), count(*) from s where task_type = 'function_localization'" for k in (1, 3, 5)]
        + [
            " select 'valid_diff_rate', coalesce(avg((regexp_matches(code, '(?m)^--- ') and regexp_matches(code, '(?m)^\\+\\+\\+ '))::int::double), 0.0), count(*) from s where task_type = 'patch_generation'",
            " select 'changed_file_precision', coalesce(avg(case when len(predicted) > 0 then len(list_intersect(files, predicted))::double / len(predicted) else 0.0 end), 0.0), count(*) from s where task_type = 'patch_generation'",
        ]
    )
)
def eval_summary(spark, d):
    e = table(spark, d, "normalized_examples").select("id", "task_type", F.element_at("messages", -1)["content"].alias("response"), "metadata").where("response is not null").dropDuplicates(["id"])
    return evaluation.summary(evaluation.score(e))


@query("select task_type, count(*) as n from normalized_examples group by task_type")
def eval_task_counts(spark, d):
    return evaluation.task_counts(table(spark, d, "normalized_examples"))


@query(f"with a as (select id as task_id, {_ANSWER} as answer from normalized_examples where task_type = 'code_generation' and {_ANSWER} is not null) select task_id, {_CODE} as solution, answer as raw_response from a")
def eval_solutions(spark, d):
    e = table(spark, d, "normalized_examples").where("task_type = 'code_generation'").select(F.col("id").alias("task_id"), F.element_at("messages", -1)["content"].alias("response"))
    return evaluation.solutions(e.where("response is not null"))


_REPORTS = [
    ("baseline", "benchmarks", "humaneval_plus_pass_at_1", 0.20), ("baseline", "benchmarks", "mbpp_plus_pass_at_1", 0.30), ("candidate", "benchmarks", "humaneval_plus_pass_at_1", 0.22),
    ("candidate", "", "mbpp_plus_pass_at_1", 0.31), ("candidate", "benchmarks", "mbpp_plus_pass_at_1", 0.05), ("candidate", "smoke", "finite_validation_loss", 1.0),
    ("candidate", "smoke", "repetition_regression", 0.0), ("candidate", "smoke", "termination_regression", 0.0),
]


@query(
    f"""with r as (select * from (values {', '.join(f"('{a}', '{b}', '{c}', {v}::double)" for a, b, c, v in _REPORTS)}) t(report, section, metric, value)),
    m as (select report, metric, arg_min(value, list_position(['', 'benchmarks', 'metrics', 'repo', 'smoke'], section)) as v from r group by all),
    p as (select max(v) filter (where report = 'baseline' and metric like 'humaneval%') as bh, max(v) filter (where report = 'baseline' and metric like 'mbpp%') as bm, max(v) filter (where report = 'candidate' and metric like 'humaneval%') as ch,
      max(v) filter (where report = 'candidate' and metric like 'mbpp%') as cm, max(v) filter (where metric = 'finite_validation_loss') as f, max(v) filter (where metric = 'repetition_regression') as rr, max(v) filter (where metric = 'termination_regression') as tr from m),
    c as (select 'core_average_gain_at_least_1pp' as check_name, (ch + cm) / 2 - (bh + bm) / 2 >= 0.01 as passed from p union all select 'no_core_regression_over_2pp', greatest(bh - ch, bm - cm) <= 0.02 from p union all select 'finite_validation_loss', f <> 0 from p
      union all select 'no_repetition_regression', rr = 0 from p union all select 'no_termination_regression', tr = 0 from p)
    select * from c union all select 'all', bool_and(passed) from c"""
)
def gate_compare(spark, d):
    return gates.compare(spark.createDataFrame(_REPORTS, "report string, section string, metric string, value double"), "stage1")


@query(
    """with p as (select event_id, (event_id % 7 + 1) * 1000 as length, value > 20 as success, (event_id % 13)::double / 50 as headroom_fraction, event_type from events)
    select coalesce(max(length) filter (where success and headroom_fraction >= 0.1), 0)::int as selected from p"""
)
def largest_passing(spark, d):
    e = table(spark, d, "events")
    return gates.largest_passing(e.select(((F.col("event_id") % 7 + 1) * 1000).alias("length"), (F.col("value") > 20).alias("success"), ((F.col("event_id") % 13) / 50).alias("headroom_fraction")))


_LEAVES = [x for names in gates.FAMILIES.values() for x in names] + ["norm", "embed"]
_MODULES = f"select 'model.layers.' || p_partkey || '.' || {_LEAVES!r}[p_partkey % {len(_LEAVES)} + 1] as name, p_partkey as numel, p_size > 25 as trainable from part"


def _modules(spark, d):
    leaf = F.element_at(F.array(*[F.lit(x) for x in _LEAVES]), (F.col("p_partkey") % len(_LEAVES) + 1).cast("int"))
    return table(spark, d, "part").select(F.concat(F.lit("model.layers."), "p_partkey", F.lit("."), leaf).alias("name"), F.col("p_partkey").alias("numel"), (F.col("p_size") > 25).alias("trainable"))


@query(
    f"""with m as ({_MODULES}), f as (select *, case {' '.join(f"when string_split(name, '.')[-1] in ({', '.join(map(_quote, v))}) then '{k}'" for k, v in gates.FAMILIES.items())} else 'other' end as family from m)
    select family, count(*) as modules, sum(case when trainable then numel else 0 end)::bigint as trainable, sum(numel)::bigint as total from f group by family"""
)
def parameter_audit(spark, d):
    return gates.parameter_audit(_modules(spark, d))


@query(
    f"""with m as (select case when numel % 9 = 0 then replace(name, 'model.layers', 'model.visual') else name end as name, numel, trainable from ({_MODULES}) where string_split(name, '.')[-1] not in ({', '.join(map(_quote, gates.FAMILIES['mlp']))}))
    select 'missing projection families' as fault, ['mlp'] as names union all
    select 'vision parameters are trainable', list(distinct name order by name) from m where trainable and name like '%.visual.%'"""
)
def audit_faults(spark, d):
    m = _modules(spark, d).where(~F.substring_index("name", ".", -1).isin(gates.FAMILIES["mlp"]))
    return gates.audit_faults(m.withColumn("name", F.when(F.col("numel") % 9 == 0, F.replace("name", F.lit("model.layers"), F.lit("model.visual"))).otherwise(F.col("name"))))


@query("select c_name as name from customer where c_acctbal <= 5000 order by c_acctbal desc, c_name desc limit 1")
def select_profile(spark, d):
    return gates.select_profile(table(spark, d, "customer").select(F.col("c_name").alias("name"), F.col("c_acctbal").alias("min_vram_gb")), 5000.0)


@query(
    """with l as (select commit || '/' || new_file as name, sha256(coalesce(old_contents, '')) as sha256, length(coalesce(old_contents, '')) as bytes from (select distinct on (commit, new_file) * from commit_rows order by commit, new_file, loaded_at)),
    r as (select commit || '/' || new_file as name, sha256(coalesce(new_contents, '')) as sha256, length(coalesce(new_contents, '')) as bytes from (select distinct on (commit, new_file) * from commit_rows order by commit, new_file, loaded_at) where length(commit) > 0)
    select l.name from l join r using (name) where l.sha256 <> r.sha256 or l.bytes <> r.bytes"""
)
def bundle_differences(spark, d):
    c = table(spark, d, "commit_rows").dropDuplicates(["commit", "new_file", "old_contents", "new_contents"])
    side = lambda x: c.select(F.concat("commit", F.lit("/"), "new_file").alias("name"), F.sha2(F.coalesce(x, F.lit("")), 256).alias("sha256"), F.length(F.coalesce(x, F.lit(""))).alias("bytes"))
    return writers.bundle_differences(side("old_contents"), side("new_contents")).where("name is not null")


# --- pipelines -----------------------------------------------------------------------------------


_SYSTEM = _quote(messages.SYSTEM_PROMPT)
_WORDS_IN = "len(list_filter(string_split_regex({0}, '" + _SP.replace("[", "[", 1) + "+'), lambda x: x <> ''))"


@query(
    f"""with one as (select distinct on (id) * from instruction_rows where id is not null order by id, loaded_at), s as (select *, {_TEST} as test_score, coalesce(list_min({_JUDGE}), 0.0) as least_judge from one),
    t as (select *, case when test_score >= 1 and least_judge >= 5 then 'A' when test_score >= 1 and least_judge >= 4 then 'B' when test_score >= 0.9 and least_judge >= 4 then 'C' when test_score >= 0.8 and least_judge >= 4 then 'D' end as tier from s),
    m as (select *, {_strip("coalesce(input, '')")} as u, {_strip("coalesce(output, '')")} as a from t where tier is not null)
    select 'eer6_broad:' || id as id, id as source_id, {_infer("coalesce(output, '')")} as language, tier as quality_tier, {_split("('eer6_broad:' || id)")} as split, u as question, a as answer,
      {_WORDS_IN.replace("{0}", f"'<system>' || chr(10) || {_SYSTEM} || chr(10) || '<user>' || chr(10) || u || chr(10) || '<assistant>' || chr(10) || a")} as token_count from m"""
)
def instruction_examples(spark, d):
    rows = mixture.with_tier(mixture.latest(table(spark, d, "instruction_rows"), ["id"])).where("tier is not null")
    e = mixture.instruction_examples(rows, "eer6_broad", F.col("tier"))
    said = lambda i: F.col("messages")[i]["content"]
    return e.select("id", "source_id", "language", "quality_tier", "split", said(1).alias("question"), said(2).alias("answer"), F.col("token_count").cast("long").alias("token_count"))


_LANG = _infer("''", "coalesce(lang, 'unknown')")


@query(
    f"""with one as (select distinct on (commit, new_file) * from commit_rows order by commit, new_file, loaded_at),
    f as (select *, coalesce(nullif(old_file, ''), 'file') as o, coalesce(nullif(new_file, ''), nullif(old_file, ''), 'file') as n, nullif(repos, '') as repo, {_LANG} as own from one where coalesce(old_contents, '') <> coalesce(new_contents, '') and commit <> '')
    select 'commitpackft:' || commit || ':' || n as id, repo as repo_id, {_infer("coalesce(new_contents, '')", "own")} as language, {_split("coalesce(repo, commit)")} as split,
      {_strip("'Repository file: ' || o || chr(10) || chr(10) || 'Task: ' || coalesce(nullif(subject, ''), nullif(message, ''), 'Apply the requested change.') || chr(10) || chr(10) || 'Current content:' || chr(10) || '```' || coalesce(lang, '') || chr(10) || coalesce(old_contents, '') || chr(10) || '```' || chr(10) || chr(10) || 'Return the smallest correct unified diff.'")} as question,
      '--- a/' || o || chr(10) || '+++ b/' || n as answer_head from f"""
)
def commit_examples(spark, d):
    e = mixture.commit_examples(mixture.latest(table(spark, d, "commit_rows"), ["commit", "new_file"]))
    said = lambda i: F.col("messages")[i]["content"]
    return e.select("id", "repo_id", "language", "split", said(1).alias("question"), F.substring_index(said(2), "\n@@", 1).alias("answer_head"))


def _benchmark(spark, d):
    return table(spark, d, "benchmark").select("text")


#: Rows of each source and tokens of an example at most, as in the reference's configuration of stage 1.
COUNTS, MAX_TOKENS = {"refined": 35_000, "broad": 15_000, "commits": 10_000}, 8192


@query(
    f"""with one as (select distinct on (id) * from instruction_rows where id is not null order by id, loaded_at),
    m as (select id, row_number() over (order by {_hex('id')}, 'eer6_refined:' || id) as key, {_strip("coalesce(input, '')")} as u, {_strip("coalesce(output, '')")} as a from one),
    n as (select *, {_WORDS_IN.replace("{0}", f"'<system>' || chr(10) || {_SYSTEM} || chr(10) || '<user>' || chr(10) || u || chr(10) || '<assistant>' || chr(10) || a")} > {MAX_TOKENS} as long from m),
    asked as (select key, u as t from n where not long), {_ITEMS}, {_signed_sql('ours', 'asked')}, {_signed_sql('theirs', 'items')},
    bad as (select distinct ours.key from ours join theirs on {_near_sql('ours.sig', 'theirs.sig')} union select key from asked where {_norm('t')} in (select {_norm('t')} from items)),
    clean as (select key, u || chr(10) || a as t from n where not long and key not in (select key from bad)), {_signed_sql('said', 'clean')},
    reps as (select sig, min(key) as rep from said group by sig), bands as (select rep, sig, z, sig[z * 8 + 1:z * 8 + 8] as k from reps, range(8) r(z)),
    near as (select distinct x.rep as lo, y.rep as hi from bands x join bands y on x.z = y.z and x.k = y.k and x.rep < y.rep where len(list_filter(list_zip(x.sig, y.sig), lambda p: p[1] = p[2])) >= 0.85 * 64
      union all select rep, key from said join reps using (sig) where key <> rep)"""
    + _FIRST_WINS
    + """ select id, key as rank, case when long then 'too_long' when key in (select key from bad) then 'benchmark_overlap' when key in (select hi from near) and not list_contains(kept, key) then 'duplicate' end as reason from n, kept"""
)
def accepted(spark, d):
    rows = mixture.instruction_examples(mixture.latest(table(spark, d, "instruction_rows"), ["id"]), "eer6_refined", F.lit("refined"))
    # ids and hashes alone are put in one order; the texts stay where they are
    ranks = sampling.hash_rank(rows.select("id", "source_id"), F.col("source_id"), "id", name="rank").drop("source_id")
    judged = accepting.accept(rows.join(ranks, "id"), _benchmark(spark, d), "text", MAX_TOKENS, None, family="sha")
    return judged.select(F.col("source_id").alias("id"), "rank", "reason")


@query()
def mixture_manifest(spark, d):
    rows = table(spark, d, "instruction_rows")
    examples, _ = mixture.mixture(rows, rows, table(spark, d, "commit_rows"), _benchmark(spark, d), "text", COUNTS, TIERS, LANGUAGES, MAX_TOKENS, 1.5)
    return stats.counts_by(examples, ["source", "split", "language", "quality_tier"])


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    """Every query of the core by name."""
    return dict(_Q)


def oracle_sql() -> dict[str, str]:
    """DuckDB SQL of the queries that SQL can express."""
    return dict(_SQL)
