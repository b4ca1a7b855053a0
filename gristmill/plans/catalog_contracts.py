"""Queries over the contracts of runs and bundles, and the SQL that says the same.

The tables of artifacts are made of the columns of other tables, so that every
fault occurs.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from gristmill.functions import arrays, messages
from gristmill.operators import contracts, gates, sampling, stats
from gristmill.plans.catalog import _ANSWER, _SP, _hex, query
from gristmill.session import table

_NEEDED = [x for names in gates.FAMILIES.values() for x in names]


@query(
    f"""with s as (select p_partkey::varchar as run, case when p_partkey % 5 > 0 then p_size % 9 = 0 end as q4, case when p_partkey % 3 > 0 then p_size % 7 > 0 end as q16, case when p_partkey % 11 > 0 then p_size % 4 > 0 end as bf16,
      case when p_partkey % 2 = 0 then 32 + p_size % 3 end as rank, 32 as alpha, case when p_partkey % 2 = 1 then (p_size % 3)::double / 10 end as dropout, case when p_partkey % 4 = 0 then {_NEEDED!r}[1:{len(_NEEDED)} - p_size % 2] end as targets, p_size * 6000 as length from part),
    f as (select run, 'quantized' as fault, coalesce(q4, false) as bad from s union all select run, 'not_16bit', not coalesce(q16, true) from s union all select run, 'not_bf16', not coalesce(bf16, false) from s
      union all select run, 'adapter_size', coalesce(rank, 32) <> 32 from s union all select run, 'dropout', coalesce(dropout, 0) <> 0 from s union all select run, 'missing_projections', targets is not null and len(targets) < {len(_NEEDED)} from s
      union all select run, 'length', coalesce(length, 0) < 512 or length > 262144 from s)
    select run, fault from f where bad"""
)
def setting_faults(spark, d):
    p, k, n = table(spark, d, "part"), F.col("p_partkey"), F.col("p_size")
    targets = F.slice(F.array(*[F.lit(x) for x in _NEEDED]), F.lit(1), F.lit(len(_NEEDED)) - n % 2)
    return contracts.setting_faults(
        p.select(
            k.cast("string").alias("run"), F.when(k % 5 > 0, n % 9 == 0).alias("load_in_4bit"), F.when(k % 3 > 0, n % 7 > 0).alias("load_in_16bit"), F.when(k % 11 > 0, n % 4 > 0).alias("bf16"), F.when(k % 2 == 0, 32 + n % 3).alias("rank"),
            F.lit(32).alias("alpha"), F.when(k % 2 == 1, (n % 3) / 10).alias("dropout"), F.when(k % 4 == 0, targets).alias("target_modules"), (n * 6000).alias("max_length"),
        )
    )


@query("with m as (select s_name as name, s_suppkey % 5 > 0 as present, case s_suppkey % 4 when 0 then 'true' when 1 then '1' when 2 then 'false' end as complete from supplier) select name, case when not present then 'missing' else 'incomplete' end as fault from m where not present or complete is distinct from 'true'")
def manifest_faults(spark, d):
    k = F.col("s_suppkey")
    return contracts.manifest_faults(table(spark, d, "supplier").select(F.col("s_name").alias("name"), (k % 5 > 0).alias("present"), F.when(k % 4 == 0, "true").when(k % 4 == 1, "1").when(k % 4 == 2, "false").alias("complete")))


@query(
    """with r as (select c_custkey as run, ['stage1', 'stage2', 'publish'][c_custkey % 3 + 1] as stage, case when c_nationkey % 3 = 0 then false end as needs, c_custkey % 4 > 0 as gate, case when c_custkey % 5 > 0 then 'stage1' else 'stage2' end as gate_stage,
      case when c_custkey % 7 > 0 then c_nationkey % 2 = 0 end as passed, c_nationkey % 5 > 0 as adapter, case when c_nationkey % 4 > 0 then 'stage' || (c_custkey % 2 + 1) end as adapter_stage from customer),
    f as (select run, 'gate_missing' as fault, stage = 'stage2' and coalesce(needs, true) and not gate as bad from r union all select run, 'gate_not_passed', stage = 'stage2' and gate and not (gate_stage = 'stage1' and coalesce(passed, false)) from r
      union all select run, 'adapter_missing', stage in ('stage2', 'publish') and not adapter from r union all select run, 'adapter_stage', adapter and (stage = 'stage2' and adapter_stage is distinct from 'stage1' or stage = 'publish' and adapter_stage is distinct from 'stage2') from r)
    select run, fault from f where bad"""
)
def lineage_faults(spark, d):
    k, n = F.col("c_custkey"), F.col("c_nationkey")
    stage = F.element_at(F.array(F.lit("stage1"), F.lit("stage2"), F.lit("publish")), (k % 3 + 1).cast("int"))
    return contracts.lineage_faults(
        table(spark, d, "customer").select(
            k.alias("run"), stage.alias("stage"), F.when(n % 3 == 0, False).alias("gate_required"), (k % 4 > 0).alias("gate_present"), F.when(k % 5 > 0, "stage1").otherwise("stage2").alias("gate_stage"), F.when(k % 7 > 0, n % 2 == 0).alias("gate_passed"),
            (n % 5 > 0).alias("adapter_present"), F.when(n % 4 > 0, F.concat(F.lit("stage"), (k % 2 + 1).cast("string"))).alias("adapter_stage"),
        )
    )


_BUNDLES = "select s_suppkey as bundle, '/data/' || (s_suppkey % 7) || '/stage1.jsonl' as a, case when s_suppkey % 6 = 0 then '/data/$X' else '/data/' || ((s_suppkey + (s_suppkey % 5 = 0)::int) % 7) end || '/repo.v2.jsonl' as b from supplier"


def _bundles(spark, d):
    k = F.col("s_suppkey")
    folder = lambda c: F.concat(F.lit("/data/"), (c % 7).cast("string"))
    return table(spark, d, "supplier").select(
        k.alias("bundle"), F.concat(folder(k), F.lit("/stage1.jsonl")).alias("stage1_path"), F.concat(F.when(k % 6 == 0, F.lit("/data/$X")).otherwise(folder(k + (k % 5 == 0).cast("int"))), F.lit("/repo.v2.jsonl")).alias("repo_path")
    )


@query(f"with b as ({_BUNDLES}) select bundle, 'unresolved' as fault from b where contains(a || b, '$') union all select bundle, 'two_directories' from b where regexp_extract(a, '^(.*)/', 1) <> regexp_extract(b, '^(.*)/', 1)")
def layout_faults(spark, d):
    return contracts.layout_faults(_bundles(spark, d))


@query(
    f"""with b as ({_BUNDLES}), l as (select bundle, unnest(['stage1.jsonl', 'stage1.manifest.json', 'repo.v2.jsonl', 'repo.v2.manifest.json']) as name from b)
    select bundle, name, 'missing file' as fault from l where (bundle + length(name)) % 8 = 0 union all select bundle, name, 'incomplete manifest' from l where name like '%.manifest.json' and (bundle * length(name)) % 3 > 0"""
)
def bundle_faults(spark, d):
    b = _bundles(spark, d)
    every = contracts.layout(b)
    files = every.where((F.col("bundle") + F.length("name")) % 8 != 0)
    complete = F.when((F.col("bundle") * F.length("name")) % 3 == 0, "true").when(F.col("bundle") % 2 == 0, "false")
    return contracts.bundle_faults(b, files, every.where(F.col("name").endswith(".manifest.json")).withColumn("complete", complete))


@query(
    """with l as (select s_suppkey as bundle, 1 as version, [s_name] as files, s_nationkey as sha, s_suppkey as examples, s_nationkey::varchar as rev from supplier),
    r as (select s_suppkey as bundle, case when s_suppkey % 3 > 0 then 1 end as version, case when s_suppkey % 4 = 0 then [s_name, 'x'] else [s_name] end as files, s_nationkey % 20 as sha, s_suppkey as examples, s_nationkey::varchar as rev from supplier where s_suppkey % 9 > 0),
    j as (select l.bundle, l.version is distinct from r.version as v, l.files is distinct from r.files as f, l.sha is distinct from r.sha as s, l.examples is distinct from r.examples as e, l.rev is distinct from r.rev as x from l left join r using (bundle))
    select bundle, 'version' as field from j where v union all select bundle, 'files' from j where f union all select bundle, 'file_sha256' from j where s union all select bundle, 'examples' from j where e union all select bundle, 'source_revisions' from j where x"""
)
def description_faults(spark, d):
    k, n, name = F.col("s_suppkey"), F.col("s_nationkey"), F.array("s_name")
    s = table(spark, d, "supplier")
    same = (k.alias("examples"), n.cast("string").alias("source_revisions"))
    left = s.select(k.alias("bundle"), F.lit(1).alias("version"), name.alias("files"), n.alias("file_sha256"), *same)
    right = s.where(k % 9 > 0).select(k.alias("bundle"), F.when(k % 3 > 0, 1).alias("version"), F.when(k % 4 == 0, F.array_append(name, F.lit("x"))).otherwise(name).alias("files"), (n % 20).alias("file_sha256"), *same)
    return contracts.description_faults(right, left)


@query("select repo_id from normalized_examples where not coalesce(regexp_full_match(repo_id, '[A-Za-z0-9_.-]+/[A-Za-z0-9_.-]+'), false)")
def repository_id_faults(spark, d):
    return contracts.repository_id_faults(table(spark, d, "normalized_examples"), "repo_id")


@query(
    """with l as (select o_orderkey as probe, list(l_linenumber order by l_linenumber) as a, list(case when l_quantity > 49 then 0 else l_linenumber end order by l_linenumber) as b from orders join lineitem on l_orderkey = o_orderkey group by 1)
    select probe from l where a <> b or probe % 1000 = 0"""
)
def output_faults(spark, d):
    lists = table(spark, d, "orders").join(table(spark, d, "lineitem"), F.col("l_orderkey") == F.col("o_orderkey")).groupBy(F.col("o_orderkey").alias("probe"))
    text = lambda c: F.transform(F.array_sort(F.collect_list(F.struct("l_linenumber", c.alias("v")))), lambda x: x.v.cast("string"))
    both = lists.agg(text(F.col("l_linenumber")).alias("a"), text(F.when(F.col("l_quantity") > 49, 0).otherwise(F.col("l_linenumber"))).alias("b"))
    return contracts.output_faults(both.select("probe", F.col("a").alias("outputs")), both.where(F.col("probe") % 1000 != 0).select("probe", F.col("b").alias("outputs")))


@query(
    """with e as (select user_id as probe, event_id as line_no, case when event_id % 3 = 0 then 'err' else 'out' end as stream, (user_id % 9 + 1) * 1000 as length, case when user_id % 10 = 0 then 1 else 0 end as code,
      case when event_id % 4 = 1 then 'R:{"length": ' || (user_id % 9 + 1) * 1000 || ', "success": ' || (value > 20)::varchar || ', "headroom_fraction": ' || (event_id % 13) || '}' else event_type || ' ' || repeat('x', (event_id % 900)::int) end as line from events),
    p as (select probe, max(length) as length, max(code) as code, max_by(line[3:], line_no) filter (where stream = 'out' and line like 'R:%') as json, string_agg(line, chr(10) order by line_no) filter (where stream = 'err') as err, string_agg(line, chr(10) order by line_no) filter (where stream = 'out') as out from e group by probe)
    select probe, length::int as length, case when json is not null and code = 0 then (json->>'success')::boolean else false end as success, case when json is not null and code = 0 then (json->>'headroom_fraction')::double end as headroom_fraction,
      case when json is null or code <> 0 then right(coalesce(nullif(err, ''), out, ''), 4000) end as error from p"""
)
def probe_results(spark, d):
    e = table(spark, d, "events")
    k, u = F.col("event_id"), F.col("user_id")
    json = F.concat(F.lit('R:{"length": '), ((u % 9 + 1) * 1000).cast("string"), F.lit(', "success": '), (F.col("value") > 20).cast("string"), F.lit(', "headroom_fraction": '), (k % 13).cast("string"), F.lit("}"))
    line = F.when(k % 4 == 1, json).otherwise(F.concat("event_type", F.lit(" "), F.repeat(F.lit("x"), (k % 900).cast("int"))))
    lines = e.select(u.alias("probe"), k.alias("line_no"), F.when(k % 3 == 0, "err").otherwise("out").alias("stream"), ((u % 9 + 1) * 1000).cast("int").alias("length"), F.when(u % 10 == 0, 1).otherwise(0).alias("exit_code"), line.alias("line"))
    return gates.probe_results(lines, "R:")


@query("select list(distinct (event_id % 7 + 1) * 1000 order by (event_id % 7 + 1) * 1000) as lengths from events")
def probe_lengths(spark, d):
    return gates.probe_lengths(table(spark, d, "events").select(((F.col("event_id") % 7 + 1) * 1000).alias("length")))


@query(
    """with e as (select o_orderkey as k, list(l_linenumber order by l_linenumber) as ids, list(case when l_linenumber > 3 or l_quantity > 48 then l_linenumber else -100 end order by l_linenumber) as labels from orders join (select l_orderkey, l_linenumber, max(l_quantity) as l_quantity from lineitem group by all) on l_orderkey = o_orderkey group by 1),
    p as (select *, list_position(ids, 1) as s, list_position(ids, 2) as u, list_position(ids, 3) as r from e)
    select k, case when u > 0 then 1 else 0 end as turns, case when coalesce(s, 0) = 0 or coalesce(u, 0) = 0 or coalesce(r, 0) = 0 then 'markers not found' when len(list_filter(labels[1:r], lambda x: x <> -100)) > 0 then 'initial tokens are supervised' end as fault from p"""
)
def mask_audit(spark, d):
    lines = table(spark, d, "lineitem").groupBy("l_orderkey", "l_linenumber").agg(F.max("l_quantity").alias("l_quantity"))
    lists = table(spark, d, "orders").join(lines, F.col("l_orderkey") == F.col("o_orderkey")).groupBy(F.col("o_orderkey").alias("k"))
    of = lambda c: F.transform(F.array_sort(F.collect_list(F.struct("l_linenumber", c.alias("v")))), lambda x: x.v)
    label = F.when((F.col("l_linenumber") > 3) | (F.col("l_quantity") > 48), F.col("l_linenumber")).otherwise(-100)
    e = lists.agg(of(F.col("l_linenumber")).alias("ids"), of(label).alias("labels"))
    one = lambda v: F.array(F.lit(v))
    return e.withColumn("m", arrays.mask_audit(F.col("ids"), F.col("labels"), one(1), one(2), one(3))).select("k", "m.turns", "m.fault")


@query(
    f"""with e as (select id, rtrim(array_to_string(list_transform(messages, lambda m: '<' || m.role || '>' || chr(10) || m.content || '<|end|>'), chr(10))) as t, messages from normalized_examples where {_ANSWER} is not null and len(list_filter(messages, lambda m: m.content is null)) = 0)
    select id, sha256(t) as rendered, contains(t, '<|im_start|>user') or contains(t, '<|im_start|>system') as leaks from e"""
)
def rendered(spark, d):
    e = table(spark, d, "normalized_examples").where(F.element_at("messages", -1)["content"].isNotNull() & ~F.exists("messages", lambda m: m.content.isNull()))
    r = e.select("id", messages.render(F.col("messages")).alias("t"))
    return r.select("id", F.sha2("t", 256).alias("rendered"), messages.leaks_markers(F.col("t")).alias("leaks"))


@query("select id from (select id, row_number() over (order by loaded_at, id) as r from (select distinct on (id) id, loaded_at from normalized_examples where split = 'train' order by id, loaded_at)) where r <= 100 union all select id from (select id, row_number() over (order by loaded_at, id) as r from (select distinct on (id) id, loaded_at from normalized_examples where split = 'validation' order by id, loaded_at)) where r <= 25")
def trial_run(spark, d):
    e = table(spark, d, "normalized_examples")
    of = lambda s: e.where(F.col("split") == s).groupBy("id").agg(F.min("loaded_at").alias("loaded_at"))
    train, validation = sampling.limited(of("train"), of("validation"), 100, ["loaded_at", "id"])
    return train.unionByName(validation).select("id")


@query(f"select doc_id, row_number() over (order by {_hex('doc_id::varchar')}, doc_id) as place from documents")
def seeded_shuffle(spark, d):
    return sampling.hash_rank(table(spark, d, "documents").select("doc_id"), F.col("doc_id"), "doc_id")


@query("select event_id, value is null as absent from (select event_id, case event_id % 40 when 0 then null when 1 then 'nan'::double when 2 then 'infinity'::double when 3 then '-infinity'::double else value end as value from events) where value is null or not isfinite(value)")
def not_finite(spark, d):
    k = F.col("event_id") % 40
    value = F.when(k == 0, None).when(k == 1, float("nan")).when(k == 2, float("inf")).when(k == 3, float("-inf")).otherwise(F.col("value"))
    return gates.finite(table(spark, d, "events").select("event_id", value.alias("value")), "value").select("event_id", F.col("value").isNull().alias("absent"))


@query("select 'out/checkpoint-' || max(event_id) filter (where event_id % 3 > 0) as path from events")
def last_checkpoint(spark, d):
    k = F.col("event_id").cast("string")
    return gates.last_checkpoint(table(spark, d, "events").select(F.concat(F.lit("out/checkpoint-"), F.when(F.col("event_id") % 3 > 0, k).otherwise(F.concat(k, F.lit("-tmp")))).alias("path")))


@query("select l_orderkey as k, count(*) filter (where l_quantity > 25)::int as supervised, count(*) filter (where not l_quantity > 25)::int as masked from lineitem group by 1")
def supervised_counts(spark, d):
    labels = table(spark, d, "lineitem").groupBy(F.col("l_orderkey").alias("k")).agg(F.collect_list(F.when(F.col("l_quantity") > 25, F.col("l_linenumber")).otherwise(-100)).alias("labels"))
    return labels.select("k", messages.supervised_counts(F.col("labels")).alias("c")).select("k", "c.supervised", "c.masked")


_STAGE2 = [
    ("baseline", "benchmarks", "humaneval_plus_pass_at_1", 0.20), ("baseline", "benchmarks", "mbpp_plus_pass_at_1", 0.30), ("candidate", "benchmarks", "humaneval_plus_pass_at_1", 0.19), ("candidate", "metrics", "mbpp_plus_pass_at_1", 0.27),
    ("baseline", "repo", "file_recall_at_3", 0.4), ("candidate", "metrics", "file_recall_at_3", 0.42), ("baseline", "metrics", "patch_apply_rate", 0.1), ("candidate", "repo", "patch_apply_rate", 0.16),
]


@query(
    f"""with r as (select * from (values {', '.join(f"('{a}', '{c}', {v}::double)" for a, _, c, v in _STAGE2)}) t(report, metric, v)), p as (select metric, max(v) filter (where report = 'baseline') as b, max(v) filter (where report = 'candidate') as c from r group by metric),
    k as (select 'repo_gain_at_least_5pp' as check_name, max(c - b) filter (where metric in ('file_recall_at_3', 'patch_apply_rate')) >= 0.05 as passed from p union all select 'no_core_regression_over_2pp', max(b - c) filter (where metric like '%plus_pass_at_1') <= 0.02 from p)
    select * from k union all select 'all', bool_and(passed) from k"""
)
def gate_compare_repo(spark, d):
    return gates.compare(spark.createDataFrame(_STAGE2, "report string, section string, metric string, value double"), "stage2")


@query(
    f"""select id, len(list_filter(string_split_regex(array_to_string(list_transform(messages, lambda m: '<' || m.role || '>' || chr(10) || coalesce(m.content, '')), chr(10)), '{_SP}+'), lambda x: x <> ''))::int as tokens
    from normalized_examples where len(list_filter(messages, lambda m: m.role is null)) = 0"""
)
def rendered_tokens(spark, d):
    e = table(spark, d, "normalized_examples").where(~F.exists("messages", lambda m: m.role.isNull()))
    return e.select("id", messages.message_tokens(F.col("messages")).alias("tokens"))


@query(
    """with m as (select event_id % 5 as k, case when event_type = 'click' then value end as a, case when event_id < 0 then value end as b from events)
    select 'a' as metric, round(coalesce(avg(a), 0), 6) as mean, count(a) as n from m union all select 'b', round(coalesce(avg(b), 0), 6), count(b) from m"""
)
def metric_means(spark, d):
    e = table(spark, d, "events").select(F.when(F.col("event_type") == "click", F.col("value")).alias("a"), F.when(F.col("event_id") < 0, F.col("value")).alias("b"))
    return stats.means(e, "", ["a", "b"]).select("metric", F.round("mean", 6).alias("mean"), "n")


#: Rows wanted of each split, for :func:`repo_need`.
_WANTED = {"train": 5000, "validation": 100, "test": 100}


@query(
    """with n as (select lower(trim(language)) as language, count(*) as w from normalized_examples where language is not null group by 1), s as (select * from (values ('train', 5000, 3), ('validation', 100, 25), ('test', 100, 25)) t(split, total, times)),
    x as (select language, split, times, total, total::double * w / sum(w) over (partition by split) as x from n, s), f as (select *, floor(x) as f from x),
    q as (select *, f + case when row_number() over (partition by split order by x - f desc, language) <= total - sum(f) over (partition by split) then 1 else 0 end as quota from f)
    select language, greatest(100, max(quota * times))::bigint as need from q group by language"""
)
def repo_need(spark, d):
    n = table(spark, d, "normalized_examples").where("language is not null").groupBy(F.lower(F.trim("language")).alias("language")).agg(F.count("*").alias("n"))
    weights = {r["language"]: float(r["n"]) for r in n.collect()}  # a row for each language
    targets = {s: sampling.largest_remainder(total, weights) for s, total in _WANTED.items()}
    return spark.createDataFrame([(k, sampling.repo_candidates(targets, k)) for k in weights], "language string, need long")
