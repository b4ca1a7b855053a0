"""The training-data queries and, where SQL can express them, their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gristmill.llm import leakage, mixing, neardup, packing, pairs, residue, splits, token_budget
from gristmill.llm.forest import spanning_forest  # noqa: F401
from gristmill.llm.vocab import Vocab, load_vocab
from gristmill.session import table


def _examples(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "normalized_examples")


def _vocab(spark: SparkSession, d: str) -> Vocab:
    return load_vocab(table(spark, d, "tokenizer_vocab"))


def _counts(spark: SparkSession, d: str) -> DataFrame:
    return token_budget.corrected_counts(_examples(spark, d), _vocab(spark, d))


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    return token_budget.wrong_counts(_counts(spark, d))


def p1_lengths(spark: SparkSession, d: str) -> DataFrame:
    return _counts(spark, d).where("id is not null").select("id", "tokens")


def p1_token_budget(spark: SparkSession, d: str) -> DataFrame:
    return token_budget.token_budget(_counts(spark, d))


def _pack(spark: SparkSession, d: str, stages: DataFrame) -> DataFrame:
    return packing.pack(_examples(spark, d), stages, _vocab(spark, d))


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    return packing.split_examples(_pack(spark, d, table(spark, d, "stage_limits").where("stage = 'stage1'")), "stage1")


def p2_pack(spark: SparkSession, d: str) -> DataFrame:
    return _pack(spark, d, table(spark, d, "stage_limits"))


def p2_report(spark: SparkSession, d: str) -> DataFrame:
    return packing.fill_report(p2_pack(spark, d))


def p2_totals(spark: SparkSession, d: str) -> DataFrame:
    """What packing must keep: of each stage the examples, those longer than the capacity, and the tokens."""
    return p2_report(spark, d).select("stage", "capacity", "examples", "split_examples", "tokens")


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    return neardup.near_pairs(*neardup.similar_classes(_examples(spark, d), 0.7, 3))


def p3_groups(spark: SparkSession, d: str) -> DataFrame:
    return neardup.near_groups(*neardup.similar_classes(_examples(spark, d), 0.7, 3, spanning=True))


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    return splits.torn_repositories(_examples(spark, d))


def p4_splits(spark: SparkSession, d: str) -> DataFrame:
    return splits.grouped_splits(_examples(spark, d))


def p4_sets(spark: SparkSession, d: str) -> DataFrame:
    """``repo, examples, splits``: of each set of tied repositories the least name, its examples, and how many splits they are in."""
    sets, _ = splits.repo_sets(splits._examples(_examples(spark, d)))
    named = sets.groupBy(F.concat(F.lit("repo:"), "root").alias("unit")).agg(F.min("repo").alias("repo"))
    dealt = p4_splits(spark, d).groupBy("unit").agg(F.count("*").alias("examples"), F.count_distinct("split").alias("splits"))
    return named.join(dealt, "unit").select("repo", "examples", "splits")


def p4_shares(spark: SparkSession, d: str) -> DataFrame:
    return splits.split_shares(p4_splits(spark, d))


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    return pairs.broken_pairs(_examples(spark, d))


def p6_leaks(spark: SparkSession, d: str) -> DataFrame:
    return leakage.leaks(table(spark, d, "documents"), table(spark, d, "benchmark"))


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    return p6_leaks(spark, d).select("doc_id", "item_id").distinct()


def _mix(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    return mixing.mix(table(spark, d, "documents"), table(spark, d, "source_weights"), _vocab(spark, d))


def p7_mix(spark: SparkSession, d: str) -> DataFrame:
    return _mix(spark, d)[0]


def p7_shares(spark: SparkSession, d: str) -> DataFrame:
    return _mix(spark, d)[1]


def p7_targets(spark: SparkSession, d: str) -> DataFrame:
    """What the shares are planned from: of each source its weight, its exact share of the sources that have documents, and what there is."""
    return p7_shares(spark, d).select("source", "weight", "max_repeats", F.round("target", 9).alias("target"), "docs", "available")


def p8_found(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents")
    return residue.residue(docs, residue.train(docs))


def p8_validation(spark: SparkSession, d: str) -> DataFrame:
    return residue.validation(table(spark, d, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        f.__name__: f
        for f in (
            p1_found, p1_lengths, p1_token_budget, p2_found, p2_pack, p2_report, p2_totals, p3_found, p3_groups, p4_found, p4_splits, p4_sets, p4_shares,
            p5_found, p6_found, p6_leaks, p7_mix, p7_shares, p7_targets, p8_found, p8_validation,
        )
    }


# --- SQL ---------------------------------------------------------------------

#: Distinct examples and their exact lengths: a piece is the longest alternative that matches, anything else costs its bytes.
_LENGTHS = r"""
with pattern as (
  select string_agg(regexp_replace(piece, '([^A-Za-z0-9_])', '\\\1', 'g'), '|' order by length(piece) desc, piece) || '|[^\s]' as p, list(piece) as pieces from tokenizer_vocab
), one as (
  select distinct on (id) id, token_count, source, language, metadata.domain as domain, messages from normalized_examples where id is not null order by id, loaded_at desc
), msg as (
  select id, unnest(messages) as m from one
), per as (
  select id, sum(4 + coalesce(list_sum(list_transform(regexp_extract_all(regexp_replace(coalesce(m.content, ''), '[\s\x0b\x1c-\x1f\x85\p{Z}]', ' ', 'g'), p),
    lambda t: case when length(t) > 1 or list_contains(pieces, t) then 1 else strlen(t) end)), 0)) as tokens from msg, pattern group by id
), lengths as (
  select one.id, token_count, coalesce(per.tokens, 0)::bigint as tokens, source, language, domain from one left join per using (id)
)
"""

_SLUG = r"nullif(regexp_replace(trim(lower(regexp_replace({0}, '\s+', ' ', 'g'))), '[ \-]+', '_', 'g'), '')"

_REPO_NAME = r"""regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(lower(r), '\s+', '', 'g'), '^[a-z+]+://[^/]+/', ''), '^[^/@]+@[^:/]+[:/]', ''), '^/+', ''), '(/|\.git)+$', '')"""


#: Shingle sets, and how many two of them share.
_SIMILAR = r"""
with recursive one as (select distinct on (id) id, messages from normalized_examples where id is not null),
words as (select id, regexp_extract_all(lower(array_to_string([coalesce(m.content, '') for m in messages if m.role in ('user', 'assistant')], chr(10))), '[\p{L}\p{N}_]+') as w from one),
sh as (select distinct id, unnest([w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] for i in range(1, len(w) - 1)]) as s from words where len(w) >= 3),
size as (select id, count(*) as n from sh group by id),
common as (select a.id as id_a, b.id as id_b, count(*) as c from sh a join sh b on a.s = b.s and a.id < b.id group by 1, 2),
near as (select id_a, id_b, c = x.n and c = y.n as same from common join size x on x.id = id_a join size y on y.id = id_b where c >= 0.7 * (x.n + y.n - c))
"""

_REPO_ROOTS = r"""
with recursive rows as (select distinct on (id) id, repo_id, split from normalized_examples where id is not null order by id, loaded_at desc),
named as (select id, split, list_sort(list_distinct(list_filter(list_transform(regexp_split_to_array(repo_id, '[,;]'), lambda r: {0}), lambda r: r <> ''))) as repos from rows where repo_id is not null),
link as (select distinct a.r as u, b.r as v from (select id, unnest(repos) as r from named) a join (select id, unnest(repos) as r from named) b using (id)),
reach(u, v) as (select u, v from link union select reach.u, link.v from reach join link on reach.v = link.u),
root as (select u as repo, min(v) as root from reach group by u)
"""


def oracle_sql() -> dict[str, str]:
    from gristmill.llm.common import LANGUAGE_SPELLINGS

    cases = " ".join(f"when '{k}' then '{v}'" for k, v in LANGUAGE_SPELLINGS.items())
    language = f"case when trim(lower(language)) is null or trim(lower(language)) = '' then 'unknown' else case trim(lower(language)) {cases} else trim(lower(language)) end end"
    return {
        "p1_found": _LENGTHS + "select id from lengths where token_count is null or abs(token_count - tokens) > tokens * 0.1",
        "p1_lengths": _LENGTHS + "select id, tokens from lengths",
        "p1_token_budget": _LENGTHS
        + f""", clean as (select coalesce({_SLUG.format('source')}, 'unknown') as source, {language} as language, coalesce({_SLUG.format('domain')}, 'unknown') as domain, tokens from lengths)
        select case when grouping(source) = 1 then '*' else source end as source, case when grouping(language) = 1 then '*' else language end as language,
          case when grouping(domain) = 1 then '*' else domain end as domain, count(*) as examples, sum(tokens)::bigint as tokens
        from clean group by grouping sets ((source, language, domain), (source, language), (source), (language), (domain), ())""",
        "p2_found": _LENGTHS + "select id from lengths where tokens > (select capacity from stage_limits where stage = 'stage1')",
        "p2_totals": _LENGTHS
        + """select stage, capacity, count(*) as examples, count(*) filter (where tokens > capacity) as split_examples, sum(tokens)::bigint as tokens from lengths, stage_limits group by stage, capacity""",
        "p3_found": _SIMILAR + "select id_a, id_b from near",
        "p3_groups": _SIMILAR
        + """, short as (select id, array_to_string(w, ' ') as s from words where len(w) between 1 and 2),
        every as (select id_a, id_b, same from near union all select x.id, y.id, true from short x join short y on x.s = y.s and x.id < y.id),
        sides as (select id_a as u, id_b as v, same from every union all select id_b, id_a, same from every),
        cls as (select one.id, least(one.id, coalesce(min(v), one.id)) as cls from one left join sides on u = one.id and same group by one.id),
        reach(u, v) as (select id, id from one union select reach.u, sides.v from reach join sides on reach.v = sides.u), grp as (select u as id, min(v) as grp from reach group by u),
        links as (select a.cls, count(distinct b.cls) as links from sides join cls a on a.id = u join cls b on b.id = v where a.cls <> b.cls group by a.cls)
        select cls.id, cls.cls, grp, coalesce(links, 0) as links from cls join grp using (id) left join links on links.cls = cls.cls""",
        "p4_sets": _REPO_ROOTS.format(_REPO_NAME)
        + "select root as repo, count(*) as examples, 1 as splits from named join root on root.repo = named.repos[1] group by root",
        "p7_targets": _LENGTHS[: _LENGTHS.index("), one as")]
        + rf"""), docs as (select coalesce({_SLUG.format('source')}, 'unknown') as source, coalesce(list_sum(list_transform(regexp_extract_all(regexp_replace(coalesce(text, ''), '[\s\x0b\x1c-\x1f\x85\p{{Z}}]', ' ', 'g'), p), lambda t: case when length(t) > 1 or list_contains(pieces, t) then 1 else strlen(t) end)), 0) as tokens
          from documents, pattern where doc_id is not null),
        sizes as (select source, count(*) as docs, sum(tokens)::bigint as available from docs group by source),
        w as (select {_SLUG.format('source')} as source, max(weight) as weight, max(max_repeats) as max_repeats from source_weights where source is not null group by 1),
        j as (select source, weight, max_repeats, coalesce(docs, 0) as docs, coalesce(available, 0) as available, coalesce(available, 0) > 0 and coalesce(weight, 0) > 0 and coalesce(max_repeats, 0) > 0 as usable from w full join sizes using (source))
        select source, weight, max_repeats, round(case when usable then weight / sum(weight) filter (where usable) over () else 0 end, 9) as target, docs, available from j""",
        "p4_found": rf"""
        {_REPO_ROOTS.format(_REPO_NAME)},
        marks as (select root, case lower(trim(split)) when 'val' then 'validation' when 'valid' then 'validation' when 'dev' then 'validation' else lower(trim(split)) end as s
          from named join root on root.repo = named.repos[1] where split is not null),
        torn as (select root from marks where s in ('train', 'validation', 'test') group by root having count(distinct s) > 1)
        select repo from root where root in (select root from torn)""",
    }
