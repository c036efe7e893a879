"""Queries over the problems of this subpackage, and their SQL where SQL can say the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from railyard.core import table
from railyard.llm.encode import encode_texts
from railyard.llm.leaks import find_leaks, leak_report
from railyard.llm.mixing import mix_records, mix_report
from railyard.llm.mojibake import find_garbled
from railyard.llm.overlaps import overlap_pairs, overlap_report
from railyard.llm.packing import fill_report, pack_documents
from railyard.llm.quota import quota_report, quota_sample
from railyard.llm.runs import collapse_runs

Query = Callable[[SparkSession, str], DataFrame]


def p1_found(spark: SparkSession, sf: str) -> DataFrame:
    return find_leaks(table(spark, sf, "areal_chat"), table(spark, sf, "heldout_items"))


def p1_report(spark: SparkSession, sf: str) -> DataFrame:
    return leak_report(table(spark, sf, "areal_chat"), table(spark, sf, "heldout_items"))


def p2_found(spark: SparkSession, sf: str) -> DataFrame:
    report = quota_report(table(spark, sf, "db_traces_chat"), table(spark, sf, "sample_targets"))
    return report.filter("short").select("request_id", "category")


def p2_sample(spark: SparkSession, sf: str) -> DataFrame:
    return quota_sample(table(spark, sf, "db_traces_chat"), table(spark, sf, "sample_targets"))


def p2_report(spark: SparkSession, sf: str) -> DataFrame:
    return quota_report(table(spark, sf, "db_traces_chat"), table(spark, sf, "sample_targets"))


def p3_found(spark: SparkSession, sf: str) -> DataFrame:
    return mix_report(table(spark, sf, "sft_mix_chat"), table(spark, sf, "mix_targets")).filter("short").select("mix_id", "source")


def p3_mix(spark: SparkSession, sf: str) -> DataFrame:
    return mix_records(table(spark, sf, "sft_mix_chat"), table(spark, sf, "mix_targets"))


def p3_report(spark: SparkSession, sf: str) -> DataFrame:
    return mix_report(table(spark, sf, "sft_mix_chat"), table(spark, sf, "mix_targets"))


def p4_found(spark: SparkSession, sf: str) -> DataFrame:
    return overlap_pairs(table(spark, sf, "db_tasks"), table(spark, sf, "task_splits"))


def p4_report(spark: SparkSession, sf: str) -> DataFrame:
    return overlap_report(table(spark, sf, "db_tasks"), table(spark, sf, "task_splits"))


def p5_found(spark: SparkSession, sf: str) -> DataFrame:
    return collapse_runs(table(spark, sf, "db_traces_chat")).select("trace_id", "first_seq", "last_seq")


def p5_collapsed(spark: SparkSession, sf: str) -> DataFrame:
    return collapse_runs(table(spark, sf, "db_traces_chat"), min_calls=1)


def p6_ids(spark: SparkSession, sf: str) -> DataFrame:
    return encode_texts(table(spark, sf, "documents"))


def p7_placed(spark: SparkSession, sf: str) -> DataFrame:
    return pack_documents(table(spark, sf, "documents"), table(spark, sf, "pack_sizes"))


def p7_fill(spark: SparkSession, sf: str) -> DataFrame:
    packs = table(spark, sf, "pack_sizes")
    return fill_report(pack_documents(table(spark, sf, "documents"), packs), packs)


def p8_found(spark: SparkSession, sf: str) -> DataFrame:
    return find_garbled(table(spark, sf, "documents")).select("doc_id")


def p8_restored(spark: SparkSession, sf: str) -> DataFrame:
    return find_garbled(table(spark, sf, "documents"))


QUERIES: dict[str, Query] = {
    "p1_found": p1_found, "p1_report": p1_report,
    "p2_found": p2_found, "p2_sample": p2_sample, "p2_report": p2_report,
    "p3_found": p3_found, "p3_mix": p3_mix, "p3_report": p3_report,
    "p4_found": p4_found, "p4_report": p4_report,
    "p5_found": p5_found, "p5_collapsed": p5_collapsed,
    "p6_ids": p6_ids,
    "p7_placed": p7_placed, "p7_fill": p7_fill,
    "p8_found": p8_found, "p8_restored": p8_restored,
}

LABEL = "nullif(regexp_replace(lower(trim({0}, ' ' || chr(9) || chr(10) || chr(13) || chr(160))), '[\\s-]+', '_', 'g'), '')"

SQL: dict[str, str] = {}

SQL["p2_found"] = f"""
with r as (
  select *, row_number() over (partition by task_id, sample_idx, case when task_id is null or sample_idx is null then trace_id end
                               order by (ingested_at is null)::int, ingested_at, trace_id) as rn
  from db_traces_chat),
l as (
  select {LABEL.format('template')} as template, coalesce({LABEL.format('fault')}, 'none') as fault,
         coalesce(replan, false)::varchar as replan, coalesce({LABEL.format('recovery_mode')}, 'direct') as recovery_mode
  from r where rn = 1),
c as (
  select 'template' as category_field, template as category from l
  union all select 'fault', fault from l
  union all select 'recovery_mode', recovery_mode from l
  union all select 'replan', replan from l
  union all select 'fault|replan|recovery_mode', fault || '|' || replan || '|' || recovery_mode from l),
n as (select category_field, category, count(*) as n from c group by all)
select t.request_id, t.category
from sample_targets t left join n using (category_field, category)
where coalesce(n.n, 0) < greatest(t.min_rows, t.sample_size * t.target_permille // 1000)"""

SQL["p3_found"] = f"""
with r as (
  select {LABEL.format('source')} as source,
         coalesce(list_sum(list_transform(messages, lambda m: coalesce(length(m.content), 0))), 0) as n_chars,
         row_number() over (partition by origin_id, case when origin_id is null then record_id end
                            order by (ingested_at is null)::int, ingested_at, record_id) as rn
  from sft_mix_chat),
s as (select source, sum(n_chars) as n from r where rn = 1 group by source)
select t.mix_id, t.source
from mix_targets t left join s using (source)
where coalesce(s.n, 0) * t.max_repeats < t.total_chars * t.target_permille // 1000"""


def queries() -> dict[str, Query]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(SQL)
