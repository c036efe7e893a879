"""Evaluation reports (accept gate, baselines, bands, subtotals, pass rates, leader board)."""

from __future__ import annotations

from pyspark.sql import functions as F

from railyard.core import table
from railyard.operators import report as op
from railyard.plans.registry import query
from railyard.plans.views import FIRST_TRACES, RECORDS, TRACES, first_traces, mix_records, traces

OK = "(score = 1.0 and not truncated)"


@query("eval_report_by_group", f"""with {TRACES}
select template, count(*) as n, count(*) filter ({OK}) as ok, sum(coalesce(expected_calls, 0))::bigint as turns, sum(coalesce(n_tool_calls, 0))::bigint as calls,
       count(*) filter ({OK}) / greatest(1, count(*)) as "yield", sum(coalesce(n_tool_calls, 0))::bigint / greatest(1, count(*)) as calls_per_row
from traces group by template""")
def eval_report_by_group(spark, sf):
    zero = lambda c: F.coalesce(c, F.lit(0))
    return op.evaluation_by_group(traces(spark, sf), "template", op.accepted_trace(), zero("expected_calls"), zero("n_tool_calls"))


@query("eval_delta_vs_baseline", f"""with {TRACES},
r as (select template, teacher = 'oracle' as is_base, count(*) filter ({OK}) / greatest(1, count(*)) as y, count(*) as n from traces group by all)
select a.template, a.n, a.y as "yield", b.y as base_yield, a.y - b.y as delta
from (select template, count(*) as n, count(*) filter ({OK}) / greatest(1, count(*)) as y from traces where teacher <> 'oracle' group by template) a
left join (select * from r where is_base) b using (template)""")
def eval_delta_vs_baseline(spark, sf):
    t = traces(spark, sf)
    one = lambda d: op.evaluation_by_group(d, "template", op.accepted_trace(), F.lit(0), F.lit(0)).select("template", "n", "yield")
    return op.with_baseline(one(t.filter("teacher <> 'oracle'")), one(t.filter("teacher = 'oracle'")), "template", "yield")


@query("band_caps", f"""with {TRACES},
e as (select template, count(*) as n_eval, count(*) filter ({OK}) as ok from traces where sample_idx = 0 and finish_reason <> 'stop' group by template),
l as (select template, count(*) as n_leg from traces group by template),
j as (select template, n_leg, coalesce(n_eval, 0) as n_eval, coalesce(ok, 0) as ok, case when n_eval > 0 then ok / n_eval end as y from l left join e using (template)),
b as (select *, case when n_eval < 10 then null when y >= 0.85 then 'high' when y >= 0.45 then 'mid' else 'low' end as band from j)
select template, n_leg, n_eval, ok, y as "yield", band, case band when 'high' then 60 when 'mid' then 250 end as cap from b""")
def band_caps(spark, sf):
    t = traces(spark, sf)
    return op.band_caps(t.filter("sample_idx = 0 and finish_reason <> 'stop'"), t, "template", op.accepted_trace())


@query("variant_shares_before_after", f"""with {TRACES},
v as (select phase, variant, value, count(*) as n from (
  select phase, unnest([{{'variant': 'replan', 'value': replan::varchar}}, {{'variant': 'fault', 'value': fault}}, {{'variant': 'recovery_mode', 'value': recovery_mode}}], recursive := true)
  from (select 'before' as phase, * from traces union all select 'after', * from traces where {OK})) group by all)
select phase, variant, value, n, n / sum(n) over (partition by phase, variant) as share from v""")
def variant_shares_before_after(spark, sf):
    t = traces(spark, sf).select("replan", "fault", "recovery_mode", "score", "truncated")
    columns = ["replan", "fault", "recovery_mode"]
    before = op.shares(t, columns).withColumn("phase", F.lit("before"))
    return before.unionByName(op.shares(t.filter(op.accepted_trace()), columns).withColumn("phase", F.lit("after")))


@query("subtotals_grouping_sets", f"""with {TRACES}
select teacher, template, grouping_id(teacher, template) as level, count(*) as n, sum({OK}::int)::bigint as good,
       sum({OK}::int)::bigint / greatest(1, count(*)) as ratio
from traces group by grouping sets ((teacher, template), (teacher), ())""")
def subtotals_grouping_sets(spark, sf):
    return op.subtotals(traces(spark, sf), "teacher", "template", op.accepted_trace())


@query("weighted_mean", f"""with {TRACES}, g as (select template, sum({OK}::int)::bigint as ok, count(*) as n from traces group by template)
select sum((ok / n) * n) / sum(n) as weighted_mean, sum(n)::bigint as weight from g""")
def weighted_mean(spark, sf):
    g = traces(spark, sf).groupBy("template").agg((F.count_if(op.accepted_trace()) / F.count("*")).alias("p"), F.count("*").alias("n"))
    return op.weighted_mean(g, "p", "n")


@query("pass_hat_k", f"""with {FIRST_TRACES}, g as (select task_id, count(*) as n, count(*) filter ({OK}) as c from first_traces group by task_id)
select avg(c / n) as pass_hat_1, count(*) as items_1,
       avg(case when n >= 2 then 1.0::double * greatest(c, 0) / greatest(n, 1) * greatest(c - 1, 0) / greatest(n - 1, 1) end) as pass_hat_2, count(*) filter (n >= 2) as items_2
from g""")
def pass_hat_k(spark, sf):
    return op.pass_hat_k(first_traces(spark, sf, "score", "truncated"), "task_id", op.accepted_trace(), (1, 2))


@query("termination_histogram", "select split_part(finish_reason, ':', 1) as reason, count(*) as n from db_traces_chat group by 1")
def termination_histogram(spark, sf):
    return op.histogram(table(spark, sf, "db_traces_chat"), F.split_part("finish_reason", F.lit(":"), F.lit(1)), "reason")


@query("duplicate_keys", """select sum(k)::bigint as n_rows, count(*) as n_keys, (sum(k) - count(*))::bigint as n_duplicates
from (select task_id, sample_idx, count(*) as k from db_traces_chat group by all)""")
def duplicate_keys(spark, sf):
    return op.duplicate_keys(table(spark, sf, "db_traces_chat"), ["task_id", "sample_idx"])


@query("duplicate_lines", """select sum(k)::bigint as n_rows, count(*) as n_keys, (sum(k) - count(*))::bigint as n_duplicates
from (select l_orderkey, l_linenumber, count(*) as k from lineitem group by all)""")
def duplicate_lines(spark, sf):
    return op.duplicate_keys(table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


@query("source_mix_shares", f"""with {RECORDS},
s as (select source, count(*) as n, sum(coalesce(list_sum(list_transform(list_filter(messages, lambda m: m.role = 'assistant'), lambda m: coalesce(length(m.content), 0))), 0))::bigint as size
      from records group by source)
select source, n, size, n / sum(n) over () as row_share, size / sum(size) over () as size_share from s""")
def source_mix_shares(spark, sf):
    spoken = F.filter("messages", lambda m: m["role"] == "assistant")
    size = F.coalesce(F.aggregate(spoken, F.lit(0).cast("long"), lambda n, m: n + F.coalesce(F.length(m["content"]), F.lit(0))), F.lit(0))
    return op.source_shares(mix_records(spark, sf).select("source", size.alias("size")), "source", "size")


@query("teacher_leaderboard", f"""with {TRACES},
g as (select teacher, count(*) as n, count(*) filter (score = 1.0) as ok, count(*) filter (injected) as n_injected, count(*) filter (injected and replan) as n_replan,
             count(*) filter (starts_with(finish_reason, 'error')) as n_error, sum(round(wall_s * 1000)::bigint)::bigint as wall_ms
      from traces group by teacher)
select *, ok / greatest(1, n) as "yield", n_replan / greatest(1, n_injected) as replan_rate, wall_ms / 1000.0::double / n as seconds_per_row,
       ok * 3600000.0::double / greatest(1, wall_ms) as ok_per_hour
from g""")
def teacher_leaderboard(spark, sf):
    return op.leaderboard(traces(spark, sf), "teacher")


@query("component_rates", """with c as (
  select unnest([{'component': 'score', 'met': score = 1.0}, {'component': 'not_truncated', 'met': not truncated},
                 {'component': 'calls_in_time', 'met': coalesce(n_tool_calls, 0) < 3 * expected_calls},
                 {'component': 'finished', 'met': finish_reason = 'stop'}], recursive := true) from db_traces_chat)
select component, count(*) as total, count(*) filter (met) as met from c group by component""")
def component_rates(spark, sf):
    checks = {
        "score": F.col("score") == 1.0, "not_truncated": ~F.col("truncated"),
        "calls_in_time": F.coalesce("n_tool_calls", F.lit(0)) < 3 * F.col("expected_calls"), "finished": F.col("finish_reason") == "stop",
    }
    return table(spark, sf, "db_traces_chat").agg(
        *(F.count_if(c).alias(n) for n, c in checks.items()), F.count("*").alias("total")
    ).select(F.explode(F.array(*(F.struct(F.lit(n).alias("component"), F.col("total"), F.col(n).alias("met")) for n in checks))).alias("c")).select("c.*")


@query("health_counters", """select source, count(*) as n, count(*) filter (n_messages is null or n_messages = 0) as zero_input, count(*) filter (n_messages >= 15) as at_cap,
  count(*) filter (self_recovery) as recovered, count(*) - count(*) filter (n_messages is null or n_messages = 0) - count(*) filter (n_messages >= 15) as remainder
from (select coalesce(nullif(regexp_replace(lower(trim(source)), '[\\s-]+', '_', 'g'), ''), '?') as source, n_messages, self_recovery from sft_mix_chat)
group by source""")
def health_counters(spark, sf):
    g = mix_records(spark, sf).groupBy("source").agg(
        F.count("*").alias("n"), F.count_if(F.coalesce("n_messages", F.lit(0)) == 0).alias("zero_input"), F.count_if(F.col("n_messages") >= 15).alias("at_cap"), F.count_if("self_recovery").alias("recovered")
    )
    return g.withColumn("remainder", F.col("n") - F.col("zero_input") - F.col("at_cap"))


@query("checkpoint_selection", f"""with {TRACES}, g as (select sample_idx, count(*) filter ({OK}) / count(*) as y from traces group by sample_idx)
select sample_idx as best_epoch, y as "yield" from g order by y desc, sample_idx desc limit 1""")
def checkpoint_selection(spark, sf):
    g = traces(spark, sf).groupBy("sample_idx").agg((F.count_if(op.accepted_trace()) / F.count("*")).alias("y"))
    best = F.max_by(F.struct("sample_idx", "y"), F.struct("y", "sample_idx"))
    return g.agg(best.alias("b")).select(F.col("b.sample_idx").alias("best_epoch"), F.col("b.y").alias("yield"))
