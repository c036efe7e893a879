"""Caps, stratified samples, splits, hold-outs, pools and resumption."""

from __future__ import annotations

from pyspark.sql import functions as F

from railyard.core import clean_label, table
from railyard.operators import report, sampling as op
from railyard.operators.predicates import accepted, first_reason, inefficient
from railyard.plans.registry import query
from railyard.plans.views import FIRST_TRACES, RECORDS, TRACES, first_traces, label_sql, mix_records, traces

OK = "(score = 1.0 and not truncated)"


@query("capped_stratified_sample", f"""with {TRACES},
e as (select template, count(*) as n_eval, count(*) filter ({OK}) as ok from traces group by template),
caps as (select template, case when n_eval < 10 then null when ok / n_eval >= 0.85 then 60 when ok / n_eval >= 0.45 then 250 end as cap from e),
s as (select template, cap, fault, replan, recovery_mode, count(*) as size from traces join caps using (template) group by all),
p as (select *, sum(size) over (partition by template) as n, cap * size // sum(size) over (partition by template) as fl,
             row_number() over (partition by template order by size, fault, replan, recovery_mode) as rk from s),
q as (select *, cap - sum(fl) over (partition by template) as lo from p),
z as (select *, case when n > cap then fl + (rk <= lo)::int else size end as seats from q)
select trace_id, template, fault, replan, recovery_mode from (
  select t.*, z.seats, row_number() over (partition by t.template, t.fault, t.replan, t.recovery_mode order by sha256('s1|' || t.trace_id::varchar)) as k
  from traces t join z using (template, fault, replan, recovery_mode)) where k <= seats""")
def capped_stratified_sample(spark, sf):
    t = traces(spark, sf).select("trace_id", "template", "fault", "replan", "recovery_mode", "score", "truncated")
    caps = report.band_caps(t, t, "template", report.accepted_trace()).select("template", "cap")
    rows = op.with_caps(t, caps, "template", "cap")
    return op.capped_stratified(rows, "template", ["fault", "replan", "recovery_mode"], "cap", "trace_id", "s1").select("trace_id", "template", "fault", "replan", "recovery_mode")


TASKS = f"""tasks as (select * replace (coalesce({label_sql('template')}, '?') as template) from db_tasks
  qualify row_number() over (partition by task_no order by exported_at) = 1)"""


def tasks(spark, sf):
    t = table(spark, sf, "db_tasks").withColumn("template", F.coalesce(clean_label("template"), F.lit("?")))
    row = F.struct(*(c for c in t.columns if c != "task_no"))
    return t.groupBy("task_no").agg(F.min_by(row, "exported_at").alias("r")).select("task_no", "r.*")


@query("uniform_splits", f"""with {TASKS},
r as (select task_no, task_id, template, row_number() over (partition by template order by sha256('split|' || task_id)) as k from tasks)
select task_no, template, case when k <= 10 then 'heldout_eval' when k <= 30 then 'rl_train' else 'sft_train' end as split, k = 31 as is_dev from r""")
def uniform_splits(spark, sf):
    return op.uniform_splits(tasks(spark, sf), "template", "task_id", "split").select("task_no", "template", "split", "is_dev")


@query("holdout_split", f"""with {RECORDS},
r as (select record_id, source, count(*) over (partition by source) as n, row_number() over (partition by source order by sha256('val|' || record_id::varchar)) as k from records)
select record_id, source, case when k <= round_even(n * 0.0188::double, 0) then 'val' else 'train' end as part from r""")
def holdout_split(spark, sf):
    return op.hold_out(mix_records(spark, sf), "source", "record_id", "val", 0.0188).select("record_id", "source", "part")


@query("biased_pool", f"""with {TRACES},
r as (select *, sha256('pool|' || trace_id::varchar) as d from traces),
f as (select trace_id from r where score < 1.0 order by d limit 100),
c as (select r.*, case when trace_id in (select trace_id from f) then 0 when fault <> 'none' then 1 else 2 end as c from r)
select trace_id, template, case c when 0 then 'weak' when 1 then 'fault' else 'rest' end as origin from c order by c, d limit 200""")
def biased_pool(spark, sf):
    t = traces(spark, sf).select("trace_id", "template", "score", "fault")
    return op.biased_pool(t, "trace_id", F.col("score") < 1.0, F.col("fault") != "none", 200, "pool").select("trace_id", "template", "origin")


@query("per_class_limit", f"""with {RECORDS},
r as (select record_id, source, row_number() over (partition by source order by sha256('class|' || record_id::varchar)) as k from records)
select record_id, source from r where k <= case source when 'db_bahn' then 100 when 'areal' then 50 when 'toolace' then 25 else k end""")
def per_class_limit(spark, sf):
    return op.per_class_limit(mix_records(spark, sf).select("record_id", "source"), "source", "record_id", "class", {"db_bahn": 100, "areal": 50, "toolace": 25})


@query("round_robin_pick", f"""with {TASKS}, r as (select task_no, template, row_number() over (partition by template order by task_no) as turn from tasks)
select task_no, template, turn::int as turn from r order by turn, template, task_no limit 100""")
def round_robin_pick(spark, sf):
    return op.round_robin(tasks(spark, sf).select("task_no", "template"), "template", "task_no", 100)


@query("bernoulli_faults", f"""with {TASKS}
select task_no from tasks where ('0x' || substr(sha256('fault|' || task_id), 1, 13))::bigint / 4503599627370496.0::double < 0.43""")
def bernoulli_faults(spark, sf):
    return op.bernoulli(tasks(spark, sf), "task_id", 0.43, "fault").select("task_no")


@query("dedupe_then_draw", f"""with {TRACES},
r as (select trace_id, task_id, template, sha256('d|' || trace_id::varchar) as d from traces where {OK}),
o as (select * from r qualify row_number() over (partition by task_id order by d, trace_id) = 1)
select trace_id, task_id, template from o qualify row_number() over (partition by template order by d, trace_id) <= 5""")
def dedupe_then_draw(spark, sf):
    t = traces(spark, sf).select("trace_id", "task_id", "template", "score", "truncated")
    return op.dedupe_then_draw(t, ["task_id"], report.accepted_trace(), "template", "trace_id", 5, "d").select("trace_id", "task_id", "template")


@query("disjoint_batches", f"""with {TASKS},
r as (select task_no, template, row_number() over (partition by template order by sha256('b|' || task_no::varchar)) - 1 as k, count(*) over (partition by template) as n from tasks)
select task_no, template, (k // 3)::bigint as batch from r where k // 3 < n // 3""")
def disjoint_batches(spark, sf):
    return op.disjoint_batches(tasks(spark, sf).select("task_no", "template"), "template", "task_no", 3, "b").select("task_no", "template", F.col("batch").cast("long").alias("batch"))


REASON = """case when s.split is null then 'off_split' when score < 1.0 then 'unverified' when truncated then 'truncated' when starts_with(finish_reason, 'error') then 'degen'
  when coalesce(expected_calls, 0) > 0 and coalesce(n_tool_calls, 0) >= 3 * coalesce(expected_calls, 0) then 'inefficient'
  when coalesce(len(tool_calls), 0) = 0 then 'structure' end"""
IN_TRAIN = "(select distinct task_id, split from task_splits where split = 'sft_train')"


def reasons(spark, sf):
    train = table(spark, sf, "task_splits").filter("split = 'sft_train'").select("task_id", "split").distinct()
    t = traces(spark, sf).join(train, "task_id", "left")
    return t.withColumn("reason", first_reason(
        ("off_split", F.col("split").isNull()), ("unverified", F.col("score") < 1.0), ("truncated", F.col("truncated")), ("degen", F.col("finish_reason").startswith("error")),
        ("inefficient", inefficient(F.col("n_tool_calls"), F.col("expected_calls"))), ("structure", F.coalesce(F.size("tool_calls"), F.lit(0)) <= 0),
    ))


@query("reject_reason_chain", f"""with {TRACES} select trace_id, {REASON} as reason from traces t left join {IN_TRAIN} s using (task_id)""")
def reject_reason_chain(spark, sf):
    return reasons(spark, sf).select("trace_id", "reason")


@query("reject_reason_counts", f"""with {TRACES}, r as (select template, coalesce({REASON}, 'kept') as reason from traces t left join {IN_TRAIN} s using (task_id))
select template, reason, count(*) as n from r group by all""")
def reject_reason_counts(spark, sf):
    return reasons(spark, sf).groupBy("template", F.coalesce("reason", F.lit("kept")).alias("reason")).agg(F.count("*").alias("n"))


@query("best_reject_per_task", f"""with {TRACES},
r as (select task_id, trace_id, {REASON} as reason from traces t left join {IN_TRAIN} s using (task_id)),
k as (select *, case reason when 'structure' then 5 when 'inefficient' then 4 when 'degen' then 3 when 'truncated' then 2 when 'unverified' then 1 else 0 end as rank from r where reason is not null),
z as (select task_id from r where reason is null)
select task_id, trace_id, reason from k where task_id not in (select task_id from z) qualify row_number() over (partition by task_id order by rank desc, trace_id) = 1""")
def best_reject_per_task(spark, sf):
    r = reasons(spark, sf).select("task_id", "trace_id", "reason")
    order = F.create_map(*(F.lit(x) for p in (("structure", 5), ("inefficient", 4), ("degen", 3), ("truncated", 2), ("unverified", 1), ("off_split", 0)) for x in p))
    best = F.max_by(F.struct("trace_id", "reason"), F.struct(order[F.col("reason")], -F.col("trace_id")))
    g = r.groupBy("task_id").agg(F.count_if(F.col("reason").isNull()).alias("kept"), best.alias("b")).filter("kept = 0")
    return g.select("task_id", "b.trace_id", "b.reason")


@query("missing_anti", "select distinct task_id from task_splits where split = 'sft_train' and task_id not in (select task_id from db_traces_chat where score = 1.0)")
def missing_anti(spark, sf):
    want = table(spark, sf, "task_splits").filter("split = 'sft_train'").select("task_id").distinct()
    return want.join(table(spark, sf, "db_traces_chat").filter("score = 1.0"), "task_id", "left_anti")


@query("resume_todo", f"""with {TASKS}, w as (select task_id, s::int as sample_idx from (select distinct task_id from tasks), unnest([0, 1, 2]) u(s))
select task_id, sample_idx from w where (task_id, sample_idx) not in (select task_id, sample_idx from db_traces_chat)""")
def resume_todo(spark, sf):
    want = tasks(spark, sf).select("task_id").distinct().withColumn("sample_idx", F.explode(F.array(*(F.lit(i) for i in range(3)))))
    return want.join(table(spark, sf, "db_traces_chat"), ["task_id", "sample_idx"], "left_anti")


@query("best_of_attempts", f"""with {FIRST_TRACES}
select task_id, max({OK}::int)::boolean as any_ok, count(*) as attempts, arg_max(sample_idx, (score, -sample_idx)) as best_attempt, max(score) as best_score from first_traces group by task_id""")
def best_of_attempts(spark, sf):
    t = first_traces(spark, sf, "score", "truncated")
    return t.groupBy("task_id").agg(
        F.bool_or(accepted(F.col("score"), F.col("truncated"))).alias("any_ok"), F.count("*").alias("attempts"),
        F.max_by("sample_idx", F.struct("score", -F.col("sample_idx"))).alias("best_attempt"), F.max("score").alias("best_score"),
    )


@query("split_checks", """with s as (select distinct split, task_id from task_splits)
select a.split as split_a, b.split as split_b, count(*) as n_common from s a join s b on a.task_id = b.task_id and a.split < b.split group by all""")
def split_checks(spark, sf):
    s = table(spark, sf, "task_splits").select("split", "task_id").distinct()
    g = s.groupBy("task_id").agg(F.array_sort(F.collect_set("split")).alias("splits")).filter("size(splits) > 1")
    pairs = F.expr("flatten(transform(splits, (a, i) -> transform(slice(splits, i + 2, size(splits)), b -> struct(a as split_a, b as split_b))))")
    return g.select(F.explode(pairs).alias("p")).groupBy("p.split_a", "p.split_b").agg(F.count("*").alias("n_common"))
