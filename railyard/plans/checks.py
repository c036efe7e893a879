"""Validation suites, referential checks and fingerprints."""

from __future__ import annotations

from pyspark.sql import functions as F

from railyard.core import clean_label, table
from railyard.operators import checks as op
from railyard.plans.registry import query
from railyard.plans.views import label_sql

CHECKS_SQL = {
    "score_in_range": ("fail", "score not between 0 and 1", 0.0),
    "calls_counted": ("warn", "coalesce(n_tool_calls, 0) <> coalesce(len(list_distinct(tool_calls)), 0)", 0.01),
    "template_clean": ("warn", f"template is distinct from {label_sql('template')}", 0.001),
    "delivered_in_a_day": ("info", "ingested_at - finished_at > interval 1 day", 0.1),
    "has_calls": ("warn", "coalesce(len(tool_calls), 0) = 0", 0.01),
    "known_finish": ("fail", "split_part(finish_reason, ':', 1) not in ('stop', 'length', 'max_turns', 'error')", 0.0),
}


@query("checks_suite", " union all ".join(
    f"select '{k}' as name, '{level}' as level, count(*) filter (coalesce({bad}, true)) <= count(*) * {most}::double as passed, count(*) filter (coalesce({bad}, true)) as n_bad, count(*) as n_rows from db_traces_chat"
    for k, (level, bad, most) in CHECKS_SQL.items()
))
def checks_suite(spark, sf):
    bad = {
        "score_in_range": ~F.col("score").between(0, 1),
        "calls_counted": F.coalesce("n_tool_calls", F.lit(0)) != F.greatest(F.coalesce(F.size(F.array_distinct("tool_calls")), F.lit(0)), F.lit(0)),
        "template_clean": ~F.col("template").eqNullSafe(clean_label("template")),
        "delivered_in_a_day": F.col("ingested_at") - F.col("finished_at") > F.expr("interval 1 day"),
        "has_calls": F.coalesce(F.size("tool_calls"), F.lit(0)) <= 0,
        "known_finish": ~F.split_part("finish_reason", F.lit(":"), F.lit(1)).isin("stop", "length", "max_turns", "error"),
    }
    return op.suite(table(spark, sf, "db_traces_chat"), {k: (CHECKS_SQL[k][0], c, CHECKS_SQL[k][2]) for k, c in bad.items()})


@query("uniqueness_checks", """select 'task_no' as name, 'fail' as level, count(*) filter (k > 1) = 0 as passed, sum(k - 1)::bigint as n_bad, sum(k)::bigint as n_rows from (select task_no, count(*) as k from db_tasks group by 1)
union all select 'split_rows', 'fail', count(*) filter (k > 1) = 0, sum(k - 1)::bigint, sum(k)::bigint from (select split, task_id, count(*) as k from task_splits group by all)
union all select 'record_id', 'fail', count(*) filter (k > 1) = 0, sum(k - 1)::bigint, sum(k)::bigint from (select record_id, count(*) as k from sft_mix_chat group by all)""")
def uniqueness_checks(spark, sf):
    one = op.uniqueness(table(spark, sf, "db_tasks"), ["task_no"], "task_no")
    return one.union(op.uniqueness(table(spark, sf, "task_splits"), ["split", "task_id"], "split_rows")).union(op.uniqueness(table(spark, sf, "sft_mix_chat"), ["record_id"], "record_id"))


@query("referential_resolution", """with p as (select distinct task_id as p from db_tasks), c as (select task_id as c, count(*) as n from db_traces_chat group by 1),
r as (select case when p is not null then 'direct' when regexp_replace(c, '[^0-9]', '', 'g') in (select regexp_replace(p, '[^0-9]', '', 'g') from p) then 'by_normal_form' else 'unresolved' end as how, n from c left join p on c = p)
select how, count(*) as n_keys, sum(n)::bigint as n_rows from r group by how""")
def referential_resolution(spark, sf):
    digits = lambda c: F.regexp_replace(c, "[^0-9]", "")
    return op.references(table(spark, sf, "db_traces_chat"), "task_id", table(spark, sf, "db_tasks"), "task_id", digits)


@query("orphan_tasks", "select distinct task_id from db_tasks where task_id not in (select task_id from task_splits)")
def orphan_tasks(spark, sf):
    return op.orphans(table(spark, sf, "db_tasks").select("task_id").distinct(), "task_id", table(spark, sf, "task_splits"), "task_id")


@query("size_drift", """select source, n, avg_n from (select coalesce(source, '?') as source, count(*) as n, (sum(count(*)) over () / count(*) over ())::double as avg_n from documents group by 1) where abs(n - avg_n) > avg_n * 0.1""")
def size_drift(spark, sf):
    g = table(spark, sf, "documents").groupBy(F.coalesce("source", F.lit("?")).alias("source")).agg(F.count("*").alias("n"))
    mean = g.agg(F.avg("n").alias("avg_n"))
    return op.drifted(g.crossJoin(F.broadcast(mean)), "n", "avg_n")  # one row on the right


FINGERPRINT = """h as (select sha256('n_name=' || n_name || chr(31) || 'n_nationkey=' || n_nationkey::varchar || chr(31) || 'n_regionkey=' || n_regionkey::varchar) as h from nation),
k as (select h, count(*) as k from h group by h), b as (select substr(h, 1, 2) as b, sha256(string_agg(h || ':' || k::varchar, ',' order by h || ':' || k::varchar)) as d, sum(k) as n from k group by 1)
select substr(sha256(string_agg(b || ':' || d, ',' order by b || ':' || d)), 1, 16) as digest, sum(n)::bigint as n_rows from b"""


@query("state_fingerprint", "with " + FINGERPRINT)
def state_fingerprint(spark, sf):
    return op.fingerprint(table(spark, sf, "nation"))


@query("entity_counts", " union all ".join(f"select '{t}' as name, count(*) as n from {t}" for t in ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "db_tasks")))
def entity_counts(spark, sf):
    out = None
    for t in ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "db_tasks"):
        one = table(spark, sf, t).agg(F.lit(t).alias("name"), F.count("*").alias("n"))
        out = one if out is None else out.union(one)
    return out


@query("late_arrivals", """select doc_kind, count(*) as n, count(*) filter (ingested_at - created_at > interval 1 day) as late, max(date_diff('second', created_at, ingested_at))::bigint as most_s from documents group by doc_kind""")
def late_arrivals(spark, sf):
    d = table(spark, sf, "documents")
    lag = F.unix_seconds(F.col("ingested_at").cast("timestamp")) - F.unix_seconds(F.col("created_at").cast("timestamp"))
    return d.groupBy("doc_kind").agg(F.count("*").alias("n"), F.count_if(F.col("ingested_at") - F.col("created_at") > F.expr("interval 1 day")).alias("late"), F.max(lag).alias("most_s"))


@query("length_check", """select coalesce(source, '?') as source, count(*) as n, count(*) filter (n_chars is null) as no_count, count(*) filter (n_chars <> length(coalesce(text, ''))) as wrong,
  count(*) filter (text is null or trim(text, ' ' || chr(9) || chr(10) || chr(13)) = '') as blank from documents group by 1""")
def length_check(spark, sf):
    text = F.coalesce("text", F.lit(""))
    return table(spark, sf, "documents").groupBy(F.coalesce("source", F.lit("?")).alias("source")).agg(
        F.count("*").alias("n"), F.count_if(F.col("n_chars").isNull()).alias("no_count"), F.count_if(F.col("n_chars") != F.length(text)).alias("wrong"), F.count_if(~text.rlike(r"[^ \t\n\r]")).alias("blank")
    )
