"""Call matching, verdicts, replay and trajectory scores."""

from __future__ import annotations

from pyspark.sql import functions as F

from railyard.core import table
from railyard.operators import calls as match, score as op, sequences
from railyard.plans.registry import query
from railyard.plans.views import CALLS, calls


@query("write_replay_status", f"""with {CALLS},
w as (select trace_id, seq, json_extract_string(arguments, '$.auftrag_id') as auftrag, json_extract_string(arguments, '$.status') as status from calls
  where tool_name = 'wartung_status_setzen' and json_valid(arguments)),
v as (select * from w where auftrag is not null and status is not null),
e as (select trace_id, auftrag, min(seq) filter (status = 'abgeschlossen') as ended_at, arg_max(status, seq) as last_status, count(*) as n_writes from v group by all)
select trace_id, auftrag, case when ended_at is not null then 'abgeschlossen' else last_status end as state, ended_at, n_writes from e""")
def write_replay_status(spark, sf):
    return op.last_valid_status(status_writes(spark, sf), ["trace_id", "auftrag"], "status", "seq", "abgeschlossen")


def status_writes(spark, sf):
    w = calls(spark, sf).filter("tool_name = 'wartung_status_setzen'").filter(F.try_parse_json("arguments").isNotNull())
    w = w.select("trace_id", "seq", F.get_json_object("arguments", "$.auftrag_id").alias("auftrag"), F.get_json_object("arguments", "$.status").alias("status"))
    return w.filter("auftrag is not null and status is not null")


@query("write_rejected", f"""with {CALLS},
w as (select trace_id, seq, json_extract_string(arguments, '$.auftrag_id') as auftrag, json_extract_string(arguments, '$.status') as status from calls where tool_name = 'wartung_status_setzen' and json_valid(arguments)),
v as (select *, max(case when status = 'abgeschlossen' then 1 else 0 end) over (partition by trace_id, auftrag order by seq rows between unbounded preceding and 1 preceding) as ended from w where auftrag is not null and status is not null)
select trace_id, auftrag, seq, status from v where ended = 1""")
def write_rejected(spark, sf):
    w = status_writes(spark, sf)
    state = op.last_valid_status(w, ["trace_id", "auftrag"], "status", "seq", "abgeschlossen")
    return op.rejected_writes(w, state, ["trace_id", "auftrag"], "seq").select("trace_id", "auftrag", "seq", "status")


@query("write_replay_full")
def write_replay_full(spark, sf):
    t = table(spark, sf, "db_traces_chat").select("trace_id", sequences.ordered(F.col("tool_calls")).alias("calls"))
    return op.replay(t, "trace_id", "calls")


PAIRS = f"""{CALLS}, k as (select t.trace_id, t.task_id, t.sample_idx, t.finish_reason,
    coalesce(list(c.tool_name order by c.tool_name) filter (c.trace_id is not null), []) as tools,
    coalesce(list(c.tool_name || '|' || c.arguments order by c.tool_name || '|' || c.arguments) filter (c.trace_id is not null), []) as keys
  from db_traces_chat t left join calls c using (trace_id) group by all),
g as (select task_id, arg_min(tools, trace_id) as gold_tools, arg_min(keys, trace_id) as gold_keys from k where sample_idx = 0 group by task_id),
p as (select k.*, g.gold_tools, g.gold_keys from k join g using (task_id) where k.sample_idx > 0)"""


def gold_pairs(spark, sf):
    t = table(spark, sf, "db_traces_chat").select("trace_id", "task_id", "sample_idx", "finish_reason", sequences.ordered(F.col("tool_calls")).alias("calls"))
    gold = t.filter("sample_idx = 0").groupBy("task_id").agg(F.min_by("calls", "trace_id").alias("gold"))
    return t.filter("sample_idx > 0").join(gold, "task_id")


@query("call_verdicts", f"""with {PAIRS}
select trace_id, case when len(gold_tools) = 0 and len(tools) = 0 then 'irrelevance_ok' when len(gold_tools) = 0 then 'irrelevance_called'
  when len(tools) = 0 and trim(finish_reason) = '' then 'silent' when len(tools) = 0 then 'asked_back'
  when len(tools) < len(gold_tools) and len(list_filter(tools, lambda x: not list_contains(gold_tools, x))) = 0 then 'missing_call'
  when tools <> gold_tools then 'wrong_tool' when keys = gold_keys then 'exact' else 'wrong_args' end as verdict from p""")
def call_verdicts(spark, sf):
    p = gold_pairs(spark, sf)
    tools = lambda c: F.transform(c, lambda x: x["tool_name"])
    keys = lambda c: F.transform(c, lambda x: F.concat_ws("|", x["tool_name"], x["arguments"]))
    return p.select("trace_id", match.verdict(tools(F.col("gold")), tools(F.col("calls")), match.same_bag(keys(F.col("gold")), keys(F.col("calls"))), F.col("finish_reason")).alias("verdict"))


@query("call_bag_match")
def call_bag_match(spark, sf):
    p = gold_pairs(spark, sf)
    slim = lambda c: F.transform(c, lambda x: F.struct(x["tool_name"].alias("tool_name"), x["arguments"].alias("arguments")))
    return match.bag_verdicts(p.select(F.col("trace_id").alias("key"), slim(F.col("gold")).alias("gold"), slim(F.col("calls")).alias("got")))


@query("json_args_normalise", f"""with {CALLS}, o as (select trace_id, seq, call_id, arguments from calls where json_valid(arguments) and json_type(arguments) = 'OBJECT'),
k as (select trace_id, seq, call_id, unnest(json_keys(arguments)) as key, arguments from o)
select trace_id, seq, key, v as value from (select trace_id, seq, call_id, key,
  case when lower(trim(x)) in ('true', 'false') then lower(trim(x)) when regexp_full_match(trim(x), '[+-]?\\d+') then trim(x)::double::varchar else trim(x) end as v
  from (select *, json_extract_string(arguments, '$."' || key || '"') as x from k))""")
def json_args_normalise(spark, sf):
    c = calls(spark, sf).select("trace_id", "seq", match.arguments_map(F.col("arguments")).alias("m"))
    return c.select("trace_id", "seq", F.explode("m").alias("key", "value")).withColumn("value", match.normal_scalar(F.col("value")))


@query("trajectory_score", f"""with {CALLS},
c as (select trace_id, bool_or(tool_name in ('wartung_einplanen', 'crew_zuweisen', 'wartung_status_setzen')) as wrote, bool_and(json_valid(arguments)) as valid, count(*) as n from calls group by trace_id),
k as (select task_id, arg_min(kind, exported_at) as kind, arg_min(expected_calls, exported_at) as expected from db_tasks group by task_id),
s as (select t.trace_id, k.kind, coalesce(c.valid, true) as valid, case when k.kind = 'action' then coalesce(c.wrote, false) else not coalesce(c.wrote, false) end as writes,
  t.finish_reason = 'stop' as finished, coalesce(c.n, 0) < 3 * k.expected as in_time from db_traces_chat t join k using (task_id) left join c using (trace_id))
select trace_id, kind, valid, writes, finished, in_time, case when valid and writes and finished and in_time then 1.0 else 0.0 end::double as score from s""")
def trajectory_score(spark, sf):
    tasks = table(spark, sf, "db_tasks").groupBy("task_id").agg(F.min_by(F.struct("kind", F.col("expected_calls").alias("expected")), "exported_at").alias("k")).select("task_id", "k.kind", "k.expected")
    t = table(spark, sf, "db_traces_chat").select("trace_id", "task_id", "finish_reason", sequences.ordered(F.col("tool_calls")).alias("calls")).join(tasks, "task_id")
    wrote = F.exists("calls", lambda c: c["tool_name"].isin(*op.WRITES))
    parts = {
        "valid": F.forall("calls", lambda c: F.try_parse_json(c["arguments"]).isNotNull()), "writes": F.when(F.col("kind") == "action", wrote).otherwise(~wrote),
        "finished": F.col("finish_reason") == "stop", "in_time": F.size("calls") < 3 * F.col("expected"),
    }
    return t.select("trace_id", "kind", *(c.alias(n) for n, c in parts.items()), op.all_met(parts).alias("score"))


@query("write_gates", f"""with {CALLS},
w as (select trace_id, seq, call_id, json_extract_string(arguments, '$.zugnummer') as zug, json_extract_string(arguments, '$.mitarbeiter_id') as ma, json_extract_string(arguments, '$.rolle') as rolle from calls where tool_name = 'crew_zuweisen' and json_valid(arguments)),
d as (select *, row_number() over (partition by trace_id, zug, ma, rolle order by seq, call_id) as k from w)
select coalesce(case when zug is null or ma is null then 'missing' when k > 1 then 'duplicate' when rolle not in ('Lokführer', 'Zugbegleiter') then 'role' end, 'accepted') as outcome, count(*) as n from d group by 1""")
def write_gates(spark, sf):
    from pyspark.sql import Window as W

    from railyard.operators.predicates import first_reason

    w = calls(spark, sf).filter("tool_name = 'crew_zuweisen'").filter(F.try_parse_json("arguments").isNotNull())
    w = w.select("trace_id", "seq", "call_id", *(F.get_json_object("arguments", f"$.{k}").alias(a) for k, a in (("zugnummer", "zug"), ("mitarbeiter_id", "ma"), ("rolle", "rolle"))))
    k = F.row_number().over(W.partitionBy("trace_id", "zug", "ma", "rolle").orderBy("seq", "call_id"))
    reason = first_reason(("missing", F.col("zug").isNull() | F.col("ma").isNull()), ("duplicate", F.col("k") > 1), ("role", ~F.col("rolle").isin("Lokführer", "Zugbegleiter")))
    return w.withColumn("k", k).groupBy(F.coalesce(reason, F.lit("accepted")).alias("outcome")).agg(F.count("*").alias("n"))
