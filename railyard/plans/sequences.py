"""Call sequences, dialogs, prefixes, streaks and progress."""

from __future__ import annotations

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from railyard.core import table
from railyard.operators import sequences as op
from railyard.plans.registry import query
from railyard.plans.views import CALLS, FIRST_TRACES, MESSAGES, calls, first_traces


def with_calls(spark, sf):
    return table(spark, sf, "db_traces_chat").select("trace_id", "task_id", "sample_idx", op.ordered(F.col("tool_calls")).alias("calls"))


@query("flail_calls", f"""with {CALLS},
p as (select trace_id, tool_name = lag(tool_name) over w and arguments = lag(arguments) over w as same, lag(took_ms) over w as before
      from calls window w as (partition by trace_id order by seq, call_id))
select trace_id, count(*) as repeats, count(*) filter (coalesce(before, 0) < 1000) as repeats_not_slow from p where same group by trace_id""")
def flail_calls(spark, sf):
    t = with_calls(spark, sf).select("trace_id", op.repeats(F.col("calls")).cast("long").alias("repeats"), op.repeats(F.col("calls"), 1000).cast("long").alias("repeats_not_slow"))
    return t.filter("repeats > 0")


@query("transient_gate", f"""with {CALLS}, r as (select trace_id, tool_name, seq, row_number() over (partition by trace_id, tool_name order by seq, call_id) as k from calls)
select trace_id, tool_name, seq, k <= 1 as fails from r where tool_name in ('fahrplan', 'verspaetung')""")
def transient_gate(spark, sf):
    k = F.row_number().over(W.partitionBy("trace_id", "tool_name").orderBy("seq", "call_id"))
    return calls(spark, sf).filter(F.col("tool_name").isin("fahrplan", "verspaetung")).withColumn("fails", k <= 1).select("trace_id", "tool_name", "seq", "fails")


def against_gold(spark, sf):
    """Traces beside the first attempt at their task, whose calls serve as the gold path."""
    t = with_calls(spark, sf)
    keys = F.transform("calls", lambda c: F.concat_ws("|", c["tool_name"], c["arguments"]))
    t = t.withColumn("keys", keys)
    gold = t.filter("sample_idx = 0").groupBy("task_id").agg(F.min_by("keys", "trace_id").alias("gold"))
    return t.filter("sample_idx > 0").join(gold, "task_id")


GOLD = f"""{CALLS}, k as (select t.trace_id, t.task_id, t.sample_idx, coalesce(list(c.tool_name || '|' || c.arguments order by c.seq, c.call_id) filter (c.trace_id is not null), []) as keys
  from db_traces_chat t left join calls c using (trace_id) group by all),
g as (select task_id, arg_min(keys, trace_id) as gold from k where sample_idx = 0 group by task_id),
m as (select k.trace_id, k.keys, g.gold from k join g using (task_id) where k.sample_idx > 0),
i as (select trace_id, keys, gold, unnest(range(1, least(len(keys), len(gold)) + 1)) as i from m),
d as (select trace_id, min(i) filter (keys[i] is distinct from gold[i]) as first_other from i group by trace_id),
x as (select m.*, coalesce(d.first_other - 1, least(len(keys), len(gold))) as prefix from m left join d using (trace_id))"""


@query("gold_prefix", f"with {GOLD} select trace_id, prefix::int as matched, len(gold)::int as gold_calls, prefix = len(gold) as complete from x")
def gold_prefix(spark, sf):
    t = against_gold(spark, sf).withColumn("matched", op.common_prefix(F.col("keys"), F.col("gold")))
    return t.select("trace_id", "matched", F.size("gold").alias("gold_calls"), (F.col("matched") == F.size("gold")).alias("complete"))


@query("first_divergence", f"""with {GOLD}
select trace_id, (prefix + 1)::int as at_call, split_part(gold[prefix + 1], '|', 1) as wanted, split_part(keys[prefix + 1], '|', 1) as got,
  split_part(gold[prefix + 1], '|', 1) not in ('wartung_einplanen', 'crew_zuweisen', 'wartung_status_setzen') as may_branch
from x where prefix < len(gold) and prefix < len(keys)""")
def first_divergence(spark, sf):
    t = against_gold(spark, sf).withColumn("p", op.common_prefix(F.col("keys"), F.col("gold"))).filter("p < size(gold) and p < size(keys)")
    tool = lambda c: F.split_part(F.element_at(c, F.col("p") + 1), F.lit("|"), F.lit(1))
    return t.select("trace_id", (F.col("p") + 1).alias("at_call"), tool(F.col("gold")).alias("wanted"), tool(F.col("keys")).alias("got")).withColumn(
        "may_branch", ~F.col("wanted").isin("wartung_einplanen", "crew_zuweisen", "wartung_status_setzen")
    )


@query("prefix_salvage", f"""with {CALLS}, b as (select trace_id, count(*) as n, min(seq) filter (not json_valid(arguments)) as bad from calls group by trace_id)
select trace_id, n as calls, (bad - 1)::int as kept from b where bad > 1""")
def prefix_salvage(spark, sf):
    t = with_calls(spark, sf)
    bad = F.array_min(F.transform("calls", lambda c: F.when(F.try_parse_json(c["arguments"]).isNull(), c["seq"])))
    return t.select("trace_id", F.size("calls").cast("long").alias("calls"), (bad - 1).alias("kept")).filter("kept > 0")


@query("failure_streak", f"""with {FIRST_TRACES},
f as (select task_id, sample_idx, score < 1.0 as failed, row_number() over (partition by task_id order by sample_idx) - row_number() over (partition by task_id, score < 1.0 order by sample_idx) as island from first_traces),
s as (select task_id, island, count(*) as n from f where failed group by all)
select task_id, max(n)::int as longest, max(n) >= 2 as tripped from s group by task_id""")
def failure_streak(spark, sf):
    t = first_traces(spark, sf, "score").groupBy("task_id").agg(F.array_sort(F.collect_list(F.struct("sample_idx", (F.col("score") < 1.0).alias("failed")))).alias("a"))
    return t.select("task_id", op.longest_streak(F.transform("a", lambda x: x["failed"])).alias("longest")).filter("longest > 0").withColumn("tripped", F.col("longest") >= 2)


HOURS = """h as (select date_trunc('hour', ts) as hour, count(*) as n from events group by 1), c as (select hour, n, sum(n) over (order by hour) as total from h)"""


@query("rolling_rate_eta", f"""with {HOURS},
r as (select *, first_value(total) over w as base, (epoch(hour) - epoch(first_value(hour) over w)) / 3600.0::double as hours from c window w as (order by hour rows between 6 preceding and current row)),
q as (select *, case when hours > 0 then (total - base) / hours end as rate from r)
select strftime(hour, '%Y-%m-%d %H') as hour, n, total::bigint as total, rate, case when rate > 0 then greatest(20000 - total, 0) / rate end as eta_hours from q""")
def rolling_rate_eta(spark, sf):
    t = op.rolling_rate(op.hourly(table(spark, sf, "events"), "ts"), 6, 20000)
    return t.withColumn("hour", F.date_format("hour", "yyyy-MM-dd HH")).select("hour", "n", "total", "rate", "eta_hours")


@query("stall_ticks", f"""with {HOURS},
i as (select *, row_number() over (order by hour) - row_number() over (partition by n < 11 order by hour) as island from c)
select strftime(min(hour), '%Y-%m-%d %H') as since, count(*) as ticks from i where n < 11 group by island having count(*) >= 2""")
def stall_ticks(spark, sf):
    t = op.stalls(op.hourly(table(spark, sf, "events"), "ts"), "n", 11, 2)
    return t.withColumn("since", F.date_format("since", "yyyy-MM-dd HH")).select("since", "ticks")


def chats(spark, sf):
    return table(spark, sf, "areal_chat")


@query("episode_last_row", """with r as (select *, row_number() over (partition by dialog_id order by n_turns desc, chat_id) as k, bool_and(correct = 1) over (partition by dialog_id) as all_correct from areal_chat)
select dialog_id, chat_id, n_turns from r where k = 1 and all_correct""")
def episode_last_row(spark, sf):
    g = chats(spark, sf).groupBy("dialog_id").agg(F.max_by(F.struct("chat_id", "n_turns"), F.struct("n_turns", -F.col("chat_id"))).alias("r"), F.bool_and(F.col("correct") == 1).alias("ok"))
    return g.filter("ok").select("dialog_id", "r.chat_id", "r.n_turns")


@query("episode_reassemble", f"with {MESSAGES} select chat_id, string_agg(role || ': ' || content, chr(10) order by pos) as text, count(*)::int as n from messages group by chat_id")
def episode_reassemble(spark, sf):
    t = F.array_join(F.transform("messages", lambda m: F.concat(m["role"], F.lit(": "), F.coalesce(m["content"], F.lit("")))), "\n")
    return chats(spark, sf).filter("size(messages) > 0").select("chat_id", t.alias("text"), F.size("messages").alias("n"))


@query("trained_chars", f"""with {MESSAGES}, l as (select *, max(case when role = 'user' then pos else -1 end) over (partition by chat_id) as cut from messages)
select chat_id, coalesce(sum(length(content)) filter (role = 'assistant' and pos > cut), 0)::bigint as trained from l group by chat_id""")
def trained_chars(spark, sf):
    return chats(spark, sf).filter("size(messages) > 0").select("chat_id", op.trained_chars(F.col("messages")).alias("trained"))


@query("final_answer", f"""with {MESSAGES} select chat_id, arg_max(content, pos) as answer from messages where role = 'assistant' and length(trim(content)) > 0 group by chat_id""")
def final_answer(spark, sf):
    return chats(spark, sf).select("chat_id", op.final_answer(F.col("messages")).alias("answer")).filter("answer is not null")


@query("prefix_trim", f"""with {MESSAGES}, c as (select *, sum(length(content)) over (partition by chat_id order by pos) as upto from messages)
select chat_id, coalesce(max(pos + 1) filter (role = 'assistant' and upto <= 900), 0)::bigint as kept from c group by chat_id""")
def prefix_trim(spark, sf):
    return chats(spark, sf).filter("size(messages) > 0").select("chat_id", op.fitting_prefix(F.col("messages"), 900).alias("kept"))


@query("role_profile", f"""with {MESSAGES}
select role, count(*) as n, sum(length(content))::bigint as chars, max(length(content))::int as longest, count(*) filter (content = '') as empty from messages group by role""")
def role_profile(spark, sf):
    m = chats(spark, sf).select(F.explode("messages").alias("m")).select("m.role", F.coalesce("m.content", F.lit("")).alias("c"))
    return m.groupBy("role").agg(F.count("*").alias("n"), F.sum(F.length("c").cast("long")).alias("chars"), F.max(F.length("c")).alias("longest"), F.count_if(F.col("c") == "").alias("empty"))


@query("selection_class", f"""with {CALLS}, c as (select trace_id, count(*) as n, count(distinct tool_name) as tools, max(k) as widest
  from (select *, count(*) over (partition by trace_id, date_trunc('second', called_at)) as k from calls) group by trace_id)
select t.trace_id, case when coalesce(widest, 0) >= 4 then 'parallel4plus' when widest = 3 then 'parallel3' when widest = 2 then 'parallel2'
  when n is null then 'irrelevance' when n > 1 then 'multi' else 'single' end as sel_class
from db_traces_chat t left join c using (trace_id)""")
def selection_class(spark, sf):
    t = with_calls(spark, sf)
    seconds = F.transform("calls", lambda c: F.date_trunc("second", c["called_at"]).cast("string"))
    width = F.array_max(F.transform(F.array_distinct(F.col("s")), lambda x: F.size(F.filter("s", lambda y: y.eqNullSafe(x)))))
    t = t.withColumn("s", seconds).withColumn("w", F.coalesce(width, F.lit(0)))
    cls = F.when(F.col("w") >= 4, "parallel4plus").when(F.col("w") == 3, "parallel3").when(F.col("w") == 2, "parallel2").when(F.size("calls") == 0, "irrelevance").when(F.size("calls") > 1, "multi")
    return t.select("trace_id", cls.otherwise("single").alias("sel_class"))
