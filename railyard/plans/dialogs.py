"""Normal forms, bindings, gates, overlays and the remaining lookups."""

from __future__ import annotations

from pyspark.sql import functions as F

from railyard.core import clean_label, table
from railyard.operators import dialogs as op, sampling, sequences, world
from railyard.plans.registry import query
from railyard.plans.views import CALLS, MESSAGES, TRACES, traces
from railyard.plans.world import STOPS, stops


@query("message_normal_form", f"""with {MESSAGES} select chat_id, string_agg(lower(trim(role)) || '=' || length(trim(content))::varchar, ' ' order by pos) as form,
  count(*) filter (lower(trim(role)) not in ('system', 'user', 'assistant', 'tool'))::int as unknown_roles, count(*) filter (trim(content) = '')::int as empty from messages group by chat_id""")
def message_normal_form(spark, sf):
    c = table(spark, sf, "areal_chat").filter("size(messages) > 0").select("chat_id", op.normal_messages(F.col("messages")).alias("m"))
    form = F.array_join(F.transform("m", lambda x: F.concat_ws("=", x["role"], F.length(x["content"]).cast("string"))), " ")
    return c.select("chat_id", form.alias("form"), F.size(F.filter("m", lambda x: ~x["known"])).alias("unknown_roles"), F.size(F.filter("m", lambda x: x["content"] == "")).alias("empty"))


@query("running_call_ids", f"""with {CALLS} select trace_id, 'call_' || row_number() over (partition by trace_id order by seq, call_id)::varchar as id, tool_name as name from calls""")
def running_call_ids(spark, sf):
    t = table(spark, sf, "db_traces_chat").select("trace_id", F.explode(op.running_ids(sequences.ordered(F.col("tool_calls")))).alias("c"))
    return t.select("trace_id", "c.id", "c.name")


@query("result_binding", f"""with {MESSAGES},
e as (select chat_id, pos, case when role = 'tool' then -1 when role = 'assistant' and trim(content) = '' then 1 else 0 end as step from messages),
s as (select *, sum(step) over w as open, count(*) filter (step = 1) over w as calls, count(*) filter (step = -1) over w as results from e window w as (partition by chat_id order by pos)),
o as (select *, greatest(0, -min(open) over (partition by chat_id order by pos))::bigint as lost from s),
q as (select *, lost - coalesce(lag(lost) over (partition by chat_id order by pos), 0) as is_lost from o),
b as (select q.chat_id, c.pos as call, q.pos as result from q join q c on c.chat_id = q.chat_id and c.step = 1 and c.calls = q.results - q.lost where q.step = -1 and q.is_lost = 0),
n as (select chat_id, max(lost)::int as orphans, max(calls) as calls from q group by chat_id),
t as (select chat_id, string_agg(call::varchar || '>' || result::varchar, ' ' order by result) as bound, count(*) as n from b group by chat_id)
select chat_id, coalesce(bound, '') as bound, orphans, (calls - coalesce(n, 0))::int as waiting from n left join t using (chat_id)""")
def result_binding(spark, sf):
    """Every chat with messages, those with results that no call waits for too."""
    c = table(spark, sf, "areal_chat").filter("size(messages) > 0").select("chat_id", op.bind_results(F.col("messages")).alias("b"))
    text = F.array_join(F.transform("b.bound", lambda p: F.concat_ws(">", p["call"], p["result"])), " ")
    return c.select("chat_id", text.alias("bound"), F.col("b.orphans").alias("orphans"), F.col("b.waiting").alias("waiting"))


@query("domain_fallback", """select chat_id, coalesce(domain_name, nullif(split_part(dialog_id, '-', 1), ''), case when contains(messages::varchar, 'flight') then 'airline' end) as domain_name, domain_name is null as derived from areal_chat""")
def domain_fallback(spark, sf):
    prefix = F.split_part("dialog_id", F.lit("-"), F.lit(1))
    text = F.contains(sequences.role_text(F.col("messages")), F.lit("flight"))
    domain = F.coalesce("domain_name", F.when(prefix != "", prefix), F.when(text, "airline"))
    return table(spark, sf, "areal_chat").select("chat_id", domain.alias("domain_name"), F.col("domain_name").isNull().alias("derived"))


@query("schema_gate", f"""with {TRACES}, {CALLS},
d as (select distinct t.template, c.tool_name from traces t join calls c using (trace_id) where t.teacher = 'oracle'),
u as (select distinct t.trace_id, t.template, c.tool_name from traces t join calls c using (trace_id) where t.teacher <> 'oracle'),
bad as (select distinct trace_id from u where (template, tool_name) not in (select template, tool_name from d))
select trace_id from traces where teacher <> 'oracle' and trace_id not in (select trace_id from bad) and template in (select template from d)""")
def schema_gate(spark, sf):
    t = traces(spark, sf).select("trace_id", "template", "teacher", F.array_distinct(F.transform(sequences.ordered(F.col("tool_calls")), lambda c: c["tool_name"])).alias("tools"))
    declared = t.filter("teacher = 'oracle'").select("template", F.explode("tools").alias("tool")).distinct().groupBy("template").agg(F.collect_list("tool").alias("declared"))  # tool names: few
    return op.known_tools_only(t.filter("teacher <> 'oracle'").join(declared, "template"), "tools", "declared").select("trace_id")


@query("length_filter", f"""with {MESSAGES}, s as (select chat_id, sum(length(content))::bigint as chars, count(*) filter (role = 'assistant' and content <> '') as answers from messages group by chat_id)
select chat_id, chars from s where chars < 1500 and answers > 0""")
def length_filter(spark, sf):
    c = table(spark, sf, "areal_chat").filter("size(messages) > 0")
    chars = F.aggregate("messages", F.lit(0).cast("long"), lambda n, m: n + F.coalesce(F.length(m["content"]), F.lit(0)))
    answers = F.exists("messages", lambda m: (m["role"] == "assistant") & (F.coalesce(m["content"], F.lit("")) != ""))
    return c.filter(answers).select("chat_id", chars.alias("chars")).filter("chars < 1500")


@query("calendar_weekdays", """with d as (select user_id, ts::date as day from events),
c as (select user_id, min(day) as since, max(day) as until, list_sort(list(distinct isodow(day))) as days from d group by user_id)
select user_id from c where date '2024-01-10' between since and until and list_contains(days, isodow(date '2024-01-10'))""")
def calendar_weekdays(spark, sf):
    d = table(spark, sf, "events").select("user_id", F.to_date("ts").alias("day"))
    c = d.groupBy("user_id").agg(F.min("day").alias("since"), F.max("day").alias("until"), F.collect_set(F.weekday("day")).alias("days"))
    asked = F.lit("2024-01-10").cast("date")
    return c.filter(asked.between(F.col("since"), F.col("until")) & F.array_contains("days", F.weekday(asked))).select("user_id")


@query("parent_stations", "select s_suppkey, coalesce(n_nationkey, s_suppkey)::bigint as station from supplier left join (select * from nation where n_regionkey < 3) on s_nationkey = n_nationkey")
def parent_stations(spark, sf):
    n = table(spark, sf, "nation").filter("n_regionkey < 3").select(F.col("n_nationkey").cast("long").alias("n_nationkey"))
    s = table(spark, sf, "supplier").select("s_suppkey", F.col("s_nationkey").cast("long").alias("s_nationkey"))
    return op.parents(s, "s_suppkey", "s_nationkey", n, "n_nationkey").select("s_suppkey", "station")


@query("dependency_closure", """with i as (select o_orderkey, o_custkey as place, [o_orderkey - 1, o_orderkey // 2] as needs from orders where o_orderstatus = 'P'),
e as (select unnest(list_append(needs, o_orderkey)) as o_orderkey, place from i)
select o_orderkey, min(place) as place from e group by o_orderkey""")
def dependency_closure(spark, sf):
    """Over all orders of status P."""
    key = F.col("o_orderkey")
    i = table(spark, sf, "orders").filter("o_orderstatus = 'P'").select("o_orderkey", F.col("o_custkey").alias("place"), F.array(key - 1, F.expr("o_orderkey div 2")).alias("needs"))
    return op.closure(i, "o_orderkey", "needs")


@query("balanced_pairs", """with m as (select distinct l_partkey, l_orderkey from lineitem), r as (select *, row_number() over (partition by l_partkey order by l_orderkey) as k from m),
p as (select l_partkey, max(l_orderkey) filter (k = 1) as a, max(l_orderkey) filter (k = 2) as b from r where k <= 2 group by l_partkey having count(*) = 2),
f as (select p.*, x.o_orderstatus = y.o_orderstatus as same from p join orders x on x.o_orderkey = a join orders y on y.o_orderkey = b),
d as (select *, row_number() over (order by sha256('bal|' || l_partkey::varchar)) as k from f where not same)
select l_partkey, true as same from f where same union all select l_partkey, false from d where k <= (select count(*) from f where same)""")
def balanced_pairs(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus")
    p = world.representatives(table(spark, sf, "lineitem"), "l_partkey", "l_orderkey").filter("second is not null")
    p = p.join(o.select(F.col("o_orderkey").alias("first"), F.col("o_orderstatus").alias("x")), "first").join(o.select(F.col("o_orderkey").alias("second"), F.col("o_orderstatus").alias("y")), "second")
    p = p.select("l_partkey", (F.col("x") == F.col("y")).alias("same"))
    n = p.filter("same").agg(F.count("*").alias("n"))
    ranked = sampling.hashed_rank(p.filter("not same").withColumn("all", F.lit(1)), ["all"], sampling.draw("bal", "l_partkey"), "k")
    return p.filter("same").union(ranked.crossJoin(F.broadcast(n)).filter("k <= n").select("l_partkey", "same"))  # one row on the right


@query("char_stats", f"""with {MESSAGES} select role, min(length(content))::int as least, max(length(content))::int as most, avg(length(content)) as mean from messages where content <> '' group by role""")
def char_stats(spark, sf):
    m = table(spark, sf, "areal_chat").select(F.explode("messages").alias("m")).select("m.role", F.length("m.content").alias("n")).filter("n > 0")
    return m.groupBy("role").agg(F.min("n").alias("least"), F.max("n").alias("most"), F.avg("n").alias("mean"))


@query("extended_times", """with t as (select event_id, strftime(ts, '%H:%M:%S') as clock, epoch(date_trunc('second', ts) - date_trunc('day', ts))::bigint + (event_id % 50) * 1800 as t from events)
select event_id, clock, format('{:02d}:{:02d}:{:02d}', t // 3600, t % 3600 // 60, t % 60) as later from t""")
def extended_times(spark, sf):
    e = table(spark, sf, "events").select("event_id", F.date_format("ts", "HH:mm:ss").alias("clock"))
    return e.select("event_id", "clock", op.add_seconds(F.col("clock"), (F.col("event_id") % 50) * 1800).alias("later"))


@query("replace_once", f"""with {MESSAGES}, o as (select chat_id, content, len(string_split(content, 'Never guess.')) - 1 as k from messages where role = 'system')
select chat_id, k::int as found, case when k = 1 then replace(content, 'Never guess.', 'Ask.') end as content from o""")
def replace_once(spark, sf):
    m = table(spark, sf, "areal_chat").select("chat_id", F.explode("messages").alias("m")).filter("m.role = 'system'").select("chat_id", F.coalesce("m.content", F.lit("")).alias("c"))
    return m.select("chat_id", op.occurrences(F.col("c"), "Never guess.").alias("found"), op.replace_once(F.col("c"), "Never guess.", "Ask.").alias("content"))


@query("error_kinds", """select teacher, count(*) filter (contains(finish_reason, 'timeout')) as infra, count(*) filter (finish_reason = 'length') as context,
  count(*) filter (finish_reason not in ('stop', 'length') and not contains(finish_reason, 'timeout')) as other from db_traces_chat group by teacher""")
def error_kinds(spark, sf):
    r = F.col("finish_reason")
    infra = F.contains(r, F.lit("timeout"))
    return table(spark, sf, "db_traces_chat").groupBy("teacher").agg(F.count_if(infra).alias("infra"), F.count_if(r == "length").alias("context"), F.count_if(~r.isin("stop", "length") & ~infra).alias("other"))


@query("employee_search", """with s as (select o_custkey, min(o_orderdate) as first_shift from orders group by o_custkey),
h as (select c_custkey, c_name, n_name, strftime(first_shift, '%Y-%m-%d') as first_shift from customer left join nation on c_nationkey = n_nationkey left join s on o_custkey = c_custkey
  where list_contains([lower(c_mktsegment), lower(n_name)], lower('NATION_7')) and c_acctbal between 0 and 5000 and strftime(first_shift, '%Y-%m-%d') < '1999-01-01')
select *, count(*) over () as total, row_number() over (order by c_custkey)::int as place, count(*) over () > 10 as more from h order by c_custkey limit 10""")
def employee_search(spark, sf):
    shift = table(spark, sf, "orders").groupBy("o_custkey").agg(F.date_format(F.min("o_orderdate"), "yyyy-MM-dd").alias("first_shift"))
    n = F.broadcast(table(spark, sf, "nation").select("n_nationkey", "n_name"))  # 25 rows, fixed
    c = table(spark, sf, "customer").join(n, F.col("c_nationkey") == F.col("n_nationkey"), "left").join(shift, F.col("o_custkey") == F.col("c_custkey"), "left")
    skill = F.exists(F.array(F.lower("c_mktsegment"), F.lower("n_name")), lambda q: q == F.lower(F.lit("NATION_7")))
    c = c.filter(skill & F.col("c_acctbal").between(0, 5000)).select("c_custkey", "c_name", "n_name", "first_shift")
    return world.search_page(c, F.col("first_shift") < "1999-01-01", ["c_custkey"])


@query("vehicle_orders", """select p_partkey, p_brand, coalesce(string_agg(l_orderkey::varchar, ',' order by l_orderkey, l_linenumber), '') as orders from part left join
  (select distinct l_partkey, l_orderkey, l_linenumber from lineitem where l_returnflag = 'R') on p_partkey = l_partkey where p_size < 10 group by all""")
def vehicle_orders(spark, sf):
    li = table(spark, sf, "lineitem").filter("l_returnflag = 'R'").select("l_partkey", "l_orderkey", "l_linenumber").distinct()
    g = li.groupBy("l_partkey").agg(F.array_sort(F.collect_list(F.struct("l_orderkey", "l_linenumber"))).alias("o"))  # the orders of one vehicle: few
    p = table(spark, sf, "part").filter("p_size < 10").join(g, F.col("p_partkey") == F.col("l_partkey"), "left")
    return p.select("p_partkey", "p_brand", F.coalesce(F.array_join(F.transform("o", lambda x: x["l_orderkey"].cast("string")), ","), F.lit("")).alias("orders"))


@query("crew_lookup", """select o_orderkey, o_custkey, coalesce(c_name, 'id ' || o_custkey::varchar) as name from orders left join (select * from customer where c_acctbal >= 0) on o_custkey = c_custkey where o_orderpriority = '5-LOW'""")
def crew_lookup(spark, sf):
    c = table(spark, sf, "customer").filter("c_acctbal >= 0").select("c_custkey", "c_name")
    o = table(spark, sf, "orders").filter("o_orderpriority = '5-LOW'").join(c, F.col("o_custkey") == F.col("c_custkey"), "left")
    return o.select("o_orderkey", "o_custkey", F.coalesce("c_name", F.concat(F.lit("id "), F.col("o_custkey").cast("string"))).alias("name"))


@query("delay_overlay", f"""with {STOPS}, o as (select coalesce(l_returnflag, '?') as episode, l_orderkey, l_linenumber, l_quantity + 900.0 as late from stops),
x as (select t.episode, s.l_orderkey, s.l_linenumber, coalesce(o.late, s.l_quantity) as q from stops s join (select distinct episode, l_orderkey from o) t using (l_orderkey) left join o on o.episode = t.episode and o.l_orderkey = s.l_orderkey and o.l_linenumber = s.l_linenumber)
select episode, l_orderkey, arg_max(l_linenumber, (q, -l_linenumber)) as at_seq, max(q)::double as delay from x group by all""")
def delay_overlay(spark, sf):
    """Over all trips: an episode for each return flag, in which the stops with that flag are late."""
    base = stops(spark, sf).select("l_orderkey", "l_linenumber", "l_quantity", F.coalesce("l_returnflag", F.lit("?")).alias("episode"))
    over = base.select("episode", "l_orderkey", "l_linenumber", (F.col("l_quantity") + 900.0).alias("l_quantity"))
    x = op.overlaid(base.drop("episode"), over, ["l_orderkey", "l_linenumber"], "episode", "l_quantity").withColumn("k", F.struct("episode", "l_orderkey"))
    return world.worst(x, "k", "l_linenumber", "l_quantity").select("k.episode", "k.l_orderkey", "at_seq", "delay")


@query("write_asserts", f"""with {CALLS},
w as (select distinct trace_id, json_extract_string(arguments, '$.auftrag_id') as auftrag, json_extract_string(arguments, '$.status') as status from calls where tool_name = 'wartung_status_setzen' and json_valid(arguments)),
k as (select task_id, arg_min(kind, exported_at) as kind from db_tasks group by task_id)
select k.kind, count(*) as n, count(*) filter (t.trace_id in (select trace_id from w where status = 'abgeschlossen')) as closed_one from db_traces_chat t join k using (task_id) group by k.kind""")
def write_asserts(spark, sf):
    k = table(spark, sf, "db_tasks").groupBy("task_id").agg(F.min_by("kind", "exported_at").alias("kind"))
    closed = F.exists(sequences.ordered(F.col("tool_calls")), lambda c: (c["tool_name"] == "wartung_status_setzen") & (F.get_json_object(c["arguments"], "$.status") == "abgeschlossen") & F.try_parse_json(c["arguments"]).isNotNull())
    t = table(spark, sf, "db_traces_chat").select("task_id", F.coalesce(closed, F.lit(False)).alias("closed"))
    return t.join(k, "task_id").groupBy("kind").agg(F.count("*").alias("n"), F.count_if("closed").alias("closed_one"))


@query("subset_tests", """with s as (select split, list_sort(list(distinct task_id)) as ids from task_splits group by split)
select a.split as inner_split, b.split as outer_split, len(list_intersect(a.ids, b.ids)) = len(a.ids) as is_subset, len(list_intersect(a.ids, b.ids)) = 0 as is_disjoint from s a join s b on a.split <> b.split""")
def subset_tests(spark, sf):
    s = table(spark, sf, "task_splits").select(clean_label("split").alias("split"), "task_id").distinct()
    sizes = s.groupBy("split").agg(F.count("*").alias("n"))
    common = s.alias("a").join(s.withColumnRenamed("split", "outer_split"), "task_id").groupBy("split", "outer_split").agg(F.count("*").alias("k"))
    pairs = sizes.withColumnRenamed("split", "inner_split").crossJoin(F.broadcast(sizes.select(F.col("split").alias("outer_split")))).filter("inner_split <> outer_split")  # six splits
    out = pairs.join(common.withColumnRenamed("split", "inner_split"), ["inner_split", "outer_split"], "left").na.fill(0, ["k"])
    return out.select("inner_split", "outer_split", (F.col("k") == F.col("n")).alias("is_subset"), (F.col("k") == 0).alias("is_disjoint"))
