"""Gates, flags, labels, masks and maps over conversations and traces."""

from __future__ import annotations

from pyspark.sql import functions as F

from railyard.core import clean_label, table
from railyard.operators import calls as match, masks, sampling, sequences
from railyard.operators.predicates import first_reason
from railyard.plans.registry import query
from railyard.plans.scoring import PAIRS, gold_pairs
from railyard.plans.views import CALLS, MESSAGES, TRACES, calls, chat_messages, traces


@query("domain_skip", "select chat_id, domain_name from areal_chat where coalesce(lower(trim(domain_name)), '?') not in ('telecom', 'retail')")
def domain_skip(spark, sf):
    return table(spark, sf, "areal_chat").filter(~F.coalesce(F.lower(F.trim("domain_name")), F.lit("?")).isin("telecom", "retail")).select("chat_id", "domain_name")


@query("structural_gate", f"""with {MESSAGES},
g as (select chat_id, bool_and(role in ('system', 'user', 'assistant', 'tool')) as roles, count(*) filter (role = 'assistant') as answers, arg_max(trim(content), pos) filter (role = 'assistant') as final from messages group by chat_id)
select chat_id from g where roles and answers > 0 and final <> ''""")
def structural_gate(spark, sf):
    """Only known roles, at least one assistant message, and the last of them not empty."""
    answers = F.filter("messages", lambda m: m["role"] == "assistant")
    known = F.forall("messages", lambda m: m["role"].isin("system", "user", "assistant", "tool"))
    final = F.trim(F.coalesce(F.try_element_at(answers, F.lit(-1))["content"], F.lit("")))
    return table(spark, sf, "areal_chat").filter(known & (F.size(answers) > 0) & (final != "")).select("chat_id")


@query("split_guard", "select distinct trace_id from db_traces_chat where task_id in (select task_id from task_splits where split = 'sft_train')")
def split_guard(spark, sf):
    train = table(spark, sf, "task_splits").filter("split = 'sft_train'").select("task_id")
    return table(spark, sf, "db_traces_chat").join(train, "task_id", "left_semi").select("trace_id").distinct()


@query("wire_arguments", f"""with {CALLS} select trace_id, seq, call_id, json_object('name', tool_name, 'seq', seq, 'took_ms', took_ms)::varchar as wire from calls""")
def wire_arguments(spark, sf):
    wire = F.to_json(F.struct(F.col("tool_name").alias("name"), "seq", "took_ms"), {"ignoreNullFields": "false"})
    return calls(spark, sf).select("trace_id", "seq", "call_id", wire.alias("wire"))


@query("results_by_call", f"""with {CALLS}, r as (select trace_id, call_id, arg_min(took_ms, seq) as took from calls where took_ms is not null and call_id is not null group by all)
select c.trace_id, c.seq, c.call_id, coalesce(r.took::varchar, '') as result from calls c left join r on r.trace_id = c.trace_id and r.call_id = c.call_id""")
def results_by_call(spark, sf):
    """Each call with the result that names its id, '' without one; a trace's calls lie in its row, so nothing is joined."""
    t = table(spark, sf, "db_traces_chat").select("trace_id", sequences.ordered(F.col("tool_calls")).alias("c"))
    result = lambda call: F.get(F.filter("c", lambda r: (r["call_id"] == call["call_id"]) & r["took_ms"].isNotNull()), 0)["took_ms"]
    bound = F.transform("c", lambda c: F.struct(c["seq"].alias("seq"), c["call_id"].alias("call_id"), F.coalesce(result(c).cast("string"), F.lit("")).alias("result")))
    return t.select("trace_id", F.explode(bound).alias("x")).select("trace_id", "x.*")


@query("turn_verdicts", f"""with {PAIRS}, b as (select trace_id, bool_or(not json_valid(arguments)) as broken from calls group by trace_id)
select p.trace_id, case when t.truncated then 'truncated' when coalesce(b.broken, false) then 'call_error' when trim(p.finish_reason) = '' and len(p.tools) > 0 then 'no_think'
  when len(gold_tools) = 0 and len(tools) = 0 then 'irrelevance_ok' when len(gold_tools) = 0 then 'irrelevance_called'
  when len(tools) = 0 and trim(p.finish_reason) = '' then 'silent' when len(tools) = 0 then 'asked_back'
  when len(tools) < len(gold_tools) and len(list_filter(tools, lambda x: not list_contains(gold_tools, x))) = 0 then 'missing_call'
  when tools <> gold_tools then 'wrong_tool' when keys = gold_keys then 'exact' else 'wrong_args' end as verdict
from p join db_traces_chat t using (trace_id) left join b using (trace_id)""")
def turn_verdicts(spark, sf):
    """The verdicts, and before them the labels that are set where a turn could not be judged."""
    p = gold_pairs(spark, sf).join(table(spark, sf, "db_traces_chat").select("trace_id", "truncated"), "trace_id")
    tools = lambda c: F.transform(c, lambda x: x["tool_name"])
    keys = lambda c: F.transform(c, lambda x: F.concat_ws("|", x["tool_name"], x["arguments"]))
    judged = match.verdict(tools(F.col("gold")), tools(F.col("calls")), match.same_bag(keys(F.col("gold")), keys(F.col("calls"))), F.col("finish_reason"))
    broken = F.exists("calls", lambda c: c["arguments"].isNotNull() & F.try_parse_json(c["arguments"]).isNull())
    before = first_reason(("truncated", F.col("truncated")), ("call_error", broken), ("no_think", (F.trim("finish_reason") == "") & (F.size("calls") > 0)))
    return p.select("trace_id", F.coalesce(before, judged).alias("verdict"))


@query("recovery_flags", f"""with {TRACES} select trace_id, recovery_mode <> 'direct' and score = 1.0 as self_recovery, replan and coalesce(injected, false) as replanned, replan and not coalesce(injected, false) as needless from traces""")
def recovery_flags(spark, sf):
    injected = F.coalesce("injected", F.lit(False))
    return traces(spark, sf).select(
        "trace_id", ((F.col("recovery_mode") != "direct") & (F.col("score") == 1.0)).alias("self_recovery"), (F.col("replan") & injected).alias("replanned"), (F.col("replan") & ~injected).alias("needless")
    )


@query("leak_turns", f"""with {MESSAGES}, l as (select chat_id, min(pos) filter (contains(content, 'policy')) as leak_pos from messages group by chat_id)
select chat_id, any_value(leak_pos) is not null as leak, count(*) filter (role = 'assistant' and (leak_pos is null or pos <= leak_pos))::int as turns from messages join l using (chat_id) group by chat_id""")
def leak_turns(spark, sf):
    """Assistant turns up to the message with the first leak; all of them without one."""
    c = table(spark, sf, "areal_chat").filter("size(messages) > 0")
    at = F.array_min(F.transform("messages", lambda m, i: F.when(F.contains(m["content"], F.lit("policy")), i)))
    c = c.select("chat_id", "messages", at.alias("at"))
    turns = F.size(F.filter("messages", lambda m, i: (m["role"] == "assistant") & (i <= F.coalesce("at", i))))
    return c.select("chat_id", F.col("at").isNotNull().alias("leak"), turns.alias("turns"))


@query("problem_list", f"""with {TRACES}, g as (select template, count(*) as n, count(*) filter (score = 1.0) as ok, count(*) filter (truncated) as cut, count(*) filter (n_tool_calls is null or n_tool_calls = 0) as idle from traces group by template)
select template, concat_ws(',', case when n < 20 then 'few' end, case when ok = 0 then 'none solved' end, case when cut * 10 > n then 'truncated' end, case when idle * 4 > n then 'no calls' end, case when template = '?' then 'no template' end) as problems from g""")
def problem_list(spark, sf):
    """What is wrong with each template's results, as a list; an empty one passes."""
    g = traces(spark, sf).groupBy("template").agg(
        F.count("*").alias("n"), F.count_if(F.col("score") == 1.0).alias("ok"), F.count_if("truncated").alias("cut"), F.count_if(F.coalesce("n_tool_calls", F.lit(0)) == 0).alias("idle")
    )
    rules = {"few": F.col("n") < 20, "none solved": F.col("ok") == 0, "truncated": F.col("cut") * 10 > F.col("n"), "no calls": F.col("idle") * 4 > F.col("n"), "no template": F.col("template") == "?"}
    return g.select("template", F.concat_ws(",", *(F.when(c, name) for name, c in rules.items())).alias("problems"))


@query("composite_leaderboard", f"""with {TRACES}, {CALLS}, v as (select trace_id, bool_and(json_valid(arguments)) as valid from calls group by trace_id),
g as (select teacher, count(*) as n, count(*) filter (score = 1.0) / count(*) as "yield", count(*) filter (coalesce(valid, true)) / count(*) as validity,
  count(*) filter (injected and replan) / greatest(1, count(*) filter (injected)) as replan_rate from traces left join v using (trace_id) group by teacher)
select teacher, n, "yield", validity, replan_rate, "yield" * validity as composite, row_number() over (order by "yield" * validity desc, teacher)::int as place from g""")
def composite_leaderboard(spark, sf):
    """Per teacher yield, validity of its calls, replans where a fault was injected, and yield times validity; best first, ties by name."""
    from pyspark.sql import Window as W

    valid = F.forall(sequences.ordered(F.col("tool_calls")), lambda c: F.try_parse_json(c["arguments"]).isNotNull())
    t = traces(spark, sf).withColumn("valid", F.coalesce(valid, F.lit(False)))
    g = t.groupBy("teacher").agg(
        F.count("*").alias("n"), (F.count_if(F.col("score") == 1.0) / F.count("*")).alias("yield"), (F.count_if("valid") / F.count("*")).alias("validity"),
        (F.count_if(F.col("injected") & F.col("replan")) / F.greatest(F.lit(1), F.count_if("injected"))).alias("replan_rate"),
    )
    g = g.withColumn("composite", F.col("yield") * F.col("validity"))
    return g.withColumn("place", F.row_number().over(W.partitionBy(F.lit(1)).orderBy(F.desc("composite"), "teacher")))  # one row a teacher


@query("cut_observations", f"""with {MESSAGES} select chat_id, pos, least(length(content), 400)::int as kept, length(content) > 400 as was_cut, right(left(content, 400), 5) as ends from messages where role = 'tool'""")
def cut_observations(spark, sf):
    m = chat_messages(spark, sf).filter("role = 'tool'").withColumn("cut", masks.cut_text(F.col("content"), 400))
    return m.select("chat_id", "pos", F.length("cut").alias("kept"), (F.length("content") > 400).alias("was_cut"), F.right("cut", F.lit(5)).alias("ends"))


@query("first_calls", f"""with {CALLS}, r as (select *, row_number() over (partition by trace_id order by seq, call_id) as k, count(*) over (partition by trace_id) as n from calls)
select trace_id, string_agg(tool_name, ',' order by k) filter (k <= 8) as tools, max(n)::int as n from r group by trace_id""")
def first_calls(spark, sf):
    """The first eight calls of a trace, as a record shows them, with the number of all."""
    t = table(spark, sf, "db_traces_chat").select("trace_id", sequences.ordered(F.col("tool_calls")).alias("c")).filter("size(c) > 0")
    return t.select("trace_id", F.array_join(F.transform(masks.cut_list(F.col("c"), 8), lambda c: c["tool_name"]), ",").alias("tools"), F.size("c").alias("n"))


@query("role_counts", f"""with {MESSAGES}, k as (select chat_id, role, count(*) as n from messages where role <> 'system' group by all),
a as (select chat_id, unnest(['user', 'agent', 'tool']) as role from (select distinct chat_id from messages))
select a.chat_id, string_agg(a.role || '=' || coalesce(k.n, 0)::varchar, ' ' order by a.role) as counts from a left join k on k.chat_id = a.chat_id and case k.role when 'assistant' then 'agent' else k.role end = a.role group by a.chat_id""")
def role_counts(spark, sf):
    """Counts by role as a map: one key dropped, one renamed, missing ones from the defaults."""
    roles = F.array_distinct(F.transform("messages", lambda m: m["role"]))
    counts = F.map_from_entries(F.transform(roles, lambda r: F.struct(r, F.size(F.filter("messages", lambda m: m["role"] == r)))))
    named = F.transform_keys(F.map_filter(counts, lambda k, v: k.isin("user", "assistant", "tool")), lambda k, v: F.when(k == "assistant", "agent").otherwise(k))
    defaults = F.create_map(*(F.lit(x) for r in ("agent", "tool", "user") for x in (r, 0)))
    c = table(spark, sf, "areal_chat").filter("size(messages) > 0").select("chat_id", F.map_zip_with(defaults, named, lambda k, a, b: F.coalesce(b, a)).alias("m"))
    return c.select("chat_id", F.array_join(F.transform(F.array_sort(F.map_entries("m")), lambda e: F.concat_ws("=", e["key"], e["value"].cast("string"))), " ").alias("counts"))


#: Codes in the token sequences of a chat: header, then the role, then one token for the content, then the closing mark.
ROLE_CODES = {"system": 2, "user": 3, "assistant": 4, "tool": 5}


def chat_tokens(spark, sf):
    c = table(spark, sf, "areal_chat").filter("size(messages) > 0")
    code = F.create_map(*(F.lit(x) for p in ROLE_CODES.items() for x in p))
    tokens = F.flatten(F.transform("messages", lambda m: F.array(F.lit(1), F.coalesce(code[m["role"]], F.lit(6)), F.length(F.coalesce(m["content"], F.lit(""))) + 1000, F.lit(9))))
    return c.select("chat_id", tokens.alias("tokens"), ((sequences.last_index(F.col("messages"), "user") + 1) * 4).alias("last_user_end"))


@query("span_labels", f"""with {MESSAGES}, u as (select chat_id, coalesce(max(pos) filter (role = 'user'), -1) as user_pos from messages group by chat_id)
select chat_id, (count(*) * 4)::int as n, (count(*) filter (role = 'assistant' and pos > user_pos) * 2)::int as n_labels,
  coalesce(sum(length(content) + 1000 + 9) filter (role = 'assistant' and pos > user_pos), 0)::bigint as label_sum from messages join u using (chat_id) group by chat_id""")
def span_labels(spark, sf):
    labels = masks.span_labels([1, ROLE_CODES["assistant"]], 9)
    c = chat_tokens(spark, sf).select("chat_id", labels("tokens", "last_user_end").alias("labels"))
    kept = F.filter("labels", lambda x: x != masks.IGNORED)
    return c.select("chat_id", F.size("labels").alias("n"), F.size(kept).alias("n_labels"), F.aggregate(kept, F.lit(0).cast("long"), lambda n, x: n + x).alias("label_sum"))


@query("padded_batches", f"""with {MESSAGES}, n as (select chat_id, (count(*) * 4)::int as n from messages group by chat_id), b as (select chat_id // 8 as batch, max(n)::int as size from n group by all)
select chat_id, size, (size - n)::int as n_filled from n join b on b.batch = chat_id // 8""")
def padded_batches(spark, sf):
    """Sequences of a batch (eight ids in a row) filled up to its longest."""
    c = chat_tokens(spark, sf).withColumn("batch", F.expr("chat_id div 8"))
    c = c.join(c.groupBy("batch").agg(F.max(F.size("tokens")).alias("size")), "batch")
    c = c.select("chat_id", "size", masks.padded(F.col("tokens"), F.col("size"), masks.IGNORED).alias("filled"))
    return c.select("chat_id", F.size("filled").alias("size"), F.size(F.filter("filled", lambda x: x == masks.IGNORED)).alias("n_filled"))


@query("uniform_sample", "select trace_id from db_traces_chat order by sha256('all|' || trace_id::varchar) limit 500")
def uniform_sample(spark, sf):
    return sampling.uniform_sample(table(spark, sf, "db_traces_chat").select("trace_id"), "trace_id", 500, "all")


@query("varied_texts", """with t as (select distinct task_id, kind, ('0x' || substr(sha256('v|' || task_id), 1, 6))::bigint as h from (select task_id, arg_min(kind, exported_at) as kind from db_tasks where task_id is not null group by task_id))
select task_id, case h % 3 when 0 then 'Bitte pruefe ' when 1 then 'Kannst du pruefen: ' else 'Frage zu ' end || task_id || ' (' || coalesce(kind, '?') || ').' || case when h % 10 < 4 then ' Es eilt.' else '' end as text from t""")
def varied_texts(spark, sf):
    """A text from one of several templates, with an extra sentence in some; which, a hash of the id tells."""
    k = table(spark, sf, "db_tasks").filter("task_id is not null").groupBy("task_id").agg(F.min_by("kind", "exported_at").alias("kind"))
    h = F.conv(F.substring(sampling.draw("v", "task_id"), 1, 6), 16, 10).cast("long")
    variants = F.array(F.lit("Bitte pruefe %s (%s)."), F.lit("Kannst du pruefen: %s (%s)."), F.lit("Frage zu %s (%s)."))
    k = k.withColumn("h", h).withColumn("form", F.get(variants, (F.col("h") % 3).cast("int"))).withColumn("kind", F.coalesce("kind", F.lit("?")))
    return k.select("task_id", F.concat(F.expr("format_string(form, task_id, kind)"), F.when(F.col("h") % 10 < 4, " Es eilt.").otherwise("")).alias("text"))


@query("worker_count", """select teacher, count(*) as n, least(48, greatest(1, ceil(count(*) / 100.0)))::int as workers, greatest(300, least(1800, floor(2 * max(wall_s))))::int as timeout_s from db_traces_chat group by teacher""")
def worker_count(spark, sf):
    """How many workers and how long a limit a load needs, between fixed bounds."""
    g = table(spark, sf, "db_traces_chat").groupBy("teacher").agg(F.count("*").alias("n"), F.max("wall_s").alias("most"))
    workers = F.least(F.lit(48), F.greatest(F.lit(1), F.ceil(F.col("n") / 100.0)))
    return g.select("teacher", "n", workers.cast("int").alias("workers"), F.greatest(F.lit(300), F.least(F.lit(1800), F.floor(2 * F.col("most")))).cast("int").alias("timeout_s"))


@query("unique_hit", """with h as (select chat_id, domain_name, [k for k in ['flight', 'order', 'invoice'] if contains(messages::varchar, k)] as hits from (select chat_id, domain_name, coalesce(list_transform(messages, lambda m: coalesce(m.content, '')), []) as messages from areal_chat))
select chat_id, coalesce(domain_name, case when len(hits) = 1 then hits[1] end, '?') as domain from h""")
def unique_hit(spark, sf):
    """The domain as given, else the marker that is the only one in the chat."""
    text = sequences.role_text(F.coalesce("messages", F.array().cast("array<struct<role:string,content:string>>")))
    hits = F.filter(F.array(*map(F.lit, ("flight", "order", "invoice"))), lambda k: F.contains(text, k))
    return table(spark, sf, "areal_chat").select("chat_id", F.coalesce("domain_name", F.when(F.size(hits) == 1, F.get(hits, 0)), F.lit("?")).alias("domain"))


@query("split_names", "select coalesce(nullif(regexp_replace(lower(trim(split)), '[\\s-]+', '_', 'g'), ''), '?') as split, count(*) as n_rows, count(distinct task_id) as n_tasks from task_splits group by 1")
def split_names(spark, sf):
    return table(spark, sf, "task_splits").groupBy(F.coalesce(clean_label("split"), F.lit("?")).alias("split")).agg(F.count("*").alias("n_rows"), F.countDistinct("task_id").alias("n_tasks"))
