"""Queries over texts."""

from __future__ import annotations

from pyspark.sql import functions as F

from railyard.core import table
from railyard.operators import sequences, text as op
from railyard.operators.predicates import MAX_DUPLICATE_RATIO
from railyard.plans.registry import query
from railyard.plans.views import MESSAGES, chat_messages

GRAMS = """w as (select doc_id, list_filter(regexp_split_to_array(text, '\\s+'), lambda x: x <> '') as w from documents where text is not null),
g as (select doc_id, len(w) as n, case when len(w) >= 32 then list_transform(range(1, len(w) - 6), lambda i: array_to_string(w[i:i + 7], ' ')) end as g from w),
r as (select doc_id, n, case when n >= 32 then round_even(1.0::double - len(list_distinct(g)) / len(g), 3) else 0.0 end as ratio from g)"""


@query("ngram_dup_ratio", f"with {GRAMS} select doc_id, ratio from r where ratio > 0")
def ngram_dup_ratio(spark, sf):
    d = table(spark, sf, "documents").filter("text is not null")
    return d.select("doc_id", sequences.duplicate_ratio(F.col("text")).alias("ratio")).filter("ratio > 0")


@query("degenerate_flag", f"""with {GRAMS}
select coalesce(d.source, '?') as source, count(*) as n, count(*) filter (coalesce(ratio, 0) > 0.5 or coalesce(length(text), 0) > 12000) as degenerate
from documents d left join r using (doc_id) group by 1""")
def degenerate_flag(spark, sf):
    d = table(spark, sf, "documents").select("source", "text")
    bad = (F.coalesce(sequences.duplicate_ratio(F.col("text")), F.lit(0.0)) > MAX_DUPLICATE_RATIO) | (F.coalesce(F.length("text"), F.lit(0)) > 12_000)
    return d.groupBy(F.coalesce("source", F.lit("?")).alias("source")).agg(F.count("*").alias("n"), F.count_if(bad).alias("degenerate"))


@query("contamination_contains", f"""with {MESSAGES},
n as (select item_id, trim(lower(regexp_replace(s, '\\s+', ' ', 'g'))) as needle from (select item_id, unnest(string_split(item_text, '. ')) as s from heldout_items)),
t as (select chat_id, trim(lower(regexp_replace(content, '\\s+', ' ', 'g'))) as text from messages)
select distinct chat_id, item_id from t join n on contains(text, needle) where length(needle) >= 30""")
def contamination_contains(spark, sf):
    sentences = table(spark, sf, "heldout_items").select("item_id", F.explode(F.split("item_text", r"\. ")).alias("s"))
    m = chat_messages(spark, sf).select("chat_id", "pos", "content")
    m = m.withColumn("id", F.struct("chat_id", "pos"))
    found = op.containment(m, F.col("content"), "id", sentences, "item_id", F.col("s"))
    return found.select("id.chat_id", "item_id").distinct()


@query("entity_overlap", f"""with {MESSAGES},
i as (select distinct unnest(regexp_extract_all(item_text, '#W\\d{{7}}|[a-z]+(_[a-z]+)*_\\d{{4}}')) as entity from heldout_items),
c as (select distinct unnest(regexp_extract_all(content, '#W\\d{{7}}|[a-z]+(_[a-z]+)*_\\d{{4}}')) as entity from messages)
select count(*) as n_entities, count(c.entity) as n_found from i left join c using (entity)""")
def entity_overlap(spark, sf):
    pattern = F.lit(r"#W\d{7}|[a-z]+(?:_[a-z]+)*_\d{4}")
    names = lambda d, c: d.select(F.explode(F.regexp_extract_all(c, pattern, F.lit(0))).alias("entity")).distinct()
    i = names(table(spark, sf, "heldout_items"), F.col("item_text"))
    c = names(chat_messages(spark, sf), F.col("content")).withColumn("found", F.lit(1))
    return i.join(c, "entity", "left").agg(F.count("*").alias("n_entities"), F.count("found").alias("n_found"))


ENTITY_SQL = """list_distinct(regexp_extract_all(answer, '\\bMA-\\d+\\b') || regexp_extract_all(answer, '\\bWO-\\d{4}-\\d+\\b') || regexp_extract_all(answer, '\\bAS-\\d+\\b')
  || regexp_extract_all(answer, '\\b\\d{1,2}:\\d{2}\\b') || regexp_extract_all(answer, '\\b\\d{4}-\\d{2}-\\d{2}\\b')
  || regexp_extract_all(answer, '\\b(?:ICE|IC|EC|ECE|RJ|EN)\\s?\\d+\\b') || regexp_extract_all(answer, '\\b[A-Za-z0-9]+-9\\d{3}\\b'))"""


@query("grounding_tokens", f"""with {MESSAGES},
a as (select chat_id, max(pos) as pos from messages where role = 'assistant' and length(trim(content)) > 0 group by chat_id),
t as (select m.chat_id, any_value(m2.content) as answer, lower(regexp_replace(coalesce(string_agg(m.content, chr(10) order by m.pos) filter (m.pos < a.pos), ''), '\\s+', '', 'g')) as corpus
  from messages m join a using (chat_id) join messages m2 on m2.chat_id = a.chat_id and m2.pos = a.pos group by m.chat_id),
e as (select chat_id, corpus, unnest({ENTITY_SQL}) as e from t)
select chat_id, count(*)::int as n_entities, count(*) filter (not contains(corpus, lower(regexp_replace(e, '\\s+', '', 'g'))))::int as n_ungrounded from e group by chat_id""")
def grounding_tokens(spark, sf):
    c = table(spark, sf, "areal_chat").select("chat_id", "messages")
    marks = F.transform("messages", lambda m, i: F.when((m["role"] == "assistant") & (F.length(F.trim(m["content"])) > 0), i))
    c = c.withColumn("at", F.array_max(marks)).filter("at is not null")
    c = c.select("chat_id", F.expr("messages[at].content").alias("answer"), sequences.role_text(F.expr("slice(messages, 1, at)")).alias("corpus"))
    c = c.select("chat_id", F.size(op.entities(F.col("answer"))).alias("n_entities"), F.size(op.ungrounded(F.col("answer"), F.col("corpus"))).alias("n_ungrounded"))
    return c.filter("n_entities > 0")


@query("derived_times", """with t as (select doc_id, list_distinct(regexp_extract_all(text, '\\b([01]\\d|2[0-3]):[0-5]\\d\\b')) as times,
    list_distinct(list_transform(regexp_extract_all(text, '\\b(\\d{1,3}) Minuten', 1), lambda d: d::int)) as delays from documents),
x as (select doc_id, t, d from (select doc_id, unnest(times) as t, delays from t) a, unnest(a.delays) u(d) where d <> 0),
m as (select doc_id, split_part(t, ':', 1)::int * 60 + split_part(t, ':', 2)::int as m, d from x),
y as (select doc_id, ((m + d) % 1440 + 1440) % 1440 as v from m union select doc_id, ((m - d) % 1440 + 1440) % 1440 from m)
select doc_id, string_agg(format('{:02d}:{:02d}', v // 60, v % 60), ',' order by v) as times, count(*)::int as n from y group by doc_id""")
def derived_times(spark, sf):
    d = table(spark, sf, "documents").select("doc_id", op.derived_times(F.col("text")).alias("t")).filter("size(t) > 0")
    return d.select("doc_id", F.array_join("t", ",").alias("times"), F.size("t").alias("n"))


@query("communicate_check", f"""with {MESSAGES},
f as (select distinct chat_id, unnest(regexp_extract_all(content, '#W\\d{{7}}|\\b(?:LM|QT|VX)\\d{{3}}\\b')) as fact from messages where role = 'tool'),
a as (select chat_id, lower(string_agg(content, chr(10) order by pos)) as text from messages where role = 'assistant' group by chat_id)
select chat_id, count(*)::int as n_facts, bool_and(contains(coalesce(text, ''), lower(fact))) as all_told from f left join a using (chat_id) group by chat_id""")
def communicate_check(spark, sf):
    c = table(spark, sf, "areal_chat")
    facts = F.array_distinct(F.regexp_extract_all(sequences.role_text(F.col("messages"), "tool"), F.lit(r"#W\d{7}|\b(?:LM|QT|VX)\d{3}\b"), F.lit(0)))
    c = c.select("chat_id", facts.alias("facts"), F.lower(sequences.role_text(F.col("messages"), "assistant")).alias("told")).filter("size(facts) > 0")
    return c.select("chat_id", F.size("facts").alias("n_facts"), F.forall("facts", lambda f: F.contains(F.col("told"), F.lower(f))).alias("all_told"))


GERMAN_SQL = "['der', 'die', 'das', 'ist', 'sind', 'und', 'für', 'wurde', 'wurden', 'keine', 'aktuell', 'zug', 'verspätung', 'zugeteilt', 'minuten', 'planmäßig']"


@query("language_proxy", f"""with w as (select doc_id, text, len(list_filter(regexp_split_to_array(lower(text), '[^\\p{{L}}\\p{{M}}\\p{{N}}_]+'), lambda w: list_contains({GERMAN_SQL}, w)))::int as german_words from documents where text is not null)
select doc_id, german_words, german_words >= 2 or regexp_matches(text, '[äöüÄÖÜß]') as looks_german from w""")
def language_proxy(spark, sf):
    """Every text, whatever its script."""
    d = table(spark, sf, "documents").filter("text is not null").select("doc_id", "text", op.german_words(F.col("text")).alias("german_words"))
    return d.select("doc_id", "german_words", op.looks_german(F.col("text"), F.col("german_words")).alias("looks_german"))


@query("think_strip", """with t as (select doc_id, text, length(text) // 4 as k from documents where text is not null),
m as (select doc_id, '<think>' || substr(text, 1, k) || '</think> ' || substr(text, k + 1, k) || '[THINK]' || substr(text, 2 * k + 1, k) || '[/THINK]' || substr(text, 3 * k + 1)
  || case when doc_id % 3 = 0 then '</think>' || text else '' end as raw from t),
s as (select doc_id, regexp_replace(regexp_replace(raw, '<(?:seed:)?think>.*?</(?:seed:)?think>[\\t\\n\\x0b\\f\\r ]*', '', 'gs'), '\\[THINK\\].*?\\[/THINK\\][\\t\\n\\x0b\\f\\r ]*', '', 'gs') as s from m)
select doc_id, trim(list_extract(string_split(s, '</think>'), -1), ' ') as plain from s""")
def think_strip(spark, sf):
    """Every character of every text, in quarters: reasoning, answer, reasoning, answer; each third text once more after a lost closing mark."""
    d = table(spark, sf, "documents").filter("text is not null").select("doc_id", "text", F.expr("length(text) div 4").cast("int").alias("k"))
    raw = F.expr("concat('<think>', substr(text, 1, k), '</think> ', substr(text, k + 1, k), '[THINK]', substr(text, 2 * k + 1, k), '[/THINK]', substr(text, 3 * k + 1), case when doc_id % 3 = 0 then concat('</think>', text) else '' end)")
    return d.select("doc_id", op.strip_reasoning(raw).alias("plain"))


@query("leak_markers", f"""with {MESSAGES},
m as (select chat_id, max(case when contains(content, 'policy') then 1 else 0 end) = 1 as leak, count(*) filter (role = 'assistant') as agent_turns,
  sum(len(string_split(content, 'order ')) - 1)::bigint as order_marks from messages group by chat_id)
select leak, count(*) as n, sum(agent_turns)::bigint as agent_turns, count(*) filter (order_marks >= 3) as at_least_3_marks from m group by leak""")
def leak_markers(spark, sf):
    c = table(spark, sf, "areal_chat").filter("size(messages) > 0")
    content = lambda m: F.coalesce(m["content"], F.lit(""))
    c = c.select(
        F.exists("messages", lambda m: F.contains(content(m), F.lit("policy"))).alias("leak"),
        F.size(F.filter("messages", lambda m: m["role"] == "assistant")).alias("turns"),
        F.aggregate("messages", F.lit(0), lambda n, m: n + F.size(F.split(content(m), "order ")) - 1).alias("marks"),
    )
    return c.groupBy("leak").agg(F.count("*").alias("n"), F.sum(F.col("turns").cast("long")).alias("agent_turns"), F.count_if(F.col("marks") >= 3).alias("at_least_3_marks"))


@query("id_slugs", """select distinct template, trim(regexp_replace(replace(replace(replace(replace(lower(template), 'ä', 'ae'), 'ö', 'oe'), 'ü', 'ue'), 'ß', 'ss'), '[^a-z0-9_.-]+', '-', 'g'), '-') as slug,
  substr(sha256(template), 1, 16) as digest from db_tasks where template is not null""")
def id_slugs(spark, sf):
    c = F.lower("template")
    for a, b in (("ä", "ae"), ("ö", "oe"), ("ü", "ue"), ("ß", "ss")):
        c = F.replace(c, F.lit(a), F.lit(b))
    slug = F.regexp_replace(F.regexp_replace(c, "[^a-z0-9_.-]+", "-"), "^-+|-+$", "")
    return table(spark, sf, "db_tasks").filter("template is not null").select("template", slug.alias("slug"), F.substring(F.sha2("template", 256), 1, 16).alias("digest")).distinct()
