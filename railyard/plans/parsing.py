"""Parsers of model output. Texts in the forms to parse are built from the tables, so results can be told by SQL."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import functions as F

from railyard.core import table
from railyard.functions.values import bracket_calls, canonical_json, leading_array, leaf_strings
from railyard.plans.registry import query
from railyard.plans.views import CALLS, calls


@query("tool_call_extract", f"""with {CALLS}
select trace_id, (row_number() over (partition by trace_id order by seq, call_id) - 1)::int as pos, tool_name as name from calls where json_valid(arguments)""")
def tool_call_extract(spark, sf):
    """All calls of a trace, those with broken arguments too, which the parser has to skip."""
    from railyard.functions.tables import register

    register(spark)
    block = lambda c: F.concat(F.lit('<tool_call>{"name": "'), c["tool_name"], F.lit('", "arguments": '), c["arguments"], F.lit("}</tool_call>"))
    t = table(spark, sf, "db_traces_chat").select("trace_id", F.array_sort(F.transform(F.array_distinct("tool_calls"), lambda c: F.struct(c["seq"].alias("seq"), c["call_id"].alias("call_id"), block(c).alias("b")))).alias("a"))
    t = t.select("trace_id", F.concat(F.lit("Ich sehe nach. "), F.array_join(F.transform("a", lambda x: x["b"]), "\n")).alias("text"))
    t.createOrReplaceTempView("railyard_calls_text")
    return spark.sql("select trace_id, x.pos, x.name from railyard_calls_text, lateral extract_calls(text) x")


@query("bracket_dsl", f"""with {CALLS}
select trace_id, seq, call_id, tool_name as name, arguments as value from calls where arguments is not null and tool_name is not null""")
def bracket_dsl(spark, sf):
    """Every call in the bracket form, with its arguments as one quoted text, so quotes, brackets, commas and backslashes stand inside values."""

    @F.pandas_udf("array<struct<name string, arguments string>>")
    def parse(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: bracket_calls(t) if t is not None else None)

    c = calls(spark, sf).filter("arguments is not null and tool_name is not null")
    quoted = F.regexp_extract(F.to_json(F.array("arguments")), r"(?s)^\[(.*)\]$", 1)
    text = F.concat(F.lit("["), F.col("tool_name"), F.lit("(value="), quoted, F.lit(', tage=[1, (2)], art="a,b)")]'))
    got = c.select("trace_id", "seq", "call_id", F.explode(parse(text)).alias("p"))
    return got.select("trace_id", "seq", "call_id", "p.name", F.get_json_object("p.arguments", "$.value").alias("value"))


@query("canonical_arguments")
def canonical_arguments(spark, sf):
    """One form of each argument object; how many spellings share it."""

    @F.pandas_udf("string")
    def canon(texts: pd.Series) -> pd.Series:
        return texts.map(canonical_json)

    c = calls(spark, sf).groupBy("tool_name", "arguments").agg(F.count("*").alias("n"))
    return c.groupBy("tool_name", canon("arguments").alias("canonical")).agg(F.count("*").alias("n_spellings"), F.sum("n").alias("n_calls"))


@query("leaf_strings")
def leaf_texts(spark, sf):
    """Text leaves of the JSON in tool messages, by the length class they fall into."""
    import json

    @F.pandas_udf("array<string>")
    def leaves(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        def one(t: str | None) -> list[str]:
            try:
                return leaf_strings(json.loads(t)) if t else []
            except (ValueError, RecursionError):
                return leaf_strings(leading_array(t) or [])

        for texts in batches:
            yield texts.map(one)

    m = table(spark, sf, "areal_chat").select(F.explode("messages").alias("m")).filter("m.role = 'tool'")
    s = m.select(F.explode(leaves("m.content")).alias("leaf"))
    return s.groupBy((F.length("leaf") >= 30).alias("long")).agg(F.count("*").alias("n"), F.countDistinct("leaf").alias("n_distinct"))


#: How a call without a name stands in a text.
CALL = '<tool_call>{"name": "call"}</tool_call>'


@query("segment_episode")
def segment_episode(spark, sf):
    """All chats with messages, tool answers bound to the calls that wait for them. A call is an assistant message without content, as in
    ``bind_results``; it stands in the text as a tagged block."""
    from railyard.functions.tables import register

    register(spark)
    content = lambda m: F.coalesce(m["content"], F.lit(""))
    is_call = lambda m: (m["role"] == "assistant") & ~content(m).rlike(r"(?U)\S")
    turn = lambda m: F.concat(F.lit("<|"), m["role"], F.lit("|>"), F.when(is_call(m), F.lit(CALL)).otherwise(content(m)))
    c = table(spark, sf, "areal_chat").filter(F.size("messages") > 0)
    c.select("chat_id", F.array_join(F.transform("messages", turn), "\n").alias("text")).createOrReplaceTempView("railyard_episode_text")
    return spark.sql("select chat_id, x.pos, x.role, x.content, x.call_id from railyard_episode_text, lateral segment_episode(text) x")
