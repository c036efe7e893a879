"""The tables as the queries read them, in Spark and as common table expressions for the SQL side."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from railyard.core import clean_label, table


def label_sql(col: str) -> str:
    return f"nullif(regexp_replace(lower(trim({col})), '[\\s-]+', '_', 'g'), '')"


def traces(spark: SparkSession, sf: str) -> DataFrame:
    """Rollout records with cleaned labels; missing labels read as '?', none, false, direct."""
    t = table(spark, sf, "db_traces_chat")
    return t.withColumns(
        {
            "template": F.coalesce(clean_label("template"), F.lit("?")),
            "fault": F.coalesce(clean_label("fault"), F.lit("none")),
            "replan": F.coalesce("replan", F.lit(False)),
            "recovery_mode": F.coalesce(clean_label("recovery_mode"), F.lit("direct")),
        }
    )


TRACES = f"""traces as (
  select * replace (coalesce({label_sql('template')}, '?') as template, coalesce({label_sql('fault')}, 'none') as fault,
                    coalesce(replan, false) as replan, coalesce({label_sql('recovery_mode')}, 'direct') as recovery_mode)
  from db_traces_chat)"""

#: One row per (task_id, sample_idx), the first delivered.
FIRST_TRACES = TRACES + """, first_traces as (
  select * from traces qualify row_number() over (partition by task_id, sample_idx order by ingested_at, trace_id) = 1)"""


def first_traces(spark: SparkSession, sf: str, *columns: str) -> DataFrame:
    """One row per (task_id, sample_idx), the first delivered; an aggregate, so no key needs a sorted window."""
    t = traces(spark, sf)
    columns = columns or tuple(t.columns)
    row = F.struct(*(c for c in columns if c not in ("task_id", "sample_idx")))
    return t.groupBy("task_id", "sample_idx").agg(F.min_by(row, F.struct("ingested_at", "trace_id")).alias("row")).select("task_id", "sample_idx", "row.*")


def calls(spark: SparkSession, sf: str) -> DataFrame:
    """One row per tool call: trace_id, seq, call_id, tool_name, arguments, called_at, took_ms; a call held twice counts once."""
    t = table(spark, sf, "db_traces_chat").select("trace_id", F.explode(F.array_distinct("tool_calls")).alias("c"))
    return t.select("trace_id", "c.*")


CALLS = """calls as (
  select trace_id, c.seq as seq, c.call_id as call_id, c.tool_name as tool_name, c.arguments as arguments, c.called_at as called_at, c.took_ms as took_ms
  from (select trace_id, unnest(list_distinct(tool_calls)) as c from db_traces_chat))"""


def chat_messages(spark: SparkSession, sf: str) -> DataFrame:
    """One row per message of areal_chat: chat_id, pos from 0, role, content ('' if null)."""
    t = table(spark, sf, "areal_chat").select("chat_id", F.posexplode("messages").alias("pos", "m"))
    return t.select("chat_id", "pos", F.col("m.role").alias("role"), F.coalesce("m.content", F.lit("")).alias("content"))


MESSAGES = """messages as (
  select chat_id, (i - 1)::int as pos, messages[i].role as role, coalesce(messages[i].content, '') as content
  from (select chat_id, messages, unnest(range(1, len(messages) + 1)) as i from areal_chat))"""


def mix_records(spark: SparkSession, sf: str) -> DataFrame:
    """Records of sft_mix_chat with a cleaned source ('?' if missing)."""
    return table(spark, sf, "sft_mix_chat").withColumn("source", F.coalesce(clean_label("source"), F.lit("?")))


RECORDS = f"""records as (select * replace (coalesce({label_sql('source')}, '?') as source) from sft_mix_chat)"""
