"""Operators over ordered events and messages. A record's calls or messages are an array, so these are row-local."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from railyard.core import bound


def ordered(calls: Column) -> Column:
    """Calls by seq, each held once; an empty array for null."""
    return F.coalesce(F.array_sort(F.array_distinct(calls)), F.array().cast("array<struct<seq:int,call_id:string,tool_name:string,arguments:string,called_at:timestamp_ntz,took_ms:int>>"))


def repeats(calls: Column, slow_ms: int | None = None) -> Column:
    """How many of the ordered calls equal the one before (tool and arguments as text).

    With ``slow_ms`` a repeat does not count where the call before took that long (a time-out that is worth a retry).
    """
    pairs = F.arrays_zip(F.slice(calls, 1, F.greatest(F.size(calls) - 1, F.lit(0))).alias("a"), F.slice(calls, 2, F.greatest(F.size(calls) - 1, F.lit(0))).alias("b"))

    def same(p: Column) -> Column:
        eq = p["a"]["tool_name"].eqNullSafe(p["b"]["tool_name"]) & p["a"]["arguments"].eqNullSafe(p["b"]["arguments"])
        return eq if slow_ms is None else eq & (F.coalesce(p["a"]["took_ms"], F.lit(0)) < slow_ms)

    return F.size(F.filter(pairs, same))


def last_index(messages: Column, role: str) -> Column:
    """Index from 0 of the last message of a role; -1 without one."""
    marks = F.transform(messages, lambda m, i: F.when(m["role"] == role, i).otherwise(F.lit(-1)))
    return F.coalesce(F.array_max(marks), F.lit(-1))


def trained_chars(messages: Column) -> Column:
    """Characters of the assistant messages after the last user message; all of them without a user message."""
    spoken = bound(last_index(messages, "user"), lambda at: F.filter(messages, lambda m, i: (i > at) & (m["role"] == "assistant")))
    return F.aggregate(spoken, F.lit(0).cast("long"), lambda n, m: n + F.coalesce(F.length(m["content"]), F.lit(0)))


def final_answer(messages: Column) -> Column:
    """Content of the last assistant message that has some."""
    full = F.filter(messages, lambda m: (m["role"] == "assistant") & (F.length(F.trim(m["content"])) > 0))
    return F.try_element_at(F.transform(full, lambda m: m["content"]), F.lit(-1))


def role_text(messages: Column, role: str | None = None) -> Column:
    """Contents of one role (or all) joined by line ends."""
    chosen = messages if role is None else F.filter(messages, lambda m: m["role"] == role)
    return F.array_join(F.transform(chosen, lambda m: F.coalesce(m["content"], F.lit(""))), "\n")


def fitting_prefix(messages: Column, budget: int) -> Column:
    """How many messages the longest prefix has that ends on an assistant message and fits into ``budget`` characters."""
    step = lambda acc, m: F.struct(
        (acc["chars"] + F.coalesce(F.length(m["content"]), F.lit(0))).alias("chars"),
        (acc["i"] + 1).alias("i"),
        F.when(
            (acc["chars"] + F.coalesce(F.length(m["content"]), F.lit(0)) <= budget) & (m["role"] == "assistant"), acc["i"] + 1
        ).otherwise(acc["best"]).alias("best"),
    )
    start = F.struct(F.lit(0).cast("long").alias("chars"), F.lit(0).cast("long").alias("i"), F.lit(0).cast("long").alias("best"))
    return F.aggregate(messages, start, step, lambda acc: acc["best"])


def common_prefix(a: Column, b: Column) -> Column:
    """Length of the longest common prefix of two arrays of strings."""
    n = F.least(F.size(a), F.size(b))
    marks = F.transform(F.arrays_zip(F.slice(a, 1, n).alias("x"), F.slice(b, 1, n).alias("y")), lambda p, i: F.when(~p["x"].eqNullSafe(p["y"]), i))
    return F.coalesce(F.array_min(marks), n)


def longest_streak(flags: Column) -> Column:
    """Length of the longest run of true values."""
    start = F.struct(F.lit(0).alias("now"), F.lit(0).alias("best"))

    def step(acc: Column, f: Column) -> Column:
        now = F.when(f, acc["now"] + 1).otherwise(0)
        return F.struct(now.alias("now"), F.greatest(acc["best"], now).alias("best"))

    return F.aggregate(flags, start, step, lambda acc: acc["best"])


def duplicate_ratio(text: Column, n: int = 8, least: int = 32) -> Column:
    """1 - distinct / all word n-grams, rounded half even to 3; 0 for fewer than ``least`` words."""
    words = F.filter(F.split(text, r"\s+"), lambda w: w != "")

    def ratio(w: Column) -> Column:
        grams = F.transform(F.sequence(F.lit(1), F.size(w) - (n - 1)), lambda i: F.xxhash64(F.slice(w, i, n)))  # equal grams are told by their hash
        return F.when(F.size(w) >= least, bound(grams, lambda g: F.bround(1.0 - F.size(F.array_distinct(g)) / F.size(g), 3))).otherwise(F.lit(0.0))

    return bound(words, ratio)


def hourly(events: DataFrame, ts: str) -> DataFrame:
    """Events per hour with the running total; the windows run over the hours, a small table."""
    per = events.groupBy(F.date_trunc("hour", ts).alias("hour")).agg(F.count("*").alias("n"))
    return per.withColumn("total", F.sum("n").over(W.partitionBy(F.lit(1)).orderBy("hour").rowsBetween(W.unboundedPreceding, 0)))


def rolling_rate(ticks: DataFrame, width: int, goal: int) -> DataFrame:
    """Rate an hour over the last ``width`` ticks and hours left to the goal at that rate."""
    w = W.partitionBy(F.lit(1)).orderBy("hour")
    base = F.first("total").over(w.rowsBetween(-width, 0))
    first = F.first("hour").over(w.rowsBetween(-width, 0))
    hours = (F.unix_seconds(F.col("hour").cast("timestamp")) - F.unix_seconds(first.cast("timestamp"))) / 3600.0
    rate = F.when(hours > 0, (F.col("total") - base) / hours)
    return ticks.withColumn("rate", rate).withColumn("eta_hours", F.when(rate > 0, F.greatest(F.lit(goal) - F.col("total"), F.lit(0)) / rate))


def stalls(ticks: DataFrame, value: str, least: int, run: int) -> DataFrame:
    """Stretches of at least ``run`` ticks in a row whose value is under ``least``."""
    w = W.partitionBy(F.lit(1)).orderBy("hour")
    low = F.col(value) < least
    island = F.row_number().over(w) - F.row_number().over(W.partitionBy(low).orderBy("hour"))
    t = ticks.withColumn("_low", low).withColumn("_island", island).filter("_low")
    return t.groupBy("_island").agg(F.min("hour").alias("since"), F.count("*").alias("ticks")).filter(F.col("ticks") >= run).drop("_island")
