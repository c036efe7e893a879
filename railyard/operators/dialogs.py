"""Normal forms of messages and calls, bindings of results to calls, gates and small lookups."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ROLES = ("system", "user", "assistant", "tool")


def normal_messages(messages: Column) -> Column:
    """role in lower case, content trimmed ('' for null), known: whether the role is one of ROLES."""
    return F.transform(messages, lambda m: F.struct(F.lower(F.trim(m["role"])).alias("role"), F.trim(F.coalesce(m["content"], F.lit(""))).alias("content"), F.lower(F.trim(m["role"])).isin(*ROLES).alias("known")))


def running_ids(calls: Column, prefix: str = "call_") -> Column:
    """Calls with ids by their place: call_1, call_2 .."""
    return F.transform(calls, lambda c, i: F.struct(F.concat(F.lit(prefix), (i + 1).cast("string")).alias("id"), c["tool_name"].alias("name"), c["arguments"].alias("arguments")))


def bind_results(messages: Column) -> Column:
    """Tool results bound to waiting calls, first come first served, as struct(bound, orphans, waiting).

    A call is an assistant message without content. A result with no call waiting is an orphan. A fold with the
    queue as its state, so order decides.
    """
    empty = F.array().cast("array<int>")
    pairs = F.array().cast("array<struct<call:int,result:int>>")
    start = F.struct(empty.alias("queue"), pairs.alias("bound"), F.lit(0).alias("orphans"), F.lit(0).alias("i"))

    def step(acc: Column, m: Column) -> Column:
        is_call = (m["role"] == "assistant") & (F.length(F.trim(F.coalesce(m["content"], F.lit("")))) == 0)
        is_result = m["role"] == "tool"
        waits = F.size(acc["queue"]) > 0
        queue = F.when(is_call, F.array_append(acc["queue"], acc["i"])).when(is_result & waits, F.slice(acc["queue"], 2, F.greatest(F.size(acc["queue"]) - 1, F.lit(0)))).otherwise(acc["queue"])
        pair = F.struct(F.get(acc["queue"], 0).alias("call"), acc["i"].alias("result"))
        bound = F.when(is_result & waits, F.array_append(acc["bound"], pair)).otherwise(acc["bound"])
        return F.struct(queue.alias("queue"), bound.alias("bound"), (acc["orphans"] + (is_result & ~waits).cast("int")).alias("orphans"), (acc["i"] + 1).alias("i"))

    return F.aggregate(messages, start, step, lambda acc: F.struct(acc["bound"].alias("bound"), acc["orphans"].alias("orphans"), F.size(acc["queue"]).alias("waiting")))


def known_tools_only(df: DataFrame, tools: str, declared: str) -> DataFrame:
    """Rows all of whose tools are declared."""
    return df.filter(F.size(F.array_except(tools, declared)) == 0)


def occurrences(col: Column, literal: str) -> Column:
    return ((F.length(col) - F.length(F.replace(col, F.lit(literal), F.lit("")))) / len(literal)).cast("int")


def replace_once(col: Column, literal: str, new: str) -> Column:
    """The text with the literal replaced where it occurs exactly once, else null."""
    return F.when(occurrences(col, literal) == 1, F.replace(col, F.lit(literal), F.lit(new)))


def replace_exactly(col: Column, literal: str, new: str) -> Column:
    """The text with the literal replaced; a text in which it does not occur exactly once is an error."""
    found = occurrences(col, literal)
    wrong = F.raise_error(F.concat(F.lit(f"expected {literal!r} once, found it "), found.cast("string"), F.lit(" times")))
    return F.when(found == 1, F.replace(col, F.lit(literal), F.lit(new))).otherwise(wrong.cast("string"))


def add_seconds(clock: Column, seconds: Column) -> Column:
    """HH:MM:SS plus seconds; hours may exceed 24, as in timetables."""
    part = lambda i: F.split_part(clock, F.lit(":"), F.lit(i)).cast("long")
    t = part(1) * 3600 + part(2) * 60 + part(3) + seconds.cast("long")
    return F.format_string("%02d:%02d:%02d", F.floor(t / 3600), F.floor(F.pmod(t, F.lit(3600)) / 60), F.pmod(t, F.lit(60)))


def parents(children: DataFrame, child: str, parent: str, known: DataFrame, known_key: str) -> DataFrame:
    """Each child with its parent if that is known, else with itself."""
    k = known.select(F.col(known_key).alias("_k")).distinct()
    return children.join(k, F.col(parent) == F.col("_k"), "left").withColumn("station", F.coalesce(F.col("_k"), F.col(child))).drop("_k")


def closure(items: DataFrame, item: str, needs: str) -> DataFrame:
    """Items with what they need, one level, each once at its first place: (item, place). needs: an array; place: the row's order."""
    each = items.select(F.posexplode(F.concat(needs, F.array(item))).alias("_p", "_item"), "place")
    return each.groupBy(F.col("_item").alias(item)).agg(F.min(F.struct("place", "_p")).alias("_at")).select(item, F.col("_at.place").alias("place"))


def overlaid(base: DataFrame, overlay: DataFrame, keys: list[str], episode: str, value: str) -> DataFrame:
    """The base rows of the touched keys, per episode, with the overlay's value where it has one.

    Nothing is copied per episode but the touched rows.
    """
    touched = overlay.select(episode, keys[0]).distinct()
    o = overlay.select(episode, *keys, F.col(value).alias("_new"))
    return base.join(touched, keys[0]).join(o, [episode, *keys], "left").withColumn(value, F.coalesce("_new", value)).drop("_new")
