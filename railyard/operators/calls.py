"""Matching of tool calls: exact and lenient, as sequences and as bags, and the verdicts drawn from that."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from railyard.functions.values import bag_match, normal_call


def normal_scalar(col: Column) -> Column:
    """Trimmed text; true/false and numbers in one notation ('5', 5 and 5.0 are equal)."""
    t = F.trim(col)
    number = F.when(t.rlike(r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"), t.try_cast("double"))
    return F.when(F.lower(t).isin("true", "false"), F.lower(t)).when(number.isNotNull(), number.cast("string")).otherwise(t)


def arguments_map(col: Column) -> Column:
    """The object as a map of its values' texts; an empty map for anything that is no object."""
    m = F.from_json(col, "map<string,string>")
    return F.coalesce(m, F.expr("cast(map() as map<string,string>)"))


def lenient(gold: Column, got: Column) -> Column:
    """Every key of the gold arguments has an equal value in the other's; a missing key equals a null."""
    return F.forall(F.map_keys(gold), lambda k: normal_scalar(F.try_element_at(gold, k)).eqNullSafe(normal_scalar(F.try_element_at(got, k))))


def exact(gold: Column, got: Column) -> Column:
    return lenient(gold, got) & (F.array_sort(F.map_keys(gold)) == F.array_sort(F.map_keys(got)))


def same_bag(a: Column, b: Column) -> Column:
    return F.array_sort(a) == F.array_sort(b)


def verdict(gold_tools: Column, got_tools: Column, args_equal: Column, text: Column) -> Column:
    """First that holds of: irrelevance_ok, irrelevance_called, silent, asked_back, missing_call, wrong_tool, exact, wrong_args.

    One call too many counts as wrong_tool, as the names no longer match as bags.
    """
    none_wanted, none_got = F.size(gold_tools) == 0, F.size(got_tools) == 0
    missing = (F.size(got_tools) < F.size(gold_tools)) & (F.size(F.array_except(got_tools, gold_tools)) == 0)
    return (
        F.when(none_wanted & none_got, "irrelevance_ok").when(none_wanted, "irrelevance_called")
        .when(none_got & (F.length(F.trim(F.coalesce(text, F.lit("")))) == 0), "silent").when(none_got, "asked_back")
        .when(missing, "missing_call").when(~same_bag(gold_tools, got_tools), "wrong_tool").when(args_equal, "exact").otherwise("wrong_args")
    )


def bag_verdicts(pairs: DataFrame) -> DataFrame:
    """pairs: key, gold, got (arrays of (tool, arguments json)); equality of values is deep and free of order."""

    @F.pandas_udf("struct<exact boolean, lenient boolean>")
    def match(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        for gold, got in batches:
            rows = []
            for a, b in zip(gold, got):
                x, y = ([normal_call(c["tool_name"], c["arguments"]) for c in calls] for calls in (a, b))
                rows.append((bag_match(x, y, True), bag_match(x, y, False)))
            yield pd.DataFrame(rows, columns=["exact", "lenient"])

    return pairs.withColumn("m", match("gold", "got")).select("key", "m.exact", "m.lenient")
