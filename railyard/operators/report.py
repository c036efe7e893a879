"""Aggregations of evaluation results."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from railyard.operators.predicates import accepted, band, band_cap, safe_ratio


def evaluation_by_group(df: DataFrame, group: str, ok: Column, turns: Column, calls: Column) -> DataFrame:
    """n, ok, yield and means per group."""
    out = df.groupBy(group).agg(
        F.count("*").alias("n"), F.count_if(ok).alias("ok"), F.sum(turns.cast("long")).alias("turns"), F.sum(calls.cast("long")).alias("calls")
    )
    return out.withColumns({"yield": safe_ratio(F.col("ok"), F.col("n")), "calls_per_row": safe_ratio(F.col("calls"), F.col("n"))})


def with_baseline(report: DataFrame, baseline: DataFrame, group: str, measure: str) -> DataFrame:
    """The report with the baseline's measure and the difference; both null where the baseline lacks the group."""
    base = baseline.select(group, F.col(measure).alias(f"base_{measure}"))
    return report.join(base, group, "left").withColumn("delta", F.col(measure) - F.col(f"base_{measure}"))


def band_caps(evaluated: DataFrame, leg: DataFrame, group: str, ok: Column) -> DataFrame:
    """Per group of the leg: how many were evaluated, the yield, its band and the cap; never evaluated counts as 0."""
    e = evaluated.groupBy(group).agg(F.count("*").alias("n_eval"), F.count_if(ok).alias("ok"))
    out = leg.groupBy(group).agg(F.count("*").alias("n_leg")).join(e, group, "left").na.fill(0, ["n_eval", "ok"])
    out = out.withColumn("yield", F.when(F.col("n_eval") > 0, F.col("ok") / F.col("n_eval")))
    out = out.withColumn("band", band(F.col("n_eval"), F.col("yield")))
    return out.withColumn("cap", band_cap(F.col("band")))


def subtotals(df: DataFrame, outer: str, inner: str, good: Column) -> DataFrame:
    """Counts by (outer, inner), by outer and in all; a ratio is sum over sum. level: 0, 1 and 3."""
    out = df.withColumn("_good", good.cast("long")).groupingSets([[F.col(outer), F.col(inner)], [F.col(outer)], []], outer, inner)
    return out.agg(F.grouping_id().alias("level"), F.count("*").alias("n"), F.sum("_good").alias("good")).withColumn("ratio", safe_ratio(F.col("good"), F.col("n")))


def weighted_mean(df: DataFrame, value: str, weight: str) -> DataFrame:
    total = F.sum(weight)
    return df.agg((F.sum(F.col(value) * F.col(weight)) / F.when(total != 0, total)).alias("weighted_mean"), total.alias("weight"))


def pass_hat_k(df: DataFrame, item: str, ok: Column, ks: tuple[int, ...]) -> DataFrame:
    """Mean over items of C(c, k) / C(n, k), c of n trials good; items with fewer than k trials are left out."""
    per = df.groupBy(item).agg(F.count("*").alias("n"), F.count_if(ok).alias("c"))
    columns = []
    for k in ks:
        p = F.lit(1.0)
        for i in range(k):
            p = p * F.greatest(F.col("c") - i, F.lit(0)) / F.greatest(F.col("n") - i, F.lit(1))
        columns += [F.avg(F.when(F.col("n") >= k, p)).alias(f"pass_hat_{k}"), F.count_if(F.col("n") >= k).alias(f"items_{k}")]
    return per.agg(*columns)


def histogram(df: DataFrame, value: Column, name: str) -> DataFrame:
    return df.groupBy(value.alias(name)).agg(F.count("*").alias("n"))


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Rows, distinct keys and the difference; a null is a value of a key. Combined before the shuffle."""
    per = df.groupBy(*keys).agg(F.count("*").alias("k"))
    return per.agg(F.sum("k").alias("n_rows"), F.count("*").alias("n_keys"), (F.sum("k") - F.count("*")).alias("n_duplicates"))


def shares(df: DataFrame, columns: list[str]) -> DataFrame:
    """Share of each value of each column, as rows (variant, value, n, share)."""
    pairs = F.explode(F.array(*(F.struct(F.lit(c).alias("variant"), F.coalesce(F.col(c).cast("string"), F.lit("None")).alias("value")) for c in columns))).alias("p")
    out = df.select(pairs).groupBy("p.variant", "p.value").agg(F.count("*").alias("n"))
    return out.withColumn("share", F.col("n") / F.sum("n").over(W.partitionBy("variant")))


def source_shares(df: DataFrame, source: str, size: str) -> DataFrame:
    """Share of the rows and of the size that each source has; over the grouped sums, a small table."""
    out = df.groupBy(source).agg(F.count("*").alias("n"), F.sum(size).alias("size"))
    everything = W.partitionBy(F.lit(1))
    return out.withColumns({"row_share": F.col("n") / F.sum("n").over(everything), "size_share": F.col("size") / F.sum("size").over(everything)})


def leaderboard(df: DataFrame, teacher: str) -> DataFrame:
    """Per teacher: yield by score alone, replan rate among injected rows, errors, seconds and good rows an hour."""
    ok = F.col("score") == 1.0
    out = df.groupBy(teacher).agg(
        F.count("*").alias("n"), F.count_if(ok).alias("ok"), F.count_if("injected").alias("n_injected"), F.count_if(F.col("injected") & F.col("replan")).alias("n_replan"),
        F.count_if(F.col("finish_reason").startswith("error")).alias("n_error"), F.sum(F.round(F.col("wall_s") * 1000).cast("long")).alias("wall_ms"),
    )
    return out.withColumns(
        {
            "yield": safe_ratio(F.col("ok"), F.col("n")), "replan_rate": safe_ratio(F.col("n_replan"), F.col("n_injected")), "seconds_per_row": F.col("wall_ms") / 1000.0 / F.col("n"),
            "ok_per_hour": F.col("ok") * 3600000.0 / F.greatest(F.lit(1), F.col("wall_ms")),
        }
    )


def accepted_trace() -> Column:
    return accepted(F.col("score"), F.col("truncated"))
