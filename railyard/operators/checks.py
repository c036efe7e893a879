"""Data checks: one aggregate pass, then one row per check (name, level, passed, detail)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def suite(df: DataFrame, bad: dict[str, tuple[str, Column, float]]) -> DataFrame:
    """bad: check -> (level fail, warn or info; what a bad row is; largest share of bad rows that passes)."""
    counts = df.agg(F.count("*").alias("_n"), *(F.count_if(F.coalesce(c, F.lit(True))).alias(k) for k, (_, c, _) in bad.items()))
    rows = [
        F.struct(
            F.lit(k).alias("name"), F.lit(level).alias("level"), (F.col(k) <= F.col("_n") * most).alias("passed"), F.col(k).alias("n_bad"), F.col("_n").alias("n_rows")
        ) for k, (level, _, most) in bad.items()
    ]
    return counts.select(F.explode(F.array(*rows)).alias("c")).select("c.*")


def references(child: DataFrame, key: str, parent: DataFrame, parent_key: str, alias_of=None) -> DataFrame:
    """How each key of the child resolves: as it is, by its normal form, or not at all; counts."""
    p = parent.select(F.col(parent_key).alias("_p")).distinct()
    c = child.groupBy(F.col(key).alias("_c")).agg(F.count("*").alias("_n"))
    out = c.join(p, F.col("_c") == F.col("_p"), "left")
    how = F.when(F.col("_p").isNotNull(), "direct")
    if alias_of is not None:
        q = p.select(alias_of(F.col("_p")).alias("_q")).distinct()
        out = out.join(q, alias_of(F.col("_c")) == F.col("_q"), "left")
        how = how.when(F.col("_q").isNotNull(), "by_normal_form")
    return out.groupBy(how.otherwise("unresolved").alias("how")).agg(F.count("*").alias("n_keys"), F.sum("_n").alias("n_rows"))


def orphans(parent: DataFrame, parent_key: str, child: DataFrame, key: str) -> DataFrame:
    return parent.join(child.select(F.col(key).alias(parent_key)).distinct(), parent_key, "left_anti")


def drifted(counts: DataFrame, value: str, expected: str, tolerance: float = 0.1) -> DataFrame:
    """Rows whose value is off the expected one by more than the tolerance."""
    return counts.filter(F.abs(F.col(value) - F.col(expected)) > F.col(expected) * tolerance)


def fingerprint(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """One digest of a table, whatever the order of its rows.

    Rows are hashed, equal hashes counted, and digests made by bucket of the hash's first two digits before the
    last one over the 256 buckets, so no task holds all hashes.
    """
    cols = sorted(columns or df.columns)
    row = F.sha2(F.concat_ws("\x1f", *(F.concat(F.lit(c), F.lit("="), F.coalesce(F.col(c).cast("string"), F.lit("\\N"))) for c in cols)), 256)
    counted = df.groupBy(row.alias("_h")).agg(F.count("*").alias("_k"))
    parts = counted.groupBy(F.substring("_h", 1, 2).alias("_b")).agg(
        F.sha2(F.array_join(F.array_sort(F.collect_list(F.concat_ws(":", "_h", F.col("_k").cast("string")))), ","), 256).alias("_d"), F.sum("_k").alias("_n")
    )
    return parts.agg(F.substring(F.sha2(F.array_join(F.array_sort(F.collect_list(F.concat_ws(":", "_b", "_d"))), ","), 256), 1, 16).alias("digest"), F.sum("_n").alias("n_rows"))


def uniqueness(df: DataFrame, key: list[str], name: str) -> DataFrame:
    per = df.groupBy(*key).agg(F.count("*").alias("_k"))
    return per.agg(F.lit(name).alias("name"), F.lit("fail").alias("level"), (F.count_if(F.col("_k") > 1) == 0).alias("passed"), F.sum(F.col("_k") - 1).alias("n_bad"), F.sum("_k").alias("n_rows"))
