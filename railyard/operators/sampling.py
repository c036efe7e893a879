"""Deterministic samples, splits and caps. Every draw ranks by a hash of (seed, key), so it depends on the rows alone."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from railyard.core import checkpointed

def draw(seed: str, key: Column | str) -> Column:
    """Hex digest that orders the rows at random; equal to sha256 of 'seed|key' anywhere else."""
    return F.sha2(F.concat(F.lit(f"{seed}|"), (F.col(key) if isinstance(key, str) else key).cast("string")), 256)


def hashed_rank(df: DataFrame, group: list[str], digest: Column, name: str) -> DataFrame:
    """``df`` with the place (from 1) of each row in its group by a hex digest, and the size of the group.

    No group is sorted in one task: its rows are cut into 256 slices by the digest's first byte, ranked within
    their slice, and moved by the number of rows in the slices before. One shuffle serves rank and join.
    """
    rows = df.withColumn("_digest", digest).withColumn("_slice", F.substring("_digest", 1, 2))
    sizes = rows.groupBy(*group, "_slice").agg(F.count("*").alias("_n"))
    w = W.partitionBy(*group)
    before = F.sum("_n").over(w.orderBy("_slice").rowsBetween(W.unboundedPreceding, -1))
    sizes = sizes.select(*(F.col(g).alias(f"_g{i}") for i, g in enumerate(group)), F.col("_slice").alias("_s"), F.coalesce(before, F.lit(0)).alias("_before"), F.sum("_n").over(w).alias(f"{name}_of"))
    same = F.col("_slice") == F.col("_s")
    for i, g in enumerate(group):
        same = same & F.col(g).eqNullSafe(F.col(f"_g{i}"))
    within = F.row_number().over(W.partitionBy(*group, "_slice").orderBy("_digest"))
    out = rows.withColumn("_within", within).join(sizes, same)
    return out.withColumn(name, F.col("_within") + F.col("_before")).drop("_digest", "_slice", "_s", "_before", "_within", *(f"_g{i}" for i in range(len(group))))


def draw_unit(seed: str, key: Column | str) -> Column:
    """The draw as a number in [0, 1)."""
    return F.conv(F.substring(draw(seed, key), 1, 13), 16, 10).cast("long") / F.lit(float(16**13))


def with_caps(df: DataFrame, caps: DataFrame, group: str, cap: str) -> DataFrame:
    """``df`` with the cap of its group, null for no limit; a group that the caps do not name is an error."""
    c = caps.select(F.col(group).alias("_g"), F.col(cap).alias("_cap"), F.lit(True).alias("_known"))
    out = df.join(c, F.col(group).eqNullSafe(F.col("_g")), "left")
    missing = F.raise_error(F.concat(F.lit(f"no cap for {group} "), F.coalesce(F.col(group).cast("string"), F.lit("null"))))
    return out.withColumn(cap, F.when(F.col("_known").isNull(), missing.cast(caps.schema[cap].dataType)).otherwise(F.col("_cap"))).drop("_g", "_cap", "_known")


def uniform_sample(df: DataFrame, key: str, n: int, seed: str) -> DataFrame:
    """n rows of the whole by hash; each task keeps n rows before they meet."""
    return df.withColumn("_draw", draw(seed, key)).orderBy("_draw").limit(n).drop("_draw")


def capped_stratified(df: DataFrame, group: str, strata: list[str], cap: str, key: str, seed: str) -> DataFrame:
    """Rows of each group up to its cap, in proportion to its strata.

    Seats of a stratum are floor(cap * size / group size); seats left go one each to the smallest strata (ties
    by the strata's values); inside a stratum rows are drawn by hash. A null cap keeps all. The seats are
    planned on the counts, a table of groups x strata; only the last step ranks rows, by stratum.
    """
    sizes = df.groupBy(group, cap, *strata).agg(F.count("*").alias("_size"))
    w = W.partitionBy(group)
    plan = sizes.withColumn("_n", F.sum("_size").over(w)).withColumn("_floor", F.expr(f"{cap} * _size div _n"))
    plan = plan.withColumn("_left", F.col(cap) - F.sum("_floor").over(w)).withColumn("_rank", F.row_number().over(w.orderBy("_size", *strata)))
    over = F.col("_n") > F.col(cap)
    seats = F.when(over, F.col("_floor") + (F.col("_rank") <= F.col("_left")).cast("int")).otherwise(F.col("_size"))
    plan = plan.withColumn("_seats", seats).select(group, *strata, "_seats", (F.coalesce(over, F.lit(False)) & (F.col("_seats") < F.col("_size"))).alias("_cut"))
    rows = checkpointed(df.join(plan, [group, *strata]))  # read for the whole groups, the slices and the draw
    whole = rows.filter(~F.col("_cut"))
    cut = hashed_rank(rows.filter("_cut"), [group, *strata], draw(seed, key), "_rank").filter("_rank <= _seats").drop("_rank", "_rank_of")
    return whole.unionByName(cut).drop("_seats", "_cut")


def uniform_splits(df: DataFrame, group: str, key: str, seed: str, held_out: int = 10, rl: int = 20) -> DataFrame:
    """Per group the first held_out rows by hash, the next rl, the rest; ``is_dev`` marks the first of the rest."""
    out = hashed_rank(df, [group], draw(seed, key), "_place")
    split = F.when(F.col("_place") <= held_out, "heldout_eval").when(F.col("_place") <= held_out + rl, "rl_train").otherwise("sft_train")
    return out.withColumn("split", split).withColumn("is_dev", F.col("_place") == held_out + rl + 1).drop("_place", "_place_of")


def hold_out(df: DataFrame, source: str, key: str, seed: str, fraction: float) -> DataFrame:
    """Marks round-half-even(n * fraction) rows of each source as ``val``, those first by hash, the others as ``train``."""
    out = hashed_rank(df, [source], draw(seed, key), "_place")
    return out.withColumn("part", F.when(F.col("_place") <= F.bround(F.col("_place_of") * fraction, 0), "val").otherwise("train")).drop("_place", "_place_of")


def per_class_limit(df: DataFrame, cls: str, key: str, seed: str, limits: dict[str, int]) -> DataFrame:
    """At most limits[class] rows of each class by hash; classes without a limit stay whole."""
    limited = df.filter(F.col(cls).isin(*limits))
    most = F.create_map(*(F.lit(x) for p in limits.items() for x in p))[F.col(cls)]
    return hashed_rank(limited, [cls], draw(seed, key), "_place").filter(F.col("_place") <= most).drop("_place", "_place_of").unionByName(df.filter(~F.coalesce(F.col(cls).isin(*limits), F.lit(False))))


def round_robin(df: DataFrame, group: str, key: str, n: int) -> DataFrame:
    """The first n rows when one row of each group is taken in turn, groups by name, rows by key."""
    place = F.row_number().over(W.partitionBy(group).orderBy(key))  # each task keeps n rows of a group before the shuffle
    return df.withColumn("turn", place).filter(F.col("turn") <= n).orderBy("turn", group, key).limit(n)


def biased_pool(df: DataFrame, key: str, weak: Column, fault: Column, n: int, seed: str) -> DataFrame:
    """n rows: up to half of them weak, then fault rows up to n, topped up with the rest; ``origin`` tells which.

    Two top-n selections by (class, hash) instead of one global window.
    """
    rows = df.withColumn("_draw", draw(seed, key)).withColumn("_weak", F.coalesce(weak, F.lit(False))).withColumn("_fault", F.coalesce(fault, F.lit(False)))
    first = rows.filter("_weak").orderBy("_draw").limit(n // 2)
    others = rows.join(first.select(key), key, "left_anti").withColumn("_class", F.when(F.col("_fault"), 1).otherwise(2))
    both = first.withColumn("_class", F.lit(0)).unionByName(others.orderBy("_class", "_draw").limit(n))
    picked = both.orderBy("_class", "_draw").limit(n)
    return picked.withColumn("origin", F.when(F.col("_class") == 0, "weak").when(F.col("_class") == 1, "fault").otherwise("rest")).drop("_draw", "_weak", "_fault", "_class")


def bernoulli(df: DataFrame, key: str, rate: Column | float, seed: str) -> DataFrame:
    return df.filter(draw_unit(seed, key) < rate)


def dedupe_then_draw(df: DataFrame, entity: list[str], eligible: Column, group: str, key: str, n: int, seed: str) -> DataFrame:
    """n eligible rows of each group by hash, no two of one entity (the first by hash holds).

    The same as walking a shuffled pool, skipping ineligible and repeated ones, since eligibility is row-local.
    """
    rows = df.filter(eligible).withColumn("_draw", draw(seed, key))
    one = rows.groupBy(*entity).agg(F.min_by(F.struct(*rows.columns), F.struct("_draw", key)).alias("r")).select("r.*")
    return hashed_rank(one, [group], F.col("_draw"), "_place").filter(F.col("_place") <= n).drop("_draw", "_place", "_place_of")


def disjoint_batches(df: DataFrame, group: str, key: str, size: int, seed: str) -> DataFrame:
    """Numbers disjoint batches of ``size`` rows in each group by hash; a short tail is dropped, as it is no batch."""
    rows = hashed_rank(df, [group], draw(seed, key), "_place")
    return rows.withColumn("batch", F.expr(f"(_place - 1) div {size}")).filter(F.expr(f"batch < _place_of div {size}")).drop("_place", "_place_of")
