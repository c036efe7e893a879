"""Lookups, searches and schedule joins over operational tables. A batch of questions is one join, never a loop.

The read queries take (questions, tables); the parameters of a search are filters, of which one at least is needed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

PAGE = 10


def search_page(df: DataFrame, condition: Column, order: list[str], page: int = PAGE) -> DataFrame:
    """The first ``page`` hits by a total order with their number in all and whether more were left out.

    A top-k and a count: no task sorts all hits.
    """
    hits = df.filter(condition)
    top = hits.orderBy(*order).limit(page)
    place = F.row_number().over(W.partitionBy(F.lit(1)).orderBy(*order))
    total = hits.agg(F.count("*").alias("total"))
    return top.withColumn("place", place).crossJoin(F.broadcast(total)).withColumn("more", F.col("total") > page)  # one row on the right


def deduped(df: DataFrame, keys: list[str]) -> DataFrame:
    """One row per key, the smallest by all its columns."""
    rest = [c for c in df.columns if c not in keys]
    return df.groupBy(*keys).agg(F.min(F.struct(*rest)).alias("_r")).select(*keys, "_r.*")


def schedules(stops: DataFrame, trip: str, seq: str, *columns: str) -> DataFrame:
    """Per trip its stops in order, as one array; a trip's stops are few."""
    return stops.groupBy(trip).agg(F.array_sort(F.collect_list(F.struct(seq, *columns))).alias("stops"))


def worst(stops: DataFrame, trip: str, seq: str, delay: str) -> DataFrame:
    """Per trip the largest delay and where it is first reached."""
    best = F.max_by(F.struct(seq, delay), F.struct(F.col(delay), -F.col(seq)))
    return stops.groupBy(trip).agg(best.alias("_b")).select(trip, F.col(f"_b.{seq}").alias("at_seq"), F.col(f"_b.{delay}").alias("delay"))


def transfers(stops: DataFrame, pairs: DataFrame, least: int) -> DataFrame:
    """For asked pairs (feeder, connector): shared stations with the buffer in minutes and whether it is enough.

    stops: trip, station, arr, dep (minutes of the day). Each side is taken mod a day, their difference is not.
    """
    a = stops.select(F.col("trip").alias("feeder"), "station", F.pmod("arr", F.lit(1440)).alias("a"))
    b = stops.select(F.col("trip").alias("connector"), "station", F.pmod("dep", F.lit(1440)).alias("d"))
    met = pairs.join(a, "feeder").join(b, ["connector", "station"])
    return met.withColumn("buffer", F.col("d") - F.col("a")).withColumn("fits", F.col("buffer") >= least).drop("a", "d")


def transfer_pairs(stops: DataFrame, key: str, ident: str, at: str, low: int, high: int, slot: int) -> DataFrame:
    """Per feeder the earliest connection at the same place that leaves low..high seconds later, ties to the smallest id.

    A range join as an equi-join: both sides are put into slots of ``slot`` >= high seconds, a feeder asks
    its own slot and the next; so the work follows the hits, and a place with many stops is spread over its slots.
    """
    if slot < high:
        raise ValueError("a slot must be at least as long as the longest wait")
    t = F.unix_seconds(F.col(at).cast("timestamp"))
    a = stops.select(F.col(key), F.col(ident).alias("feeder"), t.alias("_ta")).withColumn("_slot", F.explode(F.array(F.expr(f"_ta div {slot}"), F.expr(f"_ta div {slot} + 1"))))
    b = stops.select(F.col(key), F.col(ident).alias("connector"), t.alias("_tb")).withColumn("_slot", F.expr(f"_tb div {slot}"))
    met = a.join(b, [key, "_slot"]).filter((F.col("_tb") - F.col("_ta")).between(low, high) & (F.col("feeder") != F.col("connector")))
    best = F.min(F.struct("_tb", "connector", (F.col("_tb") - F.col("_ta")).alias("wait")))
    return met.groupBy("feeder", key).agg(best.alias("_b"), F.count("*").alias("options")).select("feeder", key, "_b.connector", "_b.wait", "options")


def representatives(df: DataFrame, group: str, member: str) -> DataFrame:
    """Per group its two smallest distinct members and the number of members."""
    m = df.select(group, member).distinct()
    g = m.groupBy(group).agg(F.min(member).alias("first"), F.count("*").alias("members"))
    second = m.join(g.select(group, "first"), group).filter(F.col(member) != F.col("first")).groupBy(group).agg(F.min(member).alias("second"))
    return g.join(second, group, "left")


def unique_in_group(df: DataFrame, group: list[str], value: str, most: int) -> DataFrame:
    """Rows of groups of at most ``most`` rows whose value is the only one of its kind in the group.

    Counted before the join back, so a large group costs one row, not a window.
    """
    sizes = df.groupBy(*group).agg(F.count("*").alias("_n")).filter(F.col("_n") <= most).drop("_n")
    alone = df.groupBy(*group, value).agg(F.count("*").alias("_k")).filter("_k = 1").drop("_k")
    return df.join(sizes, group, "left_semi").join(alone, [*group, value], "left_semi")


def filter_combinations(df: DataFrame, dims: list[str], low: int, high: int) -> DataFrame:
    """Value combinations of filters that leave low to high hits."""
    return df.groupBy(*dims).agg(F.count("*").alias("hits")).filter(F.col("hits").between(low, high))


def calendar(base: DataFrame, exceptions: DataFrame) -> DataFrame:
    """Service days: the base days, with the last exception of a (service, day) deciding. exceptions: service, day, kind, ord."""
    last = exceptions.groupBy("service", "day").agg(F.max_by("kind", "ord").alias("kind"))
    kept = base.join(last.filter("kind = 'remove'"), ["service", "day"], "left_anti")
    return kept.select("service", "day").union(last.filter("kind = 'add'").select("service", "day")).distinct()


def position(stops: DataFrame, trip: str, seq: str, at: Column) -> DataFrame:
    """Segment of the schedule that holds the moment, and the share of it that is done; segment 0 if none does.

    stops: trip, seq, t; a trip's stops are few, so the window is bounded.
    """
    w = W.partitionBy(trip).orderBy(seq)
    s = stops.withColumn("_next", F.lead("t").over(w)).withColumn("_i", F.row_number().over(w) - 1)
    inside = (F.col("t") <= at) & (at < F.col("_next"))
    share = F.bround(F.least(F.greatest((at - F.col("t")) / F.nullif(F.col("_next") - F.col("t"), F.lit(0)), F.lit(0.0)), F.lit(1.0)), 5)
    g = s.groupBy(trip).agg(F.min(F.when(inside, F.struct(F.col("_i").alias("segment"), share.alias("share")))).alias("_p"), F.count("*").alias("n_stops"))
    return g.select(trip, "n_stops", F.coalesce("_p.segment", F.lit(0)).alias("segment"), F.coalesce("_p.share", F.lit(0.0)).alias("share"))


def resolve(questions: DataFrame, asked: str, direct: DataFrame, alias: DataFrame) -> DataFrame:
    """An id as it is, else through an alias (case-insensitive, trimmed); null where neither knows it. direct: id; alias: alias, id."""
    q = questions.withColumn("_k", F.lower(F.trim(F.col(asked))))
    d = direct.select(F.lower("id").alias("_k"), F.col("id").alias("_direct"))
    a = alias.groupBy(F.lower(F.trim("alias")).alias("_k")).agg(F.min("id").alias("_alias"))
    return q.join(d, "_k", "left").join(a, "_k", "left").withColumn("id", F.coalesce("_direct", "_alias")).drop("_k", "_direct", "_alias")
