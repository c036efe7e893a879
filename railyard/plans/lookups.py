"""Further lookups and joins over the operational tables: order = trip or work order, line = stop, supplier = station, event = call at a place."""

from __future__ import annotations

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from railyard.core import table
from railyard.operators import world as op
from railyard.operators.predicates import conjunction, contains_folded
from railyard.plans.registry import query
from railyard.plans.world import STOPS, stops


@query("work_list", """with h as (select o_orderkey, o_orderstatus, o_orderpriority, strftime(o_orderdate, '%Y-%m-%d') as due, c_name from orders join customer on o_custkey = c_custkey
  where o_orderstatus = 'O' and contains(lower(c_name), lower(trim(' 00 '))) and strftime(o_orderdate, '%Y-%m-%d') < '2000-01-01' and lower(o_orderpriority) = lower('1-urgent'))
select *, count(*) over () as total, row_number() over (order by due, o_orderkey)::int as place, count(*) over () > 10 as more from h order by due, o_orderkey limit 10""")
def work_list(spark, sf):
    """Open work by status (case counts), place (part of the name), due date and severity (case does not count)."""
    c = table(spark, sf, "customer").select("c_custkey", "c_name")
    h = table(spark, sf, "orders").join(c, F.col("o_custkey") == F.col("c_custkey")).select("o_orderkey", "o_orderstatus", "o_orderpriority", F.date_format("o_orderdate", "yyyy-MM-dd").alias("due"), "c_name")
    where = conjunction({"status": F.col("o_orderstatus") == "O", "place": contains_folded(F.col("c_name"), " 00 "), "due": F.col("due") < "2000-01-01", "severity": F.lower("o_orderpriority") == "1-urgent"})
    return op.search_page(h.filter(where), F.lit(True), ["due", "o_orderkey"])


@query("delay_cause", f"""with {STOPS}, w as (select l_orderkey, arg_max(struct_pack(seq := l_linenumber, cause := l_returnflag, remark := l_linestatus), (l_quantity, -l_linenumber)) as r, max(l_quantity) as late from stops group by l_orderkey)
select o_orderkey, floor(coalesce(late, 0) * 60 / 60)::bigint as minutes, coalesce(r.cause, '') as cause, coalesce(r.remark, '') as remark from orders left join w on o_orderkey = l_orderkey""")
def delay_cause(spark, sf):
    """The worst delay of a trip in minutes, with its cause and remark; 0 and none for a trip without stops."""
    best = F.max_by(F.struct("l_quantity", "l_returnflag", "l_linestatus"), F.struct("l_quantity", -F.col("l_linenumber")))
    w = stops(spark, sf).groupBy("l_orderkey").agg(best.alias("r"))
    o = table(spark, sf, "orders").select("o_orderkey").join(w, F.col("o_orderkey") == F.col("l_orderkey"), "left")
    text = lambda c: F.coalesce(c, F.lit(""))
    return o.select("o_orderkey", F.floor(F.coalesce("r.l_quantity", F.lit(0.0)) * 60 / 60).alias("minutes"), text(F.col("r.l_returnflag")).alias("cause"), text(F.col("r.l_linestatus")).alias("remark"))


@query("under_way", f"""with {STOPS}, t as (select l_orderkey, l_linenumber * 10 + l_partkey % 7 as t, l_suppkey from stops)
select o_orderkey, case when min(t) <= 35 and max(t) > 35 then 'under way' else 'not under way' end as state, arg_max(l_suppkey, t) filter (t <= 35 and l_suppkey is not null) as last_station
from orders left join t on o_orderkey = l_orderkey group by o_orderkey""")
def under_way(spark, sf):
    """Whether a trip is between its first and last stop, and the station it has left or reached last."""
    t = F.col("l_linenumber") * 10 + F.col("l_partkey") % 7
    s = stops(spark, sf).select("l_orderkey", t.alias("t"), "l_suppkey")
    g = s.groupBy("l_orderkey").agg(F.min("t").alias("since"), F.max("t").alias("until"), F.max_by("l_suppkey", F.when(F.col("t") <= 35, F.col("t"))).alias("last_station"))
    o = table(spark, sf, "orders").select("o_orderkey").join(g, F.col("o_orderkey") == F.col("l_orderkey"), "left")
    state = F.when((F.col("since") <= 35) & (F.col("until") > 35), "under way").otherwise("not under way")
    return o.select("o_orderkey", state.alias("state"), F.when(F.col("since") <= 35, F.col("last_station")).alias("last_station"))


@query("late_trips", f"""with {STOPS}, d as (select l_orderkey, max(l_quantity) as late from stops group by l_orderkey),
h as (select o_orderkey, o_orderpriority, late from orders join d on o_orderkey = l_orderkey where late >= 49 and lower(o_orderpriority) = lower('5-LOW'))
select *, count(*) over () as total, row_number() over (order by late desc, o_orderkey)::int as place, count(*) over () > 10 as more from h order by late desc, o_orderkey limit 10""")
def late_trips(spark, sf):
    """A search with a least delay, which is aggregated before the join."""
    d = stops(spark, sf).groupBy("l_orderkey").agg(F.max("l_quantity").alias("late")).filter("late >= 49")
    h = table(spark, sf, "orders").filter(F.lower("o_orderpriority") == "5-low").select("o_orderkey", "o_orderpriority").join(d, F.col("o_orderkey") == F.col("l_orderkey")).drop("l_orderkey")
    return op.search_page(h.withColumn("_order", -F.col("late")), F.lit(True), ["_order", "o_orderkey"]).drop("_order")


@query("shift_cover", """with s as (select user_id, ts::date as day, min(strftime(ts, '%H:%M')) as since, max(strftime(ts, '%H:%M')) as until from events group by all)
select user_id, strftime(day, '%Y-%m-%d') as day, since, until from s where '12:30' between since and until""")
def shift_cover(spark, sf):
    """Shifts that cover a moment; HH:MM texts compare as times."""
    at = F.date_format("ts", "HH:mm")
    s = table(spark, sf, "events").groupBy("user_id", F.date_format("ts", "yyyy-MM-dd").alias("day")).agg(F.min(at).alias("since"), F.max(at).alias("until"))
    return s.filter(F.lit("12:30").between(F.col("since"), F.col("until")))


@query("station_places", """with p as (select n_nationkey, n_regionkey::double as place from nation where n_regionkey < 3), f as (select s_nationkey, arg_min(s_acctbal, s_suppkey) as place from supplier group by s_nationkey)
select s_suppkey, coalesce(p.place, f.place) as place, p.n_nationkey is null as from_child from supplier s left join p on s.s_nationkey = p.n_nationkey left join f on f.s_nationkey = s.s_nationkey""")
def station_places(spark, sf):
    """The place of a station's parent; where the parent has no row of its own, that of its first child."""
    s = table(spark, sf, "supplier")
    p = table(spark, sf, "nation").filter("n_regionkey < 3").select(F.col("n_nationkey").alias("s_nationkey"), F.col("n_regionkey").cast("double").alias("own"))
    first = s.groupBy("s_nationkey").agg(F.min_by("s_acctbal", "s_suppkey").alias("child"))
    return s.join(p, "s_nationkey", "left").join(first, "s_nationkey", "left").select("s_suppkey", F.coalesce("own", "child").alias("place"), F.col("own").isNull().alias("from_child"))


@query("inner_transfers", f"""with {STOPS}, s as (select l_orderkey as trip, l_suppkey as station, l_linenumber as seq, l_partkey % 1440 as t, min(l_linenumber) over w as lo, max(l_linenumber) over w as hi from stops window w as (partition by l_orderkey)),
m as (select a.trip as feeder, a.station, b.trip as connector, a.t as arr, b.t - a.t as buffer from s a join s b on a.station = b.station and a.trip <> b.trip and b.t - a.t between 8 and 45 where a.seq > a.lo and b.seq < b.hi)
select feeder, arg_min(station, (arr, connector, station, buffer)) as station, arg_min(connector, (arr, connector, station, buffer)) as connector, arg_min(buffer, (arr, connector, station, buffer)) as buffer, count(*) as options from m group by feeder""")
def inner_transfers(spark, sf):
    """Per feeder the earliest arrival at which a connection leaves 8 to 45 minutes later at the same station, ties to the smallest
    connector; not at the feeder's first stop nor at the connector's last. A range join by slots of 45 minutes."""
    s = stops(spark, sf)
    ends = s.groupBy("l_orderkey").agg(F.min("l_linenumber").alias("lo"), F.max("l_linenumber").alias("hi"))
    s = s.join(ends, "l_orderkey").select(F.col("l_orderkey").alias("trip"), F.col("l_suppkey").alias("station"), F.col("l_linenumber").alias("seq"), (F.col("l_partkey") % 1440).alias("t"), "lo", "hi")
    slot = F.expr("t div 45")
    a = s.filter("seq > lo").select(F.col("trip").alias("feeder"), "station", F.col("t").alias("arr"), F.explode(F.array(slot, slot + 1)).alias("slot"))
    b = s.filter("seq < hi").select(F.col("trip").alias("connector"), "station", F.col("t").alias("dep"), slot.alias("slot"))
    m = a.join(b, ["station", "slot"]).filter("feeder <> connector and dep - arr between 8 and 45")
    best = F.min(F.struct("arr", "connector", "station", (F.col("dep") - F.col("arr")).alias("buffer")))
    return m.groupBy("feeder").agg(best.alias("b"), F.count("*").alias("options")).select("feeder", "b.station", "b.connector", "b.buffer", "options")


@query("cutoff_combos", """with c as (select unnest(['1997-01-01', '1999-01-01', '2001-01-01']) as cutoff), v as (select distinct o_orderstatus, o_orderpriority from orders)
select o_orderstatus, o_orderpriority, cutoff, (select count(*) from orders o where o.o_orderstatus = v.o_orderstatus and o.o_orderpriority = v.o_orderpriority and strftime(o.o_orderdate, '%Y-%m-%d') < cutoff) as hits from v cross join c""")
def cutoff_combos(spark, sf):
    """Hits of each combination of filter values and cutoffs, those without any too.

    Counted once by value and span between cutoffs; a combination's hits are the sum over the spans before its cutoff.
    """
    cutoffs = ["1997-01-01", "1999-01-01", "2001-01-01"]
    due = F.date_format("o_orderdate", "yyyy-MM-dd")
    span = sum((F.when(due >= c, 1).otherwise(0) for c in cutoffs), F.lit(0))
    n = table(spark, sf, "orders").groupBy("o_orderstatus", "o_orderpriority", span.alias("span")).agg(F.count("*").alias("n"))
    sums = F.array(*(F.struct(F.lit(c).alias("cutoff"), F.sum(F.when(F.col("span") <= i, F.col("n")).otherwise(0)).alias("hits")) for i, c in enumerate(cutoffs)))
    return n.groupBy("o_orderstatus", "o_orderpriority").agg(sums.alias("s")).select("o_orderstatus", "o_orderpriority", F.explode("s").alias("x")).select("o_orderstatus", "o_orderpriority", "x.*")


@query("skill_combos", """with x as (select c_mktsegment, unnest([lower(n_name), case when c_acctbal < 0 then 'debt' else 'credit' end]) as skill from customer join nation on c_nationkey = n_nationkey)
select c_mktsegment, skill, count(*) as n from x group by all""")
def skill_combos(spark, sf):
    """Counts by a column and each element of an array."""
    n = F.broadcast(table(spark, sf, "nation").select(F.col("n_nationkey").alias("c_nationkey"), "n_name"))  # 25 rows, fixed
    skills = F.array(F.lower("n_name"), F.when(F.col("c_acctbal") < 0, "debt").otherwise("credit"))
    return table(spark, sf, "customer").join(n, "c_nationkey").select("c_mktsegment", F.explode(skills).alias("skill")).groupBy("c_mktsegment", "skill").agg(F.count("*").alias("n"))


@query("first_words", "select split_part(trim(p_type), ' ', 1) as product, count(*) as n, min(p_partkey) as first from part group by 1")
def first_words(spark, sf):
    return table(spark, sf, "part").groupBy(F.split_part(F.trim("p_type"), F.lit(" "), F.lit(1)).alias("product")).agg(F.count("*").alias("n"), F.min("p_partkey").alias("first"))


@query("first_match", "select lower(trim(p_brand)) as brand, min(p_partkey) as p_partkey, arg_min(p_name, p_partkey) as p_name from part group by 1")
def first_match(spark, sf):
    """Lookup by a secondary key without regard to case: the first row that has it."""
    return table(spark, sf, "part").groupBy(F.lower(F.trim("p_brand")).alias("brand")).agg(F.min("p_partkey").alias("p_partkey"), F.min_by("p_name", "p_partkey").alias("p_name"))


@query("best_of_group", "select s_nationkey, s_suppkey, s_acctbal, row_number() over (partition by s_nationkey order by s_acctbal desc, s_suppkey)::int as place from supplier qualify row_number() over (partition by s_nationkey order by s_acctbal desc, s_suppkey) <= 3")
def best_of_group(spark, sf):
    """The three best of each group, ties by key; each task keeps three rows of a group before they meet."""
    w = W.partitionBy("s_nationkey").orderBy(F.desc("s_acctbal"), "s_suppkey")
    return table(spark, sf, "supplier").select("s_nationkey", "s_suppkey", "s_acctbal", F.row_number().over(w).alias("place")).filter("place <= 3")
