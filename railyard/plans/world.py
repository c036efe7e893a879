"""Lookups, searches, transfers and pools over the operational star schema: order = trip, line = stop, supplier = station."""

from __future__ import annotations

from pyspark.sql import functions as F

from railyard.core import table
from railyard.operators import world as op
from railyard.operators.predicates import conjunction, contains_folded
from railyard.plans.registry import query

#: (l_orderkey, l_linenumber) is not unique: the smallest row by all columns holds.
STOPS = """stops as (select * from lineitem qualify row_number() over (partition by l_orderkey, l_linenumber
  order by l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate) = 1)"""


def stops(spark, sf):
    return op.deduped(table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"), ["l_orderkey", "l_linenumber"])


@query("search_page", """with h as (select o_orderkey, o_totalprice, o_orderpriority, c_name, n_name from orders join customer on o_custkey = c_custkey join nation on c_nationkey = n_nationkey
  where contains(lower(n_name), lower(trim(' ation_1 '))) and o_orderstatus = 'F' and o_totalprice < 200000)
select *, count(*) over () as total, row_number() over (order by o_totalprice, o_orderkey)::int as place, count(*) over () > 10 as more from h order by o_totalprice, o_orderkey limit 10""")
def search_page(spark, sf):
    c = table(spark, sf, "customer").join(F.broadcast(table(spark, sf, "nation")), F.col("c_nationkey") == F.col("n_nationkey"))  # nation: 25 rows, fixed
    h = table(spark, sf, "orders").join(c, F.col("o_custkey") == F.col("c_custkey")).select("o_orderkey", "o_totalprice", "o_orderpriority", "c_name", "n_name", "o_orderstatus")
    where = conjunction({"nation": contains_folded(F.col("n_name"), " ation_1 "), "status": F.col("o_orderstatus") == "F", "below": F.col("o_totalprice") < 200000, "priority": None})
    return op.search_page(h.filter(where).drop("o_orderstatus"), F.lit(True), ["o_totalprice", "o_orderkey"])


@query("trip_schedule", f"""with {STOPS} select l_orderkey, string_agg(l_linenumber::varchar || ':' || l_suppkey::varchar, ',' order by l_linenumber) as stops, count(*)::int as n
from stops where l_orderkey in (select o_orderkey from orders where o_orderpriority = '1-URGENT') group by l_orderkey""")
def trip_schedule(spark, sf):
    asked = table(spark, sf, "orders").filter("o_orderpriority = '1-URGENT'").select(F.col("o_orderkey").alias("l_orderkey"))
    s = op.schedules(stops(spark, sf).join(asked, "l_orderkey", "left_semi"), "l_orderkey", "l_linenumber", "l_suppkey")
    text = F.array_join(F.transform("stops", lambda x: F.concat_ws(":", x["l_linenumber"], x["l_suppkey"])), ",")
    return s.select("l_orderkey", text.alias("stops"), F.size("stops").alias("n"))


@query("worst_delay", f"""with {STOPS} select o_orderkey, at_seq, coalesce(delay, 0.0) as delay, floor(coalesce(delay, 0) / 10)::bigint as tens from orders left join (
  select l_orderkey, arg_max(l_linenumber, (l_quantity, -l_linenumber)) as at_seq, max(l_quantity) as delay from stops group by l_orderkey) on o_orderkey = l_orderkey""")
def worst_delay(spark, sf):
    w = op.worst(stops(spark, sf), "l_orderkey", "l_linenumber", "l_quantity")
    o = table(spark, sf, "orders").select("o_orderkey").join(w, F.col("o_orderkey") == F.col("l_orderkey"), "left")
    delay = F.coalesce("delay", F.lit(0.0))
    return o.select("o_orderkey", "at_seq", delay.alias("delay"), F.floor(delay / 10).alias("tens"))


@query("transfer_check", f"""with {STOPS},
t as (select l_orderkey as trip, l_suppkey as station, l_partkey % 1440 as arr, (l_partkey + l_quantity::bigint) % 1440 as dep from stops),
p as (select o_orderkey as feeder, o_orderkey + 1 as connector from orders where o_orderkey + 1 in (select o_orderkey from orders))
select feeder, connector, a.station, b.dep - a.arr as buffer, b.dep - a.arr >= 5 as fits from p join t a on a.trip = feeder join t b on b.trip = connector and b.station = a.station""")
def transfer_check(spark, sf):
    s = stops(spark, sf).select(F.col("l_orderkey").alias("trip"), F.col("l_suppkey").alias("station"), F.col("l_partkey").alias("arr"), (F.col("l_partkey") + F.col("l_quantity").cast("long")).alias("dep"))
    o = table(spark, sf, "orders").select("o_orderkey")
    pairs = o.select(F.col("o_orderkey").alias("feeder"), (F.col("o_orderkey") + 1).alias("connector")).join(o.withColumnRenamed("o_orderkey", "connector"), "connector", "left_semi")
    return op.transfers(s, pairs, 5).select("feeder", "connector", "station", "buffer", "fits")


@query("transfer_pairs", """with t as (select event_id, user_id, epoch(ts)::bigint as t from (select event_id, user_id, date_trunc('second', ts) as ts from events)),
m as (select a.event_id as feeder, a.user_id, b.event_id as connector, b.t - a.t as wait, b.t as tb from t a join t b on a.user_id = b.user_id and b.t - a.t between 480 and 7200 and a.event_id <> b.event_id)
select feeder, user_id, arg_min(connector, (tb, connector)) as connector, min(wait) as wait, count(*) as options from m group by feeder, user_id""")
def transfer_pairs(spark, sf):
    e = table(spark, sf, "events").select("event_id", "user_id", F.date_trunc("second", "ts").alias("ts"))
    return op.transfer_pairs(e, "user_id", "event_id", "ts", 480, 7200, 7200).select("feeder", "user_id", "connector", "wait", "options")


@query("representative_per_vehicle", """with m as (select distinct l_partkey, l_orderkey from lineitem), r as (select *, row_number() over (partition by l_partkey order by l_orderkey) as k from m)
select l_partkey, max(l_orderkey) filter (k = 1) as first, max(l_orderkey) filter (k = 2) as second, count(*) as members from r group by l_partkey""")
def representative_per_vehicle(spark, sf):
    return op.representatives(table(spark, sf, "lineitem"), "l_partkey", "l_orderkey").select("l_partkey", "first", "second", "members")


@query("vehicle_pairs", """with m as (select distinct l_partkey, l_orderkey from lineitem), r as (select *, row_number() over (partition by l_partkey order by l_orderkey) as k, count(*) over (partition by l_partkey) as n from m)
select l_partkey, min(l_orderkey) as trip_a, max(l_orderkey) as trip_b, ((k - 1) // 2)::bigint as pair from r where (k - 1) // 2 < n // 2 group by l_partkey, (k - 1) // 2""")
def vehicle_pairs(spark, sf):
    g = table(spark, sf, "lineitem").groupBy("l_partkey").agg(F.array_sort(F.collect_set("l_orderkey")).alias("t"))  # the trips of one vehicle: few
    pairs = F.transform(F.sequence(F.lit(0), F.expr("size(t) div 2 - 1")), lambda i: F.struct(F.get("t", i * 2).alias("trip_a"), F.get("t", i * 2 + 1).alias("trip_b"), i.cast("long").alias("pair")))
    return g.filter("size(t) > 1").select("l_partkey", F.explode(pairs).alias("p")).select("l_partkey", "p.*")


@query("route_unique_pool", """with o as (select o_orderkey, o_custkey, o_orderpriority, strftime(o_orderdate, '%m') as dep from orders)
select o_orderkey, dep from o qualify count(*) over (partition by o_custkey) <= 10 and count(*) over (partition by o_custkey, dep) = 1""")
def route_unique_pool(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", "o_custkey", F.date_format("o_orderdate", "MM").alias("dep"))
    return op.unique_in_group(o, ["o_custkey"], "dep", 10).select("o_orderkey", "dep")


@query("filter_combos", """select o_orderstatus, o_orderpriority, year(o_orderdate)::int as y, c_mktsegment, count(*) as hits from orders join customer on o_custkey = c_custkey
group by all having count(*) between 1 and 30""")
def filter_combos(spark, sf):
    o = table(spark, sf, "orders").join(table(spark, sf, "customer").select("c_custkey", "c_mktsegment"), F.col("o_custkey") == F.col("c_custkey"))
    return op.filter_combinations(o.withColumn("y", F.year("o_orderdate")), ["o_orderstatus", "o_orderpriority", "y", "c_mktsegment"], 1, 30)


@query("existence_pools", """select o_orderkey, o_orderkey in (select l_orderkey from lineitem where l_returnflag = 'R') as has_return, o_custkey in (select c_custkey from customer where c_acctbal < 0) as in_debt
from orders where o_orderkey in (select l_orderkey from lineitem) and o_orderkey not in (select l_orderkey from lineitem where l_quantity > 45)""")
def existence_pools(spark, sf):
    flags = table(spark, sf, "lineitem").groupBy("l_orderkey").agg(F.bool_or(F.col("l_returnflag") == "R").alias("has_return"), F.bool_or(F.col("l_quantity") > 45).alias("long"))
    debt = table(spark, sf, "customer").select("c_custkey", (F.col("c_acctbal") < 0).alias("in_debt"))
    o = table(spark, sf, "orders").join(flags.filter("not long"), F.col("o_orderkey") == F.col("l_orderkey")).join(debt, F.col("o_custkey") == F.col("c_custkey"), "left")
    return o.select("o_orderkey", "has_return", F.coalesce("in_debt", F.lit(False)).alias("in_debt"))


@query("calendar_active", """with d as (select user_id as service, ts::date as day, event_type, event_id from events),
base as (select distinct service, day from d where event_type in ('view', 'click')),
x as (select service, day, arg_max(case event_type when 'signup' then 'add' else 'remove' end, event_id) as kind from d where event_type in ('signup', 'error') group by service, day)
select service, strftime(day, '%Y-%m-%d') as day from (
  select service, day from base where (service, day) not in (select service, day from x where kind = 'remove') union select service, day from x where kind = 'add')""")
def calendar_active(spark, sf):
    d = table(spark, sf, "events").select(F.col("user_id").alias("service"), F.to_date("ts").alias("day"), "event_type", F.col("event_id").alias("ord"))
    base = d.filter(F.col("event_type").isin("view", "click")).select("service", "day").distinct()
    x = d.filter(F.col("event_type").isin("signup", "error")).withColumn("kind", F.when(F.col("event_type") == "signup", "add").otherwise("remove"))
    return op.calendar(base, x).select("service", F.date_format("day", "yyyy-MM-dd").alias("day"))


@query("position_interpolation", f"""with {STOPS}, s as (select l_orderkey, l_linenumber, l_linenumber * 10 + l_partkey % 7 as t from stops),
n as (select *, lead(t) over w as nx, row_number() over w - 1 as i from s window w as (partition by l_orderkey order by l_linenumber)),
p as (select l_orderkey, i, round_even(least(greatest((35 - t) / nullif(nx - t, 0), 0.0), 1.0), 5) as share from n where t <= 35 and 35 < nx)
select l_orderkey, count(*) as n_stops, coalesce(min(p.i), 0)::int as segment, coalesce(arg_min(p.share, p.i), 0.0) as share
from n left join p using (l_orderkey) group by l_orderkey""")
def position_interpolation(spark, sf):
    s = stops(spark, sf).select("l_orderkey", "l_linenumber", (F.col("l_linenumber") * 10 + F.col("l_partkey") % 7).alias("t"))
    return op.position(s, "l_orderkey", "l_linenumber", F.lit(35))


@query("resolve_vehicle", """with q as (select trace_id, json_extract_string(c.arguments, '$.kennung') as asked from (select trace_id, unnest(list_distinct(tool_calls)) as c from db_traces_chat)
  where c.tool_name = 'wartung_status' and json_valid(c.arguments)),
v as (select distinct upper(asked) as id from q where starts_with(upper(asked), 'FZ-')),
a as (select lower(trim(asked)) as k, min(trace_id) as t from q where starts_with(upper(trim(asked)), 'IC') group by 1)
select q.trace_id, q.asked, coalesce(v.id, 'via-' || a.t::varchar) as id from q left join v on lower(v.id) = lower(trim(q.asked)) left join a on a.k = lower(trim(q.asked)) where q.asked is not null""")
def resolve_vehicle(spark, sf):
    from railyard.plans.views import calls

    q = calls(spark, sf).filter("tool_name = 'wartung_status'").select("trace_id", F.get_json_object("arguments", "$.kennung").alias("asked")).filter("asked is not null")
    v = q.filter(F.upper("asked").startswith("FZ-")).select(F.upper("asked").alias("id")).distinct()
    a = q.filter(F.upper(F.trim("asked")).startswith("IC")).groupBy(F.col("asked").alias("alias")).agg(F.min("trace_id").alias("t"))
    a = a.groupBy(F.lower(F.trim("alias")).alias("alias")).agg(F.min("t").alias("t")).select("alias", F.concat(F.lit("via-"), F.col("t")).alias("id"))
    return op.resolve(q, "asked", v, a).select("trace_id", "asked", "id")
