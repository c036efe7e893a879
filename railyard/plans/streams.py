"""Stream monitors, each with its batch twin as SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from railyard.core import table
from railyard.plans.registry import query
from railyard.streaming import monitors as op


def events(spark, sf):
    return op.event_stream(spark, f"{sf}/events.parquet")


@query("stream_progress", """select strftime(date_trunc('hour', ts), '%Y-%m-%d %H') as since, count(*) as n, count(*) filter (event_type = 'error') as n_error from events
where date_trunc('hour', ts) + interval 1 hour <= (select max(ts) - interval 10 minutes from events) group by 1""")
def stream_progress(spark, sf):
    return op.drained(op.progress(events(spark, sf))).withColumn("since", F.date_format("since", "yyyy-MM-dd HH"))


@query("stream_breaker", """with o as (select *, row_number() over (partition by user_id order by ts, event_id) as i from events),
g as (select *, i - row_number() over (partition by user_id order by ts, event_id) as island from o where event_type = 'error'),
s as (select *, row_number() over (partition by user_id, island order by i) as streak from g)
select user_id, event_id, streak::int as streak from s where streak = 3""")
def stream_breaker(spark, sf):
    return op.drained(op.breaker(events(spark, sf)))


@query("stream_transient", "select event_id, row_number() over (partition by user_id, event_type order by ts, event_id) <= 2 as fails from events")
def stream_transient(spark, sf):
    return op.drained(op.transient(events(spark, sf)))


@query("stream_resume", "select event_id from events where user_id not in (select c_custkey from customer where c_acctbal < 0)")
def stream_resume(spark, sf):
    done = table(spark, sf, "customer").filter("c_acctbal < 0").select(F.col("c_custkey").alias("user_id"))
    return op.drained(op.unseen(events(spark, sf), done, "user_id").select("event_id"))


@query("stream_first_seen", "select distinct event_id from events")
def stream_first_seen(spark, sf):
    e = events(spark, sf)
    return op.drained(op.first_seen(e.union(e), ["event_id"]).select("event_id"))
