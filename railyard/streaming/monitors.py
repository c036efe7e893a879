"""Monitors of an append-only event log as Structured Streaming.

Each takes a streaming DataFrame and returns one; ``drained`` runs such a stream over what is there, writes its
rows as parquet into the shared checkpoint folder and reads them back, so that nothing is gathered on the driver.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from railyard.core import shared_folder


def event_stream(spark: SparkSession, path: str, files_per_trigger: int | None = None) -> DataFrame:
    """The parquet files under a path as a stream; ``ts`` as a timestamp for watermarks."""
    reader = spark.readStream.schema(spark.read.parquet(path).schema)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    # as a pattern, since a plain path of the file source has to be a folder
    return reader.parquet(f"{path[:-1]}[{path[-1]}]").withColumn("ts", F.col("ts").cast("timestamp"))


def drained(stream: DataFrame) -> DataFrame:
    """All rows that an append stream gives over the data at hand."""
    spark = stream.sparkSession
    folder = shared_folder(spark, f"stream-{uuid.uuid4().hex}")
    schema = stream.schema
    run = (
        stream.writeStream.format("parquet").option("path", f"{folder}/rows").option("checkpointLocation", f"{folder}/state")
        .outputMode("append").trigger(availableNow=True).start()
    )
    run.awaitTermination()
    return spark.read.schema(schema).parquet(f"{folder}/rows")


def progress(events: DataFrame, window: str = "1 hour", delay: str = "10 minutes") -> DataFrame:
    """Events and errors of each window, given out once the watermark has passed it; later events are dropped."""
    w = F.window("ts", window)
    counted = events.withWatermark("ts", delay).groupBy(w.alias("w")).agg(F.count("*").alias("n"), F.count_if(F.col("event_type") == "error").alias("n_error"))
    return counted.select(F.col("w.start").alias("since"), "n", "n_error")


def breaker(events: DataFrame, limit: int = 3) -> DataFrame:
    """(user_id, event_id, streak) at each event with which ``limit`` errors in a row are reached; success resets.

    State per user: the streak so far. Within a trigger the events of a user are put in order.
    """

    def step(key: tuple, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        (streak,) = state.get if state.exists else (0,)
        rows = pd.concat(list(parts)).sort_values(["ts", "event_id"], kind="stable")
        out = []
        for event_id, kind in zip(rows["event_id"], rows["event_type"]):
            streak = streak + 1 if kind == "error" else 0
            if streak == limit:
                out.append((key[0], event_id, streak))
        state.update((streak,))
        yield pd.DataFrame(out, columns=["user_id", "event_id", "streak"])

    slim = events.select("user_id", "event_id", "event_type", "ts")
    return slim.groupBy("user_id").applyInPandasWithState(step, "user_id long, event_id long, streak int", "streak int", "append", GroupStateTimeout.NoTimeout)


def transient(events: DataFrame, first: int = 2) -> DataFrame:
    """Marks the first ``first`` events of each (user, kind) as failed, later ones as recovered; state: how many were seen."""

    def step(key: tuple, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        (seen,) = state.get if state.exists else (0,)
        rows = pd.concat(list(parts)).sort_values(["ts", "event_id"], kind="stable")
        place = seen + pd.RangeIndex(1, len(rows) + 1).to_numpy()
        state.update((int(seen + len(rows)),))
        yield pd.DataFrame({"event_id": rows["event_id"].to_numpy(), "fails": place <= first})

    slim = events.select("user_id", "event_type", "event_id", "ts")
    return slim.groupBy("user_id", "event_type").applyInPandasWithState(step, "event_id long, fails boolean", "seen int", "append", GroupStateTimeout.NoTimeout)


def unseen(events: DataFrame, done: DataFrame, key: str) -> DataFrame:
    """Events whose key is not among those already done; with the sink's checkpoint this resumes without a lock."""
    return events.join(done.select(key).distinct(), key, "left_anti")


def first_seen(events: DataFrame, keys: list[str], delay: str = "1 hour") -> DataFrame:
    """One event of each key; a repeat within the watermark's delay is dropped, state older than that is let go."""
    return events.withWatermark("ts", delay).dropDuplicatesWithinWatermark(keys)
