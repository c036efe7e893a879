"""Table functions: one row per call or message of a text."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql.functions import udtf

from railyard.functions.values import segments, text_calls


@udtf(returnType="pos int, name string, arguments string")
class ExtractCalls:
    def eval(self, text: str):
        for i, (name, arguments) in enumerate(text_calls(text)[0]):
            yield i, name, arguments


@udtf(returnType="pos int, role string, content string, call_id string")
class SegmentEpisode:
    def eval(self, text: str):
        yield from segments(text)


def register(spark: SparkSession) -> None:
    """Makes the table functions known to SQL as extract_calls and segment_episode."""
    spark.udtf.register("extract_calls", ExtractCalls)
    spark.udtf.register("segment_episode", SegmentEpisode)
