"""Text operators: normal forms, grounding, containment, language and reasoning marks."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import ahocorasick
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from railyard.core import bound

#: What counts as an entity in an answer (fixed values): staff, work orders, assignments, clock times, dates, trains, vehicles.
ENTITIES = (r"\bMA-\d+\b", r"\bWO-\d{4}-\d+\b", r"\bAS-\d+\b", r"\b\d{1,2}:\d{2}\b", r"\b\d{4}-\d{2}-\d{2}\b", r"\b(?:ICE|IC|EC|ECE|RJ|EN)\s?\d+\b", r"\b[A-Za-z0-9]+-9\d{3}\b")
#: Words that mark a text as German, in small letters (fixed values).
GERMAN = ("der", "die", "das", "ist", "sind", "und", "für", "wurde", "wurden", "keine", "aktuell", "zug", "verspätung", "zugeteilt", "minuten", "planmäßig")
#: What stands between words of any script.
NO_WORD = r"[^\p{L}\p{M}\p{N}_]+"
CLOSING = ("</think>", "</seed:think>", "[/THINK]")


def collapsed(col: Column) -> Column:
    """Blanks as one, trimmed, lower case."""
    return F.trim(F.lower(F.regexp_replace(col, r"\s+", " ")))


def compact(col: Column) -> Column:
    """Without blanks, lower case."""
    return F.lower(F.regexp_replace(col, r"\s+", ""))


def strip_reasoning(col: Column, trim: bool = True) -> Column:
    """Paired reasoning blocks removed, then everything up to the last closing mark that is left."""
    c = F.regexp_replace(col, r"(?s)<(?:seed:)?think>.*?</(?:seed:)?think>\s*", "")
    c = F.regexp_replace(c, r"(?s)\[THINK\].*?\[/THINK\]\s*", "")
    for mark in CLOSING:
        c = F.substring_index(c, mark, -1)
    return F.trim(c) if trim else c


def reasoning(col: Column) -> Column:
    """The reasoning blocks, non-empty ones joined by a blank line."""
    blocks = F.concat(F.regexp_extract_all(col, F.lit(r"(?s)<(?:seed:)?think>(.*?)</(?:seed:)?think>"), F.lit(1)), F.regexp_extract_all(col, F.lit(r"(?s)\[THINK\](.*?)\[/THINK\]"), F.lit(1)))
    return F.array_join(F.filter(F.transform(blocks, F.trim), lambda b: b != ""), "\n\n")


def entities(col: Column) -> Column:
    """All entities of a text, each once."""
    found = [F.regexp_extract_all(col, F.lit(p), F.lit(0)) for p in ENTITIES]
    return F.array_distinct(F.concat(*found))


def ungrounded(answer: Column, corpus: Column, more: Column | None = None) -> Column:
    """Entities of the answer that are no substring of the corpus, both without blanks and in lower case.

    Substring is meant: MA-12 is grounded by MA-123. ``more``: further grounded values.
    """
    left = bound(compact(corpus), lambda ground: F.filter(entities(answer), lambda e: ~F.contains(ground, compact(e))))
    return left if more is None else F.array_except(left, more)


def minutes(clock: Column) -> Column:
    return F.split_part(clock, F.lit(":"), F.lit(1)).cast("int") * 60 + F.split_part(clock, F.lit(":"), F.lit(2)).cast("int")


def clock(m: Column) -> Column:
    m = F.pmod(m, F.lit(1440))
    return F.format_string("%02d:%02d", F.floor(m / 60).cast("int"), F.pmod(m, F.lit(60)).cast("int"))


def derived_times(text: Column) -> Column:
    """Every HH:MM of the text plus and minus every delay in minutes; a delay of 0 gives nothing new."""
    times = F.array_distinct(F.regexp_extract_all(text, F.lit(r"\b([01]\d|2[0-3]):[0-5]\d\b"), F.lit(0)))
    delays = F.filter(F.transform(F.array_distinct(F.regexp_extract_all(text, F.lit(r"\b(\d{1,3}) Minuten"), F.lit(1))), lambda d: d.cast("int")), lambda d: d != 0)
    shift = lambda ds: F.flatten(F.transform(times, lambda t: F.flatten(F.transform(ds, lambda d: F.array(clock(minutes(t) + d), clock(minutes(t) - d))))))
    shifted = bound(delays, shift)
    return F.array_sort(F.array_distinct(shifted))


def german_words(col: Column) -> Column:
    """German marker words that are whole words, in texts of any script: the end of Räder is none."""
    return F.size(F.filter(F.split(F.lower(col), NO_WORD), lambda w: w.isin(*GERMAN)))


def looks_german(text: Column, words: Column) -> Column:
    return (words >= 2) | text.rlike("[äöüÄÖÜß]")


#: Characters of needles that are searched in one pass.
NEEDLES = 16_000_000


def containment(corpus: DataFrame, text: Column, key: str, needles: DataFrame, needle_key: str, needle: Column, least: int = 30) -> DataFrame:
    """(key, needle_key) of needles of at least ``least`` characters that occur in a text, both collapsed, each pair once.

    The needles are a stated query set: they are taken in blocks of NEEDLES characters, each block one automaton that
    reads every text once, so a pass costs the same however many needles it has. Nothing is shuffled and nothing is
    joined each with each; texts do not leave their task.
    """
    n = needles.select(F.col(needle_key).alias("k"), collapsed(needle).alias("needle")).filter(F.length("needle") >= least).distinct()
    keys: dict[str, list] = {}
    for r in sorted(n.collect(), key=lambda r: (r["needle"], str(r["k"]))):
        keys.setdefault(r["needle"], []).append(r["k"])
    c = corpus.select(F.col(key), collapsed(text).alias("_text")).filter(F.length("_text") >= least)
    schema = T.StructType([c.schema[key], T.StructField(needle_key, n.schema["k"].dataType)])
    found, block, size = [], {}, 0
    for i, (x, ks) in enumerate(keys.items()):
        block[x] = ks
        size += len(x)
        if size >= NEEDLES or i + 1 == len(keys):
            found.append(c.mapInArrow(_searcher(corpus.sparkSession.sparkContext.broadcast(block), schema), schema))
            block, size = {}, 0
    return reduce(DataFrame.unionByName, found) if found else corpus.sparkSession.createDataFrame([], schema)


def _searcher(shared, schema: T.StructType):
    key, needle_key = schema.names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search = ahocorasick.Automaton()
        for needle, ks in shared.value.items():
            search.add_word(needle, ks)
        search.make_automaton()
        for batch in batches:
            at: list[int] = []
            out: list = []
            for i, text in enumerate(batch.column(1).to_pylist()):
                hits = dict.fromkeys(k for _, ks in search.iter(text) for k in ks)
                at += [i] * len(hits)
                out += hits
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(at, pa.int64())), pa.array(out, to_arrow_type(schema[needle_key].dataType))], names=[key, needle_key])

    return run
