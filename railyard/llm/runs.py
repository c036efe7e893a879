"""Repeated consecutive events in sequences: each run becomes one event with its count and duration.

Method: per entity, the canonical events are mapped to Unicode code points and joined to a symbol string;
a backreference pattern finds the repetitions; their spans are mapped back to sequence numbers and times.

Defined cases
- null or empty ``tool_calls``: no event. A null entry, or one without ``seq``, is left out.
- entries with the same non-null ``call_id`` are one call (the first by ``seq`` holds).
- ``tool_name`` is compared as it stands; two null names are equal.
- a null ``arguments`` equals only another null; text that is no JSON object equals only the same text.
- arguments whose value is null, blank text or an empty list or object count as not given.
- duration runs from the first known ``called_at`` to the last known one plus its ``took_ms``; without any
  known ``called_at`` it is null.
- columns other than ``trace_id`` and ``tool_calls`` are ignored, whatever their names.
"""

from __future__ import annotations

import json
import re
import unicodedata
from collections.abc import Iterator
from decimal import Decimal, InvalidOperation

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from railyard.core import spread

RUN = re.compile(r"(.)\1+", re.S)
RUN_OR_ONE = re.compile(r"(.)\1*", re.S)
NUMBER = re.compile(r"[+-]?(?:0|[1-9]\d*)(?:\.\d+)?")
BLANKS = re.compile(r"\s+")
UMLAUTS = str.maketrans({"ä": "ae", "ö": "oe", "ü": "ue"})
FIRST_SYMBOL = 0x100
SCHEMA = (
    "trace_id long, first_seq int, last_seq int, tool_name string, n_calls int, "
    "started_at timestamp_ntz, ended_at timestamp_ntz, duration_ms long"
)


def fold_text(text: str) -> str:
    """Letter case, blanks, umlaut spelling and a number's notation removed."""
    text = BLANKS.sub("", unicodedata.normalize("NFC", text)).casefold().translate(UMLAUTS)
    return fold_number(text) if NUMBER.fullmatch(text) else text


def fold_number(text: str) -> str:
    try:
        number = Decimal(text)
    except InvalidOperation:
        return text
    if not number.is_finite():
        return text
    if number == number.to_integral_value() and abs(number) < Decimal(10) ** 40:
        return str(int(number))
    return format(number.normalize(), "f") if abs(number.adjusted()) < 40 else str(number.normalize())


def fold_value(value):
    """The form in which values that mean the same are equal; None stands for not given."""
    if value is None:
        return None
    if isinstance(value, bool):
        return "true" if value else "false"
    if isinstance(value, (int, Decimal)):
        return fold_number(str(value))
    if isinstance(value, str):
        return fold_text(value) or None
    if isinstance(value, list):
        return ("[", *(fold_value(v) for v in value)) if value else None
    return fold_object(value) or None


def fold_object(value: dict) -> tuple:
    folded = {}
    for k, v in value.items():
        v = fold_value(v)
        if v is not None:
            folded[fold_text(k)] = v
    return tuple(sorted(folded.items(), key=lambda item: item[0]))


def fold_arguments(text: str | None):
    """Key under which arguments are the same; objects by meaning, all else by its text."""
    if text is None:
        return ("none",)
    try:
        value = json.loads(text, parse_float=Decimal, parse_constant=str)
    except (ValueError, RecursionError):
        return ("text", text)
    if not isinstance(value, dict):
        return ("text", text)
    try:
        return ("object", fold_object(value))
    except (RecursionError, ValueError):
        return ("text", text)


def symbol(n: int) -> str:
    """The n-th code point from FIRST_SYMBOL on, surrogates skipped."""
    code = FIRST_SYMBOL + n
    return chr(code + 0x800 if code >= 0xD800 else code)


def spans(calls: list[tuple], pattern: re.Pattern) -> list[tuple[int, int]]:
    """Index spans of runs in calls of (seq, tool, arguments), already in order."""
    n = len(calls)
    symbols: dict = {}
    text = []
    for i, (_, tool, arguments) in enumerate(calls):
        # arguments are only looked into beside a call of the same tool
        near = (i and calls[i - 1][1] == tool) or (i + 1 < n and calls[i + 1][1] == tool)
        key = (tool, fold_arguments(arguments)) if near else i
        text.append(symbol(symbols.setdefault(key, len(symbols))))
    return [m.span() for m in pattern.finditer("".join(text))]


def _collapse(batches: Iterator[pa.RecordBatch], pattern: re.Pattern) -> Iterator[pa.RecordBatch]:
    names = [f.split()[0] for f in SCHEMA.split(", ")]
    types = [pa.int64(), pa.int32(), pa.int32(), pa.string(), pa.int32(), pa.timestamp("us"), pa.timestamp("us"), pa.int64()]
    for batch in batches:
        ids = batch.column(0).to_pylist()
        lists = batch.column(1)
        flat = lists.flatten()
        seqs, call_ids, tools, arguments, tooks = (flat.field(k).to_pylist() for k in (0, 1, 2, 3, 5))
        starts = flat.field(4).cast(pa.int64()).to_pylist()
        missing = flat.is_null().to_pylist() if flat.null_count else None
        out: list[tuple] = []
        at = 0
        for trace_id, size in zip(ids, lists.value_lengths().to_pylist()):
            if not size:
                continue
            order = [i for i in range(at, at + size) if seqs[i] is not None and not (missing and missing[i])]
            at += size
            order.sort(key=lambda i: (seqs[i], call_ids[i] is None, call_ids[i] or ""))
            seen: set = set()
            kept = []
            for i in order:
                if call_ids[i] is None or call_ids[i] not in seen:
                    seen.add(call_ids[i])
                    kept.append(i)
            for a, b in spans([(seqs[i], tools[i], arguments[i]) for i in kept], pattern):
                run = kept[a:b]
                begun = next((starts[i] for i in run if starts[i] is not None), None)
                ended = next((starts[i] + 1000 * (tooks[i] or 0) for i in reversed(run) if starts[i] is not None), None)
                length = None if begun is None else (ended - begun) // 1000
                out.append((trace_id, seqs[run[0]], seqs[run[-1]], tools[run[0]], b - a, begun, ended, length))
        columns = list(zip(*out)) if out else [()] * len(names)
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=names)


def collapse_runs(traces: DataFrame, min_calls: int = 2) -> DataFrame:
    """Runs of at least ``min_calls`` (1 or 2) equal neighbours in ``tool_calls``, one row each.

    Row-local: no shuffle. With ``min_calls=2`` traces whose calls are numbered without gap or repeat and hold no two
    calls of one tool at neighbouring ``seq`` are set aside by built-in functions before anything reaches Python.
    """
    calls = F.col("tool_calls")
    slim = spread(traces).select(
        F.col("trace_id").cast("long").alias("trace_id"),
        F.transform(
            calls,
            lambda c: F.struct(
                c["seq"].cast("int").alias("seq"), c["call_id"].alias("call_id"), c["tool_name"].alias("tool_name"),
                c["arguments"].alias("arguments"), c["called_at"].cast("timestamp_ntz").alias("called_at"), c["took_ms"].cast("long").alias("took_ms"),
            ),
        ).alias("tool_calls"),
    ).filter(F.size("tool_calls") >= min_calls)
    if min_calls > 1:
        # only where seqs are without null, repeat or gap and call_ids without repeat are neighbours by seq exactly those
        # one apart; every other trace goes on unseen
        key = lambda c, d: F.concat_ws("\x00", (c["seq"].cast("long") + d).cast("string"), F.coalesce(c["tool_name"], F.lit("\x01")))
        seqs = F.transform("tool_calls", lambda c: c["seq"].cast("long"))
        ids = F.filter(F.transform("tool_calls", lambda c: c["call_id"]), lambda x: x.isNotNull())
        regular = (
            F.forall(seqs, lambda x: x.isNotNull()) & (F.size(F.array_distinct(seqs)) == F.size(seqs)) & (F.array_max(seqs) - F.array_min(seqs) + 1 == F.size(seqs))
            & (F.size(F.array_distinct(ids)) == F.size(ids))
        )
        beside = F.arrays_overlap(F.transform("tool_calls", lambda c: key(c, 0)), F.transform("tool_calls", lambda c: key(c, 1)))
        slim = slim.filter(beside | ~F.coalesce(regular, F.lit(False)))
    pattern = RUN if min_calls > 1 else RUN_OR_ONE
    return slim.mapInArrow(lambda batches: _collapse(batches, pattern), SCHEMA)
