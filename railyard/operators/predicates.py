"""Predicates and classifications as Columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MAX_DUPLICATE_RATIO = 0.5
MAX_THINK_CHARS = 12_000
#: Lower bound of the yield for each band, and the most rows of a group in it (fixed values).
BANDS = ((0.85, "high", 60), (0.45, "mid", 250))
LEAST_EVALUATED = 10


def accepted(score: Column, truncated: Column, duplicate_ratio: Column | None = None, think_chars: Column | None = None) -> Column:
    """Full score, not truncated, not degenerate; missing degeneration figures count as 0, the bounds are inclusive."""
    ratio = F.coalesce(duplicate_ratio, F.lit(0.0)) if duplicate_ratio is not None else F.lit(0.0)
    chars = F.coalesce(think_chars, F.lit(0)) if think_chars is not None else F.lit(0)
    good = (score == 1.0) & ~F.coalesce(truncated, F.lit(False)) & (ratio <= MAX_DUPLICATE_RATIO) & (chars <= MAX_THINK_CHARS)
    return F.coalesce(good, F.lit(False))


def first_reason(*rules: tuple[str, Column]) -> Column:
    """The name of the first rule that holds; null if none does."""
    out = None
    for name, rule in rules:
        out = F.when(rule, name) if out is None else out.when(rule, name)
    return out


def inefficient(n_calls: Column, expected: Column, factor: int = 3) -> Column:
    """At least ``factor`` times the calls expected; an expectation of 0 or none switches it off."""
    e = F.coalesce(expected, F.lit(0))
    return (factor > 0) & (e > 0) & (F.coalesce(n_calls, F.lit(0)) >= factor * e)


def band(n_eval: Column, yield_: Column) -> Column:
    """Name of the yield band; null where too few were evaluated."""
    out = F.when(n_eval < LEAST_EVALUATED, F.lit(None).cast("string"))
    for least, name, _ in BANDS:
        out = out.when(yield_ >= least, name)
    return out.otherwise("low")


def band_cap(band_name: Column) -> Column:
    """Most rows of a group in the band; null stands for no limit."""
    out = None
    for _, name, cap in BANDS:
        out = F.when(band_name == name, cap) if out is None else out.when(band_name == name, cap)
    return out.cast("int")


def contains_folded(col: Column, needle: str) -> Column:
    """Trimmed, case-insensitive substring; % and _ in the needle are ordinary characters."""
    return F.contains(F.lower(col), F.lower(F.trim(F.lit(needle))))


def conjunction(filters: dict[str, Column | None]) -> Column:
    """All given filters; at least one must be given."""
    given = [c for c in filters.values() if c is not None]
    if not given:
        raise ValueError("at least one filter is needed: " + ", ".join(filters))
    out = given[0]
    for c in given[1:]:
        out = out & c
    return out


def safe_ratio(a: Column, b: Column) -> Column:
    """a / b with 1 for a smaller b."""
    return a / F.greatest(F.lit(1), b)
