"""Labels of token sequences: spans that are learned, paddings, and texts and lists cut to a size."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from railyard.functions.values import span_mask

#: The label of a token that is not learned (fixed value).
IGNORED = -100


def span_labels(opening: list[int], closing: int):
    """A function of (tokens, end of the last user turn): the labels of the spans after ``opening`` up to ``closing``, IGNORED elsewhere."""

    @F.pandas_udf("array<int>")
    def labels(tokens: pd.Series, last_user_end: pd.Series) -> pd.Series:
        return pd.Series([None if t is None else span_mask(list(t), opening, closing, int(e)) for t, e in zip(tokens, last_user_end)], dtype=object)

    return labels


def padded(values: Column, size: Column, fill: int) -> Column:
    """The array filled up to ``size``; a longer one stays as it is."""
    return F.concat(values, F.array_repeat(F.lit(fill), F.greatest(size - F.size(values), F.lit(0))))


def cut_text(text: Column, most: int) -> Column:
    return F.when(F.length(text) > most, F.substring(text, 1, most)).otherwise(text)


def cut_list(values: Column, most: int) -> Column:
    return F.slice(values, 1, most)
