"""Mixing sources to target weights.

Method: Efraimidis-Spirakis sampling. Each record has the exponential key -ln(u) / weight, u a hash of its
id, weight a document quality; within a source the records in the order of their keys are prefix-summed to
the source's budget. Complete epochs come first: a budget of k times the source takes each record k times,
and only the rest is drawn by keys.

No source is gathered in one task: the keys are cut into slices of equal width in their logarithm (OCTAVE to a
doubling, so none holds more than a small, fixed share of a source whatever the weights); sizes are summed by
slice, prefix sums over that small table find the slice in which the budget ends, and only its rows are sorted.

The quality of a record is the product of the share of its messages that have content, the share of letters,
digits and blanks in its text, Herdan's measure of how few words repeat (log of the distinct words over log of all
words, about the same at any length), and a half where it does not end with a message of the assistant; LEAST at least.

Defined cases
- size = code points of all message contents; null messages, entries or contents count 0.
- records with one origin_id count once, the first by (ingested_at, record_id); a null origin_id is its own.
- sources are cleaned labels; null or empty ones belong to no target. A source without records has size 0.
- the drawn part takes records up to the rest of the budget, the last one where at least half of it fits, so
  a source is off its budget by at most half a record, or by what is missing where max_repeats caps it.
- a source is short where the mix takes all its text max_repeats times and that is less than its budget.
- repeated targets of a mix and source count once; null numbers count as 0. Empty tables give empty results.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from railyard.core import bound, checkpointed, clean_label, hash_unit

#: Slices for each doubling of the key.
OCTAVE = 8192
#: The least weight of a record.
LEAST = 0.05


def size_of(messages: Column) -> Column:
    return F.coalesce(F.aggregate(messages, F.lit(0).cast("long"), lambda n, m: n + F.coalesce(F.length(m["content"]), F.lit(0))), F.lit(0).cast("long"))


def quality_of(messages: Column) -> Column:
    """Weight in [LEAST, 1] as the module states it."""
    contents = F.filter(F.transform(messages, lambda m: m["content"]), lambda c: F.coalesce(F.length(c), F.lit(0)) > 0)
    filled = F.size(contents) / F.greatest(F.size(messages), F.lit(1))
    text = F.concat_ws(" ", contents)
    plain = F.length(F.regexp_replace(text, r"[^\p{L}\p{N}\s]", "")) / F.greatest(F.length(text), F.lit(1))
    words = F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), lambda w: w != "")
    herdan = bound(words, lambda w: F.when(F.size(w) > 1, F.log(F.size(F.array_distinct(w)).cast("double")) / F.log(F.size(w).cast("double"))).otherwise(F.lit(1.0)))
    ends = F.when(F.element_at(messages, -1)["role"] == "assistant", 1.0).otherwise(0.5)
    return F.greatest(F.lit(LEAST), F.coalesce(F.when(F.size(messages) > 0, filled * plain * herdan * ends), F.lit(LEAST)))


def distinct_records(records: DataFrame) -> DataFrame:
    """One row for each origin: record_id, source, n_chars, weight."""
    row = F.struct("record_id", clean_label("source").alias("source"), size_of(F.col("messages")).alias("n_chars"), quality_of(F.col("messages")).alias("weight"))
    slim = records.select("origin_id", F.struct(F.col("ingested_at").isNull(), "ingested_at", "record_id").alias("at"), row.alias("row"), F.when(F.col("origin_id").isNull(), F.col("record_id")).alias("own"))
    return slim.groupBy("origin_id", "own").agg(F.min_by("row", "at").alias("row")).select("row.*")


def budgets(records: DataFrame, targets: DataFrame) -> DataFrame:
    """Each mix and source with its budget, the source's size, the complete epochs and the rest to draw."""
    sizes = records.groupBy("source").agg(F.sum("n_chars").alias("source_chars"), F.count("*").alias("source_records"))
    wanted = (
        targets.filter("mix_id is not null").withColumn("source", clean_label("source")).filter("source is not null")
        .groupBy("mix_id", "source").agg(*(F.coalesce(F.max(c), F.lit(0)).cast("long").alias(c) for c in ("total_chars", "target_permille", "max_repeats")))
    )
    both = wanted.join(sizes, "source", "left")
    both = both.na.fill(0, ["source_chars", "source_records"]).withColumn("budget", F.expr("total_chars * target_permille div 1000"))
    both = both.withColumn("epochs", F.when(F.col("source_chars") > 0, F.least("max_repeats", F.expr("budget div source_chars"))).otherwise(F.lit(0)).cast("long"))
    rest = F.when(F.col("epochs") < F.col("max_repeats"), F.col("budget") - F.col("epochs") * F.col("source_chars")).otherwise(F.lit(0))
    return both.withColumn("rest", rest.cast("long"))


def _chosen(records: DataFrame, plan: DataFrame, seed: int) -> DataFrame:
    key = -F.log(hash_unit("record_id", seed=seed)) / F.col("weight")
    rows = records.filter("source is not null").withColumn("key", key).withColumn("slice", F.floor(F.log2("key") * OCTAVE).cast("long"))
    before = F.sum("in_slice").over(W.partitionBy("source").orderBy("slice").rowsBetween(W.unboundedPreceding, -1))
    slices = rows.groupBy("source", "slice").agg(F.sum("n_chars").alias("in_slice")).withColumn("before", F.coalesce(before, F.lit(0)))
    # at most one row for each target; the rest ends in the slice ``last``, or beyond all
    mixes = F.broadcast(plan.select("mix_id", "source", "epochs", "rest"))
    ends = slices.join(mixes, "source").filter("before <= rest and before + in_slice > rest").select("mix_id", "source", F.col("slice").alias("last"), "before")
    mixes = F.broadcast(mixes.join(ends, ["mix_id", "source"], "left"))
    rows = rows.join(mixes, "source").filter("epochs > 0 or (rest > 0 and (last is null or slice <= last))")
    out = ["mix_id", "source", "record_id", "n_chars", "times"]
    edge = F.coalesce((F.col("rest") > 0) & (F.col("slice") == F.col("last")), F.lit(False))
    whole = F.when((F.col("rest") > 0) & (F.col("last").isNull() | (F.col("slice") < F.col("last"))), 1).otherwise(0)
    sure = rows.filter(~edge).withColumn("times", F.col("epochs") + whole)
    upto = F.col("before") + F.sum("n_chars").over(W.partitionBy("mix_id", "source").orderBy("key", "record_id").rowsBetween(W.unboundedPreceding, 0))
    last = rows.filter(edge).withColumn("upto", upto).withColumn("times", F.col("epochs") + F.when(2 * F.col("upto") - F.col("n_chars") <= 2 * F.col("rest"), 1).otherwise(0))
    return sure.select(*out).unionByName(last.select(*out)).filter("times > 0")


def mix_records(records: DataFrame, targets: DataFrame, seed: int = 42) -> DataFrame:
    """The mix: (mix_id, source, record_id, n_chars, times)."""
    rows = checkpointed(distinct_records(records))
    return _chosen(rows, budgets(rows, targets), seed)


def mix_report(records: DataFrame, targets: DataFrame, seed: int = 42) -> DataFrame:
    """Per mix and source: target and actual share of the characters drawn, records used, epochs, ``short``."""
    rows = checkpointed(distinct_records(records))
    plan = budgets(rows, targets)
    most = F.broadcast(plan.select("mix_id", "source", "max_repeats"))
    used = _chosen(rows, plan, seed).join(most, ["mix_id", "source"]).groupBy("mix_id", "source").agg(
        F.sum(F.expr("n_chars * times")).alias("actual_chars"), F.count("*").alias("n_records"), F.max("times").alias("most_repeats"),
        F.sum(F.expr("if(times = max_repeats, n_chars, 0)")).alias("chars_used_up"),
    )
    out = plan.join(used, ["mix_id", "source"], "left").na.fill(0, ["actual_chars", "n_records", "most_repeats", "chars_used_up"])
    used_up = (F.col("chars_used_up") == F.col("source_chars")) | (F.col("max_repeats") == 0)
    out = out.withColumn("short", used_up & (F.col("actual_chars") < F.col("budget")))
    whole = F.sum("actual_chars").over(W.partitionBy("mix_id"))
    return out.withColumn("actual_permille", F.when(whole > 0, F.lit(1000.0) * F.col("actual_chars") / whole).otherwise(F.lit(0.0))).select(
        "mix_id", "source", "total_chars", "target_permille", "max_repeats", "source_chars", "budget", "epochs", "actual_chars", "actual_permille", "n_records", "most_repeats", "short"
    )
