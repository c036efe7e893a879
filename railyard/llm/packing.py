"""Filling fixed-capacity containers with items.

Method: optimal length buckets. Over the global histogram of lengths, dynamic programming chooses the bucket
boundaries that minimise the padding (each item rounded up to its boundary); token-budget batches are then
formed of whole slots of those lengths.

Batches inside one bucket alone leave much room where items are longer than half a container (two do not
fit), so ``mix=True``, the default, forms them of slots of several buckets: each container takes the longest
slot left and those of the others that fill it best (a bounded subset-sum over the bucket lengths), and a
pattern found once serves as many containers as the counts allow. ``mix=False`` keeps to one bucket each.
The plan is made on the driver from the histogram, whose size the capacity bounds; rows are never gathered:
a row's rank in its bucket tells its slot, and ranks are offsets of groups of about GROUP rows, so neither a
frequent length nor many long items gather in one task.

Defined cases
- null and empty texts have no tokens and no place. Tokens are those of ``encode`` (blank text has some).
- an item longer than the capacity is cut into pieces of exactly the capacity, each a container of its own,
  and a rest that is packed like any item; no other item is cut.
- ties in length are broken by a hash of the id. Repeated rows of pack_sizes count once; rows with a null or
  a capacity under 1 are left out; an unknown tokenizer raises ValueError. Empty tables give empty results.
"""

from __future__ import annotations

import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from railyard.core import checkpointed, spread
from railyard.llm.encode import TOKENIZERS, Encoder, shared_table, slices

BUCKETS = 256
#: Items of one bucket, or long items, that are numbered in one group.
GROUP = 200_000


def token_counts(documents: DataFrame, tokenizers: list[str], folder: str = TOKENIZERS) -> DataFrame:
    """(doc_id, n0, n1, ..): tokens of each text by each tokenizer; row-local."""
    for name in tokenizers:
        if not os.path.exists(os.path.join(folder, f"{name}.tiktoken")):
            raise ValueError(f"no rank file for tokenizer {name!r} in {folder}")
    tables = [shared_table(documents.sparkSession, name, folder) for name in tokenizers]
    names = ["doc_id", *(f"n{i}" for i in range(len(tables)))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoders = [Encoder(t.value) for t in tables]
        for batch in batches:
            at = 0
            for texts in slices(batch.column(1).to_pylist()):
                counts = [pa.array(e.count(texts), pa.int64()) for e in encoders]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(at, len(texts)), *counts], names=names)
                at += len(texts)

    slim = spread(documents).select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).filter("length(text) > 0")
    return slim.mapInArrow(run, ", ".join(f"{n} long" for n in names))


def best_boundaries(lengths: np.ndarray, counts: np.ndarray, buckets: int) -> np.ndarray:
    """The at most ``buckets`` boundaries, out of the sorted lengths, for which the padding is least.

    cost of a bucket (i, j] = length[j] * items in it - their total; the least total over k buckets is found
    for all ends at once with the lower hull of lines, O(buckets * lengths).
    """
    n = len(lengths)
    if n <= buckets:
        return lengths
    # whole numbers in plain lists: exact, and quicker to read one by one than arrays
    items = [0, *np.cumsum(counts).tolist()]
    total = [0, *np.cumsum(lengths * counts).tolist()]
    sizes = lengths.tolist()
    # height[i]: least padding of the first i lengths, plus their total; None where k - 1 buckets cannot end there
    height: list[int | None] = [0] + [None] * n
    back = []
    for _ in range(buckets):
        new: list[int | None] = [0] + [None] * n
        chosen = [0] * (n + 1)
        # lines of slope -items[i] and height[i], asked at rising lengths
        hull: list[int] = []
        head = 0
        for j in range(1, n + 1):
            i = j - 1
            h = height[i]
            if h is not None:
                while len(hull) - head >= 2:
                    p, q = hull[-2], hull[-1]
                    if (h - height[p]) * (items[q] - items[p]) <= (height[q] - height[p]) * (items[i] - items[p]):
                        hull.pop()
                    else:
                        break
                hull.append(i)
            x = sizes[i]
            while len(hull) - head >= 2 and height[hull[head + 1]] - height[hull[head]] <= x * (items[hull[head + 1]] - items[hull[head]]):
                head += 1
            if head < len(hull):
                i = hull[head]
                new[j] = x * (items[j] - items[i]) + height[i]
                chosen[j] = i
        height = new
        back.append(chosen)
    ends, j = [], n
    for k in range(buckets, 0, -1):
        if j <= 0:
            break
        ends.append(int(lengths[j - 1]))
        j = back[k - 1][j]
    return np.array(sorted(set(ends)), np.int64)


def best_fill(sizes: np.ndarray, left: np.ndarray, room: int) -> list[tuple[int, int]]:
    """(type, how many) of a choice whose sizes come as near to ``room`` as any; long ones are preferred.

    Subset sums are bit sets in one integer; for each type the multiples are added by doubling, and the
    choice is read back from the sets, shortest type first.
    """
    usable = [t for t in range(len(sizes)) if left[t] > 0 and sizes[t] <= room]
    mask = (1 << (room + 1)) - 1
    reach = 1
    stages = []
    for t in usable:
        s, most = int(sizes[t]), min(int(left[t]), room // int(sizes[t]))
        k = 1
        while most > 0:
            k = min(k, most)
            stages.append((t, k, reach))
            reach |= (reach << (s * k)) & mask
            most -= k
            k *= 2
        if reach >> room & 1:
            break
    at = reach.bit_length() - 1
    chosen: dict[int, int] = {}
    for t, k, before in reversed(stages):
        if not before >> at & 1:
            at -= int(sizes[t]) * k
            chosen[t] = chosen.get(t, 0) + k
    return list(chosen.items())


def make_patterns(sizes: np.ndarray, counts: np.ndarray, capacity: int, mix: bool = True) -> list[tuple[int, list[tuple[int, int]]]]:
    """(how many containers, [(bucket, slots in each)]) that take all items; sizes rise."""
    left = counts.astype(np.int64).copy()
    out = []
    top = len(sizes) - 1
    while True:
        while top >= 0 and left[top] == 0:
            top -= 1
        if top < 0:
            return out
        if mix:
            left[top] -= 1
            pattern = dict(best_fill(sizes, left, capacity - int(sizes[top])))
            left[top] += 1
            pattern[top] = pattern.get(top, 0) + 1
        else:
            pattern = {top: int(min(left[top], capacity // int(sizes[top])))}
        times = int(min(left[t] // k for t, k in pattern.items()))
        for t, k in pattern.items():
            left[t] -= k * times
        out.append((times, sorted(pattern.items(), reverse=True)))


class Plan:
    """Where the items of each bucket go; small arrays, made on the driver and sent to the executors."""

    def __init__(self, lengths: np.ndarray, counts: np.ndarray, capacity: int, buckets: int = BUCKETS, mix: bool = True):
        self.bounds = best_boundaries(lengths, counts, buckets)
        bucket = np.searchsorted(self.bounds, lengths)
        per_bucket = np.bincount(bucket, weights=counts, minlength=len(self.bounds)).astype(np.int64)
        # slots of bucket b in order: from rank starts[b][i] on, containers from firsts[b][i] on take each[b][i]
        self.starts: list[list[int]] = [[] for _ in self.bounds]
        self.firsts: list[list[int]] = [[] for _ in self.bounds]
        self.each: list[list[int]] = [[] for _ in self.bounds]
        seen = [0] * len(self.bounds)
        self.containers = 0
        for times, pattern in make_patterns(self.bounds, per_bucket, capacity, mix):
            for b, k in pattern:
                self.starts[b].append(seen[b])
                self.firsts[b].append(self.containers)
                self.each[b].append(k)
                seen[b] += times * k
            self.containers += times
        self.groups = 1 + per_bucket // GROUP
        self.arrays = [tuple(np.array(x, np.int64) for x in y) for y in zip(self.starts, self.firsts, self.each)]

    def container(self, bucket: np.ndarray, rank: np.ndarray) -> np.ndarray:
        out = np.empty(len(bucket), np.int64)
        for b in np.unique(bucket):
            mine = bucket == b
            starts, firsts, each = self.arrays[b]
            i = np.searchsorted(starts, rank[mine], side="right") - 1
            out[mine] = firsts[i] + (rank[mine] - starts[i]) // each[i]
        return out


def _ranges(df: DataFrame, keys: list[str], n: str) -> DataFrame:
    """``df`` with, in ``before``, the sum of ``n`` over the rows before it in its group; a small table."""
    w = W.partitionBy(*keys[:-1]).orderBy(keys[-1]).rowsBetween(W.unboundedPreceding, -1)
    return df.withColumn("before", F.coalesce(F.sum(n).over(w), F.lit(0)))


def pack_items(sizes: DataFrame, capacities: dict[int, int], buckets: int = BUCKETS, mix: bool = True) -> DataFrame:
    """Places for items (pack_id, doc_id, n): rows (pack_id, container_id, doc_id, piece, n_tokens).

    Rests and short items are packed by plan; the full pieces of long items are containers numbered after those.
    """
    spark = sizes.sparkSession
    schema = "pack_id long, container_id long, doc_id long, piece long, n_tokens long"
    cap = F.create_map(*(F.lit(x) for p, c in capacities.items() for x in (p, c)))[F.col("pack_id")].cast("long") if capacities else F.lit(1).cast("long")
    rows = sizes.filter("n > 0").withColumn("capacity", cap).filter("capacity is not null")
    rows = rows.withColumn("full", F.when(F.col("n") > F.col("capacity"), F.expr("n div capacity")).otherwise(F.lit(0)))
    rows = rows.withColumn("rest", F.col("n") - F.col("full") * F.col("capacity"))
    rows = rows.withColumn("hash", F.pmod(F.xxhash64("doc_id"), F.lit(2**31)))
    # bounded by the capacities, whatever the number of documents
    histogram = rows.groupBy("pack_id", "rest").agg(F.count("*").alias("n"), F.count_if(F.col("full") > 0).alias("long")).collect()
    plans, groups_of = {}, {}
    for p, c in capacities.items():
        mine = sorted((r["rest"], r["n"]) for r in histogram if r["pack_id"] == p and r["rest"] > 0)
        plans[p] = Plan(np.array([x for x, _ in mine], np.int64), np.array([n for _, n in mine], np.int64), c, buckets, mix)
        groups_of[p] = 1 + sum(r["long"] for r in histogram if r["pack_id"] == p) // GROUP
    if not plans:
        return spark.createDataFrame([], schema)
    shared = spark.sparkContext.broadcast(plans)

    def to_bucket(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pack, doc, rest, full, number = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(5))
            bucket, salt = np.zeros(len(pack), np.int64), np.zeros(len(pack), np.int64)
            for p in np.unique(pack):
                mine = pack == p
                bucket[mine] = np.searchsorted(shared.value[p].bounds, rest[mine])
                salt[mine] = number[mine] % shared.value[p].groups[bucket[mine]]
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in (pack, doc, rest, full, bucket, salt)], names=["pack_id", "doc_id", "rest", "full", "bucket", "salt"])

    slim = rows.filter("rest > 0").select("pack_id", "doc_id", "rest", F.col("full").cast("long").alias("full"), "hash")
    slim = slim.mapInArrow(to_bucket, "pack_id long, doc_id long, rest long, full long, bucket long, salt long")
    groups = _ranges(slim.groupBy("pack_id", "bucket", "salt").agg(F.count("*").alias("in_group")), ["pack_id", "bucket", "salt"], "in_group")
    rank = F.row_number().over(W.partitionBy("pack_id", "bucket", "salt").orderBy("rest", "doc_id")) - 1
    ranked = slim.withColumn("rank", rank).join(groups, ["pack_id", "bucket", "salt"]).select("pack_id", "doc_id", "rest", "full", "bucket", (F.col("rank") + F.col("before")).alias("rank"))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pack, doc, rest, full, bucket, rank = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(6))
            container = np.zeros(len(pack), np.int64)
            for p in np.unique(pack):
                mine = pack == p
                container[mine] = shared.value[p].container(bucket[mine], rank[mine])
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in (pack, container, doc, full, rest)], names=["pack_id", "container_id", "doc_id", "piece", "n_tokens"])

    rests = ranked.mapInArrow(place, schema)
    salts = F.create_map(*(F.lit(x) for p, n in groups_of.items() for x in (p, n)))[F.col("pack_id")]
    whole = rows.filter("full > 0").withColumn("salt", F.pmod("hash", salts))
    parts = _ranges(whole.groupBy("pack_id", "salt").agg(F.sum("full").alias("pieces")), ["pack_id", "salt"], "pieces")
    upto = F.sum("full").over(W.partitionBy("pack_id", "salt").orderBy("doc_id").rowsBetween(W.unboundedPreceding, 0)) - F.col("full")
    first = F.create_map(*(F.lit(x) for p, plan in plans.items() for x in (p, plan.containers)))[F.col("pack_id")].cast("long")
    pieces = whole.withColumn("upto", upto).join(parts, ["pack_id", "salt"])
    pieces = pieces.select("pack_id", "doc_id", F.col("capacity").alias("n_tokens"), (first + F.col("before") + F.col("upto")).alias("base"), F.explode(F.sequence(F.lit(0).cast("long"), F.col("full") - 1)).alias("piece"))
    pieces = pieces.select("pack_id", (F.col("base") + F.col("piece")).alias("container_id"), "doc_id", "piece", "n_tokens")
    return rests.unionByName(pieces)


def pack_documents(documents: DataFrame, packs: DataFrame, folder: str = TOKENIZERS, buckets: int = BUCKETS, mix: bool = True) -> DataFrame:
    """All non-empty documents in containers: pack_id, container_id, place (from 1), doc_id, piece (from 0),
    first_token (in the document), n_tokens, at_token (in the container)."""
    rows = [tuple(r) for r in packs.select("pack_id", "tokenizer", "capacity").distinct().collect()]
    wanted = sorted(r for r in rows if None not in r and r[2] > 0)
    names = sorted({t for _, t, _ in wanted})
    if not names:
        return documents.sparkSession.createDataFrame([], "pack_id long, container_id long, place int, doc_id long, piece long, first_token long, n_tokens long, at_token long")
    counts = checkpointed(token_counts(documents, names, folder))
    each = F.array(*(F.struct(F.lit(int(p)).cast("long").alias("pack_id"), F.col(f"n{names.index(t)}").alias("n")) for p, t, _ in wanted))
    capacities = {int(p): int(c) for p, _, c in wanted}
    sizes = counts.select("doc_id", F.explode(each).alias("x")).select("x.pack_id", "doc_id", "x.n")
    placed = pack_items(sizes, capacities, buckets, mix)
    # a container holds at most its capacity in items, so these groups are bounded
    w = W.partitionBy("pack_id", "container_id").orderBy(F.desc("n_tokens"), "doc_id", "piece")
    cap = F.create_map(*(F.lit(x) for p, c in capacities.items() for x in (p, c)))[F.col("pack_id")].cast("long")
    return placed.select(
        "pack_id", "container_id", F.row_number().over(w).alias("place"), "doc_id", "piece", (F.col("piece") * cap).alias("first_token"), "n_tokens",
        F.coalesce(F.sum("n_tokens").over(w.rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("at_token"),
    )


def fill_report(placed: DataFrame, packs: DataFrame) -> DataFrame:
    """Per pack: containers, documents, tokens, share of the room that is filled, least containers possible by volume."""
    sizes = placed.groupBy("pack_id").agg(F.countDistinct("container_id").alias("n_containers"), F.countDistinct("doc_id").alias("n_documents"), F.sum("n_tokens").alias("n_tokens"))
    p = packs.groupBy("pack_id").agg(F.max("capacity").alias("capacity"))
    least = F.ceil(F.col("n_tokens") / F.col("capacity"))
    return sizes.join(F.broadcast(p), "pack_id").withColumn("least_containers", least).withColumn("filled", F.col("n_tokens") / (F.col("n_containers") * F.col("capacity")))
