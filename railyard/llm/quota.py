"""Sample matching target category proportions.

Method: controlled rounding. For each request a two-way table of fractional quotas (category by stratum) is
made integer by a maximum flow that keeps every cell, both margins and the total at a neighbouring integer;
then each cell gives exactly its quota of rows, those of the smallest random keys.

The strata are a second column (``teacher``), folded to at most STRATA values, so that the table on the
driver is bounded by the number of targets whatever the data. Rows are never gathered by cell: a histogram of
the keys finds, per cell, the slice of keys in which the quota ends; rows below it are taken as they are, and
only the rows of that one slice are ranked.

Defined cases
- traces with the same (task_id, sample_idx) count once, the first by (ingested_at, trace_id); a row with a
  null in that key is its own record.
- null or empty fault, replan, recovery_mode read as none, false, direct; a null template has no category.
- what a category lacks of max(min_rows, floor(sample_size * permille / 1000)) is a column of the two-way table of its
  own (MISSING), which the flow fills beside the strata: a category with a quota there is short and gives all it
  has; one without rows is reported with 0. Nothing is filled up from other categories.
- minimums of small categories are kept at the cost of the others, so that the sample keeps its size; a category
  that is given less than its own target for that reason is reported as below_target, with the reason.
- repeated rows of a request's target count once; a null target or size counts as 0. Empty tables give empty
  results. Columns not named here are ignored.
"""

from __future__ import annotations

from collections import defaultdict, deque
from fractions import Fraction

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from railyard.core import checkpointed, clean_label, hash_unit

STRATA = 16
SLICES = 4096
#: The column of the two-way table that holds what a category lacks.
MISSING = -1
#: What a null or empty label reads as.
DEFAULTS = {"fault": "none", "replan": "false", "recovery_mode": "direct"}


class Flow:
    """Maximum flow by shortest augmenting paths in level graphs, for small integer networks."""

    def __init__(self, n: int):
        self.n = n
        self.to: list[int] = []
        self.cap: list[int] = []
        self.out: list[list[int]] = [[] for _ in range(n)]

    def edge(self, a: int, b: int, cap: int) -> int:
        for x, y, c in ((a, b, cap), (b, a, 0)):
            self.out[x].append(len(self.to))
            self.to.append(y)
            self.cap.append(c)
        return len(self.to) - 2

    def run(self, s: int, t: int) -> int:
        total = 0
        while True:
            level = {s: 0}
            queue = deque([s])
            while queue:
                x = queue.popleft()
                for e in self.out[x]:
                    if self.cap[e] and self.to[e] not in level:
                        level[self.to[e]] = level[x] + 1
                        queue.append(self.to[e])
            if t not in level:
                return total
            at = [0] * self.n
            while pushed := self._push(s, t, level, at):
                total += pushed

    def _push(self, s: int, t: int, level: dict[int, int], at: list[int]) -> int:
        path: list[int] = []
        x = s
        while x != t:
            while at[x] < len(self.out[x]):
                e = self.out[x][at[x]]
                if self.cap[e] and level.get(self.to[e], -1) == level[x] + 1:
                    break
                at[x] += 1
            if at[x] == len(self.out[x]):
                if not path:
                    return 0
                x = self.to[path.pop() ^ 1]
                at[x] += 1
                continue
            path.append(self.out[x][at[x]])
            x = self.to[path[-1]]
        least = min(self.cap[e] for e in path)
        for e in path:
            self.cap[e] -= least
            self.cap[e ^ 1] += least
        return least


def controlled_rounding(table: list[list[Fraction]]) -> list[list[int]]:
    """An integer table in which each cell, row sum, column sum and the total is the floor or ceiling of what it was.

    A feasible circulation with lower bounds always exists (the fractional table is one), so the flow finds it.
    """
    rows, cols = len(table), len(table[0]) if table else 0
    if not rows or not cols:
        return [[] for _ in table]
    s, t, s2, t2 = rows + cols, rows + cols + 1, rows + cols + 2, rows + cols + 3
    flow = Flow(rows + cols + 4)
    need: dict[int, int] = defaultdict(int)

    def bounded(a: int, b: int, x: Fraction) -> int:
        low = x.__floor__()
        need[b] += low
        need[a] -= low
        return flow.edge(a, b, x.__ceil__() - low)

    cells = [[bounded(i, rows + j, table[i][j]) for j in range(cols)] for i in range(rows)]
    for i in range(rows):
        bounded(s, i, sum(table[i], Fraction(0)))
    for j in range(cols):
        bounded(rows + j, t, sum((table[i][j] for i in range(rows)), Fraction(0)))
    bounded(t, s, sum((sum(r, Fraction(0)) for r in table), Fraction(0)))
    wanted = 0
    for x, n in need.items():
        if n > 0:
            flow.edge(s2, x, n)
            wanted += n
        elif n < 0:
            flow.edge(x, t2, -n)
    if flow.run(s2, t2) != wanted:
        raise ArithmeticError("no controlled rounding found")
    return [[table[i][j].__floor__() + flow.cap[cells[i][j] ^ 1] for j in range(cols)] for i in range(rows)]


def shares(rows: list[dict]) -> list[Fraction]:
    """Fractional part of the sample for each category: in the ratio of the targets, none under its min_rows.

    Categories lifted to min_rows keep that; the others share what is left, so the total stays the sample size
    (times the sum of the targets), unless the minimums alone exceed it.
    """
    whole = [Fraction(x["sample_size"] * x["target_permille"], 1000) for x in rows]
    lifted = {i for i, (x, a) in enumerate(zip(rows, whole)) if a < x["min_rows"]}
    while True:
        left = sum(whole, Fraction(0)) - sum(rows[i]["min_rows"] for i in lifted)
        free = sum((a for i, a in enumerate(whole) if i not in lifted), Fraction(0))
        scale = max(Fraction(0), left / free) if free else Fraction(0)
        out = [Fraction(x["min_rows"]) if i in lifted else a * scale for i, (x, a) in enumerate(zip(rows, whole))]
        more = {i for i, x in enumerate(rows) if i not in lifted and out[i] < x["min_rows"]}
        if not more:
            return out
        lifted |= more


def plan_request(targets: list[dict], at_hand: dict[tuple[str, int], int]) -> list[dict]:
    """Quota of each (category, stratum) of one request.

    A category's aim is its share of the sample, at most what is at hand. The aims are
    first rounded to integers that keep the total, then split over the strata as these are at hand, and the
    split is rounded by controlled rounding, so both margins stay. The last column holds what is missing.
    """
    strata = sorted({k for (_, k) in at_hand}) or [0]
    rows = []
    for x in targets:
        have = sum(at_hand.get((x["category"], k), 0) for k in strata)
        rows.append(x | {"have": have, "required": max(x["min_rows"], x["sample_size"] * x["target_permille"] // 1000)})
    aims = [min(a, Fraction(x["have"])) for a, x in zip(shares(rows), rows)]
    whole = [r[0] for r in controlled_rounding([[a] for a in aims])]
    table = [[Fraction(n * at_hand.get((x["category"], k), 0), max(1, x["have"])) for k in strata] + [Fraction(max(0, x["required"] - x["have"]))] for n, x in zip(whole, rows)]
    out = []
    for x, cells in zip(rows, controlled_rounding(table)):
        out += [x | {"stratum": k, "quota": q} for k, q in zip([*strata, MISSING], cells)]
    return out


def category(field: str) -> Column:
    """The cleaned label of a column, or of columns joined by ``|``; null where a part has none."""
    parts = []
    for name in field.split("|"):
        label = F.col(name).cast("string") if name == "replan" else clean_label(name)
        parts.append(F.coalesce(F.lower(label), F.lit(DEFAULTS[name])) if name in DEFAULTS else label)
    return parts[0] if len(parts) == 1 else F.concat(*[p if i == 0 else F.concat(F.lit("|"), p) for i, p in enumerate(parts)])


def distinct_records(traces: DataFrame, fields: dict[str, list[str]], stratum: str) -> DataFrame:
    """One row for each (task_id, sample_idx): trace_id, stratum, and per field the place of its category among those asked for."""
    whole = F.col("task_id").isNotNull() & F.col("sample_idx").isNotNull()
    codes = [F.array_position(F.array(*map(F.lit, known)), category(f)).cast("int").alias(f"c{i}") for i, (f, known) in enumerate(fields.items())]
    row = F.struct("trace_id", F.pmod(F.xxhash64(F.coalesce(clean_label(stratum), F.lit(""))), F.lit(STRATA)).cast("int").alias("stratum"), *codes)
    # the first row of a key is found by an aggregate, which combines before the shuffle and knows no hot key
    return (
        traces.groupBy("task_id", "sample_idx", F.when(~whole, F.col("trace_id")).alias("own"))
        .agg(F.min_by(row, F.struct(F.col("ingested_at").isNull(), "ingested_at", "trace_id")).alias("row"))
        .select("row.*")
    )


def _labels(fields: dict[str, list[str]]) -> Column:
    codes = [F.col(f"c{i}") for i in range(len(fields))] or [F.lit(0)]
    return F.posexplode(F.array(*codes)).alias("field", "code")


def quota_plan(traces: DataFrame, targets: DataFrame, stratum: str) -> tuple[DataFrame, DataFrame, dict[str, list[str]]]:
    """(quota of each request, category and stratum; the distinct records, checkpointed; the fields)."""
    spark = traces.sparkSession
    rows = (
        targets.filter("request_id is not null and category_field is not null and category is not null")
        .groupBy("request_id", "category_field", "category")
        .agg(*(F.coalesce(F.max(c), F.lit(0)).cast("long").alias(c) for c in ("sample_size", "target_permille", "min_rows")))
        .orderBy("request_id", "category")
        .collect()
    )  # the requests: a table of fixed size
    wanted = [r.asDict() for r in rows]
    fields = {f: sorted({r["category"] for r in wanted if r["category_field"] == f}) for f in sorted({r["category_field"] for r in wanted})}
    names = list(fields)
    records = checkpointed(distinct_records(traces, fields, stratum))
    plan: list[dict] = []
    if wanted:
        # at most STRATA rows for each target
        counts = records.select("stratum", _labels(fields)).filter("code > 0").groupBy("field", "code", "stratum").count().collect()
        for request, name in sorted({(r["request_id"], r["category_field"]) for r in wanted}):
            mine = [r for r in wanted if (r["request_id"], r["category_field"]) == (request, name)]
            at_hand = {(fields[name][r["code"] - 1], r["stratum"]): r["count"] for r in counts if r["field"] == names.index(name)}
            plan += [x | {"field": names.index(name), "code": fields[name].index(x["category"]) + 1} for x in plan_request(mine, at_hand)]
    schema = "request_id long, field int, code int, category_field string, category string, stratum int, sample_size long, target_permille long, min_rows long, have long, required long, quota long"
    columns = [c.split()[0] for c in schema.split(", ")]
    return spark.createDataFrame([tuple(x[n] for n in columns) for x in plan], schema), records, fields


def draw(plan: DataFrame, records: DataFrame, fields: dict[str, list[str]], seed: int) -> DataFrame:
    """(request_id, category, trace_id): exactly the quota of each cell, by smallest random key."""
    cells = F.broadcast(plan.filter(f"quota > 0 and stratum <> {MISSING}").select("request_id", "field", "code", "category", "stratum", "quota"))
    rows = records.select("trace_id", "stratum", _labels(fields)).join(cells, ["field", "code", "stratum"])
    rows = rows.withColumn("key", hash_unit("request_id", "trace_id", seed=seed)).withColumn("slice", F.floor(F.col("key") * SLICES).cast("int"))
    cell = ["request_id", "category", "stratum"]
    before = F.coalesce(F.sum("n").over(W.partitionBy(*cell).orderBy("slice").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    ends = rows.groupBy(*cell, "quota", "slice").agg(F.count("*").alias("n")).withColumn("before", before)
    ends = ends.filter("before < quota and before + n >= quota").select(*cell, F.col("slice").alias("last"), (F.col("quota") - F.col("before")).alias("rest"))
    ends = F.broadcast(ends)  # one row for each cell with a quota
    rows = rows.join(ends, cell, "left").filter("last is null or slice <= last")
    sure = rows.filter("last is null or slice < last")
    rank = F.row_number().over(W.partitionBy(*cell).orderBy("key", "trace_id"))
    edge = rows.filter("slice = last").withColumn("rank", rank).filter("rank <= rest")
    out = ["request_id", "category", "trace_id"]
    return sure.select(*out).unionByName(edge.select(*out))


def quota_sample(traces: DataFrame, targets: DataFrame, stratum: str = "teacher", seed: int = 42) -> DataFrame:
    """The sampled rows (request_id, category, trace_id)."""
    return draw(*quota_plan(traces, targets, stratum), seed)


def quota_report(traces: DataFrame, targets: DataFrame, stratum: str = "teacher", seed: int = 42) -> DataFrame:
    """Each request and category with what was asked, is at hand, is missing and was drawn; ``short`` where rows are missing,
    ``below_target`` where less was drawn than asked, with the ``reason``."""
    plan, records, fields = quota_plan(traces, targets, stratum)
    drawn = draw(plan, records, fields, seed).groupBy("request_id", "category").agg(F.count("*").alias("n_given"))
    keys = ["request_id", "category_field", "category", "sample_size", "target_permille", "min_rows"]
    asked = plan.groupBy(*keys).agg(F.max("have").alias("n_available"), F.max("required").alias("n_required"), F.sum(F.expr(f"if(stratum = {MISSING}, quota, 0)")).alias("n_missing"), F.sum(F.expr(f"if(stratum = {MISSING}, 0, quota)")).alias("n_planned"))
    out = asked.join(drawn, ["request_id", "category"], "left").na.fill(0, ["n_given"])
    # the report is of the sample drawn: one that is not as planned is an error
    kept = F.when(F.col("n_given") == F.col("n_planned"), F.lit(True)).otherwise(F.raise_error(F.lit("the sample drawn is not as planned")).cast("boolean"))
    out = out.withColumn("short", kept & (F.col("n_missing") > 0)).withColumn("below_target", F.col("n_given") < F.col("n_required"))
    reason = F.when(F.col("short"), "too few at hand").when(F.col("below_target"), "minimums of other categories")
    return out.select(*keys, "n_available", "n_required", "n_missing", "n_given", "short", "below_target", reason.alias("reason"))
