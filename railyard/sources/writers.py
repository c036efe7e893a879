"""Writers: JSON lines, parquet, text, manifests, metrics, guarded switches."""

from __future__ import annotations

import json
import os
import tempfile

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F


def write_jsonl(df: DataFrame, path: str, keep_nulls: bool = True) -> None:
    """JSON lines, replacing what is there; letters stay as they are, keys of null values stay if ``keep_nulls``."""
    df.write.mode("overwrite").option("ignoreNullFields", not keep_nulls).json(path)


def write_parquet(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    w = df.write.mode("overwrite")
    (w.partitionBy(*partition_by) if partition_by else w).parquet(path)


def write_ids(df: DataFrame, column: str, path: str) -> None:
    """One id a line."""
    df.select(F.col(column).cast("string")).write.mode("overwrite").text(path)


def append_missing(df: DataFrame, path: str, keys: list[str]) -> int:
    """Appends the rows whose keys are not in the folder yet; how many. A repeated run adds nothing."""
    spark = df.sparkSession
    try:
        there = spark.read.parquet(path).select(*keys).distinct()
    except Exception as e:  # noqa: BLE001 - the folder does not exist yet
        if "PATH_NOT_FOUND" not in str(e):
            raise
        there = None
    todo = df if there is None else df.join(there, keys, "left_anti")
    seen = Observation()
    todo.dropDuplicates(keys).observe(seen, F.count(F.lit(1)).alias("n")).write.mode("append").parquet(path)
    return seen.get["n"]


def _replace(path: str, text: str) -> None:
    folder = os.path.dirname(os.path.abspath(path))
    os.makedirs(folder, exist_ok=True)
    fd, tmp = tempfile.mkstemp(dir=folder)
    with os.fdopen(fd, "w", encoding="utf-8") as f:
        f.write(text)
    os.replace(tmp, path)


def write_manifest(values: dict, path: str) -> None:
    """Sorted keys, no time stamps: equal values give equal bytes. Not through a link."""
    if os.path.islink(path):
        raise ValueError(f"{path} is a link; write the file it stands for and switch the link last")
    _replace(path, json.dumps(values, sort_keys=True, ensure_ascii=False, indent=2) + "\n")


def merge_manifest(values: dict[str, dict], path: str) -> dict[str, dict]:
    """Joins new entries into a manifest; ``validated`` of an old entry stays only if its revision is the same."""
    old = json.load(open(path, encoding="utf-8")) if os.path.exists(path) else {}
    out = dict(old)
    for name, entry in values.items():
        before = old.get(name, {})
        keep = {"validated": before["validated"]} if "validated" in before and before.get("revision") == entry.get("revision") else {}
        out[name] = keep | entry
    write_manifest(out, path)
    return out


def switch_link(link: str, target: str) -> None:
    """Points a link to a finished file in one step."""
    if os.path.exists(link) and not os.path.islink(link):
        raise ValueError(f"{link} is no link")
    if not os.path.exists(os.path.join(os.path.dirname(os.path.abspath(link)), target)):
        raise FileNotFoundError(target)
    tmp = f"{link}.new"
    if os.path.islink(tmp):
        os.remove(tmp)
    os.symlink(target, tmp)
    os.replace(tmp, link)


def long_metrics(df: DataFrame, run: str, keys: list[str]) -> DataFrame:
    """A report as rows (run, key, metric, value) for a tracker."""
    measures = [c for c, t in df.dtypes if c not in keys and t in ("int", "bigint", "double", "float")]
    pairs = F.array(*(F.struct(F.lit(m).alias("metric"), F.col(m).cast("double").alias("value")) for m in measures))
    key = F.concat_ws("/", *(F.coalesce(F.col(k).cast("string"), F.lit("")) for k in keys))
    return df.select(F.lit(run).alias("run"), key.alias("key"), F.explode(pairs).alias("p")).select("run", "key", "p.metric", "p.value")


def log_metrics(rows: DataFrame, path: str) -> bool:
    """Appends metric rows; best effort: whether it went well, never an error, since a report must not end a run."""
    try:
        rows.write.mode("append").parquet(path)
    except Exception:  # noqa: BLE001 - that is what best effort means
        return False
    return True


def write_canonical(df: DataFrame, keys: list[str], path: str) -> dict:
    """Rows as JSON lines with sorted keys in the order of ``keys``, and a manifest of the row count and an order-free digest; equal rows give equal bytes."""
    rows = df.select(*sorted(df.columns))
    text = F.to_json(F.struct(*(F.col(c) for c in sorted(df.columns))), {"ignoreNullFields": "false"})
    rows.withColumn("_json", text).orderBy(*keys, "_json").select("_json").write.mode("overwrite").text(path)
    digest = F.sum(F.conv(F.substring(F.sha2(text, 256), 1, 15), 16, 10).cast("decimal(38,0)"))
    r = rows.agg(F.count("*").alias("n"), digest.alias("d")).collect()[0]
    return {"rows": r["n"], "digest": f"{int(r['d'] or 0) % 16**16:016x}"}


def markdown(df: DataFrame, order: list[str], most: int = 500) -> str:
    """A report as a Markdown table; reports are small, more than ``most`` rows are an error."""
    rows = df.orderBy(*order).limit(most + 1).collect()
    if len(rows) > most:
        raise ValueError(f"a report of more than {most} rows")
    cell = lambda v: "-" if v is None else f"{v:.3f}" if isinstance(v, float) else str(v)
    lines = ["| " + " | ".join(df.columns) + " |", "|" + "-|" * len(df.columns)]
    return "\n".join(lines + ["| " + " | ".join(map(cell, r)) + " |" for r in rows]) + "\n"


def replace_section(document: str, heading: str, body: str) -> str:
    """The document with the text between a heading and the next of its level replaced; appended if missing."""
    level = heading.split(" ")[0]
    lines = document.split("\n")
    if heading not in lines:
        return document.rstrip("\n") + f"\n\n{heading}\n\n{body.strip()}\n"
    at = lines.index(heading)
    end = next((i for i in range(at + 1, len(lines)) if lines[i].startswith(level + " ")), len(lines))
    return "\n".join([*lines[: at + 1], "", body.strip(), "", *lines[end:]])


