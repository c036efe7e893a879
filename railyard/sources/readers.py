"""Readers: CSV, JSON lines (strict and tolerant), JSON documents, headed result files, whole files."""

from __future__ import annotations

import hashlib
import json
import os
import tomllib

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window as W


def read_csv(spark: SparkSession, path: str, columns: list[str] | None = None) -> DataFrame:
    """CSV with a header in UTF-8; every column is text. Columns are found by name, whatever their order."""
    df = spark.read.option("header", True).option("multiLine", True).option("escape", '"').option("inferSchema", False).csv(path)
    return df.select(*columns) if columns else df


def read_jsonl(spark: SparkSession, path: str | list[str], schema: str | T.StructType) -> DataFrame:
    """JSON lines; blank lines are skipped, a bad line ends the read with an error."""
    return spark.read.schema(schema).option("mode", "FAILFAST").json(path)


def read_jsonl_tolerant(spark: SparkSession, path: str | list[str], schema: str | T.StructType) -> DataFrame:
    """JSON lines with, per row, the file and the raw text of a bad line in ``_corrupt`` (null for good ones)."""
    s = T._parse_datatype_string(schema) if isinstance(schema, str) else schema
    s = T.StructType([*s.fields, T.StructField("_corrupt", T.StringType())])
    df = spark.read.schema(s).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_corrupt").json(path)
    return df.withColumn("_file", F.input_file_name())


def read_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """The non-blank lines of text files with file and line number (from 1, blank lines counted): (file, line, text).

    A file may be read in several parts: a line's number is its place in the part plus the lines of the parts before, so no
    file has to fit into a task. The parts are a small table.
    """
    at = F.monotonically_increasing_id()
    rows = spark.read.text(path).select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("_part"), F.col("value").alias("text")).withColumn("_at", at)
    before = F.sum("_n").over(W.partitionBy("file").orderBy("_part").rowsBetween(W.unboundedPreceding, -1))
    parts = rows.groupBy("file", "_part").agg(F.min("_at").alias("_first"), F.count("*").alias("_n")).withColumn("_before", F.coalesce(before, F.lit(0)))
    numbered = rows.join(parts, ["file", "_part"]).withColumn("line", F.col("_at") - F.col("_first") + F.col("_before") + 1)
    return numbered.filter(F.trim("text") != "").select("file", "line", "text")


def read_jsonl_numbered(spark: SparkSession, path: str | list[str], schema: str) -> DataFrame:
    """JSON lines as (file, line, r, error): the record, or what is wrong with the line."""

    def of(text: str) -> str | None:
        try:
            json.loads(text)
        except (ValueError, RecursionError) as e:
            return str(e) or type(e).__name__
        return None

    @F.pandas_udf("string")
    def error(texts: pd.Series) -> pd.Series:
        return texts.map(of)

    lines = read_lines(spark, path).withColumn("error", error("text"))
    return lines.select("file", "line", F.when(F.col("error").isNull(), F.from_json("text", schema)).alias("r"), "error")


def read_config(path: str) -> dict:
    """Settings of a .json or .toml file, or of a .yaml file where a reader for that is installed; on the driver."""
    with open(path, encoding="utf-8") as f:
        text = f.read()
    if path.endswith(".toml"):
        return tomllib.loads(text)
    if path.endswith((".yaml", ".yml")):
        try:
            import yaml
        except ImportError as e:
            raise ValueError(f"no reader for {path}") from e
        return yaml.safe_load(text) or {}
    return json.loads(text)


def files_fingerprint(paths: list[str]) -> str:
    """Digest of an ordered list of files by name and bytes."""
    digest = hashlib.sha256()
    for p in paths:
        digest.update(os.path.basename(p).encode() + b"\0")
        with open(p, "rb") as f:
            while part := f.read(1 << 20):
                digest.update(part)
        digest.update(b"\0")
    return digest.hexdigest()


def split_broken(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(good rows; per file the number of bad lines and the first of them)."""
    good = df.filter("_corrupt is null").drop("_corrupt", "_file")
    return good, df.groupBy("_file").agg(F.count_if(F.col("_corrupt").isNotNull()).alias("n_broken"), F.min("_corrupt").alias("example"))


def read_map(spark: SparkSession, path: str, value_schema: str) -> DataFrame:
    """A JSON document that maps ids to records, as rows (id, the record's fields)."""
    text = spark.read.text(path, wholetext=True)
    m = F.explode(F.from_json("value", f"map<string,struct<{value_schema}>>")).alias("id", "r")
    return text.select(m).select("id", "r.*")


def read_headed(spark: SparkSession, folder: str, header_schema: str, row_schema: str, suffix: str = ".json") -> tuple[DataFrame, DataFrame]:
    """Result files at any depth, the first line a header: (headers, rows), each with the group (first folder) and the category.

    The category is the file's name without prefix up to the last ``_v<digits>_`` and without the suffix.
    A header is told by position 0 in its file, so no order across files is needed.
    """
    lines = spark.read.text(folder, wholetext=True, recursiveFileLookup=True, pathGlobFilter=f"*{suffix}")
    base = os.path.abspath(folder).rstrip("/") + "/"
    path = F.col("_metadata.file_path")
    relative = F.substring_index(path, base, -1)
    name = F.regexp_replace(F.substring_index(relative, "/", -1), rf"^(?:.*_v\d+_)?(.*){suffix.replace('.', '[.]')}$", "$1")
    group = F.when(F.contains(relative, F.lit("/")), F.split_part(relative, F.lit("/"), F.lit(1)))
    rows = lines.select(group.alias("group"), name.alias("category"), F.posexplode(F.filter(F.split("value", "\r?\n"), lambda x: F.trim(x) != "")).alias("line", "text"))
    headers = rows.filter("line = 0").select("group", "category", F.from_json("text", header_schema).alias("h")).select("group", "category", "h.*")
    return headers, rows.filter("line > 0").select("group", "category", "line", F.from_json("text", row_schema).alias("r")).select("group", "category", "line", "r.*")


def find_results(folder: str, name: str) -> str:
    """``name/results.json`` or ``name.json`` under the folder, the former first."""
    for p in (os.path.join(folder, name, "results.json"), os.path.join(folder, f"{name}.json")):
        if os.path.exists(p):
            return p
    raise FileNotFoundError(f"no results for {name!r} in {folder}")


def snapshot_checks(spark: SparkSession, folder: str) -> DataFrame:
    """Whether each .json and .toml file under the folder parses: (path, passed, error). The files are read where they lie."""

    def of(path: str, content: bytes) -> str | None:
        try:
            text = bytes(content).decode("utf-8")
            tomllib.loads(text) if path.endswith(".toml") else json.loads(text)
        except (ValueError, RecursionError) as e:
            return type(e).__name__
        return None

    @F.pandas_udf("string")
    def problem(paths: pd.Series, contents: pd.Series) -> pd.Series:
        return pd.Series([of(p, c) for p, c in zip(paths, contents)], dtype=object)

    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(folder).filter(F.col("path").rlike(r"\.(json|toml)$"))
    checked = files.select("path", problem("path", "content").alias("error"))
    return checked.withColumn("passed", F.col("error").isNull())


def file_sizes(spark: SparkSession, folder: str) -> DataFrame:
    """(path, length) of all files; contents are not read."""
    return spark.read.format("binaryFile").option("recursiveFileLookup", True).load(folder).select("path", "length")


def read_text_file(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path, wholetext=True)
