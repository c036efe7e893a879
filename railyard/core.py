"""Helpers that every part of the engine shares."""

from __future__ import annotations

import os
import tempfile
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The parquet table ``name`` of a data folder."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def clean_label(col: Column | str) -> Column:
    """Trimmed, lower case, blanks and ``-`` between words read as ``_``; an empty label is null."""
    c = F.col(col) if isinstance(col, str) else col
    c = F.lower(F.regexp_replace(c, r"(?U)^\s+|\s+$", ""))
    c = F.regexp_replace(c, r"(?U)[\s-]+", "_")
    return F.when(c != "", c)


def shared_folder(spark: SparkSession, purpose: str = "") -> str:
    """The folder that the session's ``spark.checkpoint.dir`` names, or one below it.

    Where it is unset, a session on one machine (a local master, as in tests) gets a folder of its own; on a cluster
    that would lie on one machine only, so there it is an error.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir is unset: name a folder that all executors share")
        folder = os.path.join(tempfile.gettempdir(), "railyard")
    return os.path.join(folder, purpose) if purpose else folder


def checkpointed(df: DataFrame) -> DataFrame:
    """``df`` written to the shared checkpoint folder, so that a lost executor costs no recomputation."""
    sc = df.sparkSession.sparkContext
    if not sc._jsc.sc().getCheckpointDir().isDefined():
        sc.setCheckpointDir(shared_folder(df.sparkSession))
    return df.checkpoint(eager=True)


def spread(df: DataFrame) -> DataFrame:
    """A table scan in at least as many partitions as there are cores, for operators whose work is in Python.

    Only a scan of fewer splits than cores (one small file) is moved; a large table is read as it lies.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def hash_unit(*cols: Column | str, seed: int = 42) -> Column:
    """A number in (0, 1) that depends on the seed and the key only, the same at every layout of the data."""
    h = F.xxhash64(F.lit(seed), *cols)
    return (F.shiftrightunsigned(h, 11).cast("double") + F.lit(0.5)) * F.lit(2.0**-53)


def bound(value: Column, f: Callable[[Column], Column]) -> Column:
    """f(value) with the value computed once.

    An expression used inside a lambda is computed anew for each element; as a lambda's own variable it is not.
    """
    return F.element_at(F.transform(F.array(value), f), 1)
