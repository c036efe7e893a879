"""Readers with line numbers, settings, fingerprints, caps, masks, schemas and scores."""

import json

import pytest
from pyspark.sql import functions as F

from railyard.core import shared_folder
from railyard.functions.values import function_definition, leaf_numbers, scored, without_null_branch
from railyard.operators import dialogs, masks, sampling, text
from railyard.sources import readers, writers


def test_line_numbers_and_errors(spark, tmp_path):
    (tmp_path / "a.jsonl").write_text('{"x": 1}\n\n{"x": 2\n{"x": 3}\n')
    (tmp_path / "b.jsonl").write_text("".join(f'{{"x": {i}}}\n' for i in range(2000)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2000")
    try:
        got = readers.read_jsonl_numbered(spark, str(tmp_path), "x int").select(F.substring_index("file", "/", -1).alias("f"), "line", "r.x", "error").collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    a = sorted((r["line"], r["x"], r["error"]) for r in got if r["f"] == "a.jsonl")
    assert [(n, x) for n, x, _ in a] == [(1, 1), (3, None), (4, 3)] and a[1][2].startswith("Expecting") and a[0][2] is None
    assert sorted((r["line"], r["x"]) for r in got if r["f"] == "b.jsonl") == [(i + 1, i) for i in range(2000)]


def test_settings_and_files(tmp_path):
    (tmp_path / "a.toml").write_text("[x]\ny = 1\n")
    (tmp_path / "b.json").write_text('{"x": {"y": 1}}')
    assert readers.read_config(str(tmp_path / "a.toml")) == readers.read_config(str(tmp_path / "b.json"))
    files = [str(tmp_path / "a.toml"), str(tmp_path / "b.json")]
    one = readers.files_fingerprint(files)
    assert one == readers.files_fingerprint(files) != readers.files_fingerprint(files[::-1])
    (tmp_path / "results").mkdir()
    (tmp_path / "results" / "results.json").write_text("{}")
    assert readers.find_results(str(tmp_path), "results").endswith("results/results.json") and readers.find_results(str(tmp_path), "b").endswith("b.json")
    with pytest.raises(FileNotFoundError):
        readers.find_results(str(tmp_path), "none")


def test_whole_files(spark, tmp_path):
    (tmp_path / "a.txt").write_text("one\ntwo\n")
    (tmp_path / "bad.json").write_text("{")
    (tmp_path / "good.toml").write_text("a = 1")
    assert readers.read_text_file(spark, str(tmp_path / "a.txt")).collect()[0][0] == "one\ntwo\n"
    assert {r["path"].rsplit("/", 1)[1]: (r["passed"], r["error"]) for r in readers.snapshot_checks(spark, str(tmp_path)).collect()} == {"bad.json": (False, "JSONDecodeError"), "good.toml": (True, None)}


def test_canonical_rows_and_metrics(spark, tmp_path):
    df = spark.createDataFrame([(2, "ä", None), (1, "b", 3)], "b int, a string, c int")
    one = writers.write_canonical(df, ["b"], str(tmp_path / "one"))
    assert one["rows"] == 2 and one == writers.write_canonical(df.repartition(3).select("c", "a", "b"), ["b"], str(tmp_path / "two"))
    lines = [r[0] for r in spark.read.text(str(tmp_path / "one")).collect()]
    assert sorted(lines) == ['{"a":"b","b":1,"c":3}', '{"a":"ä","b":2,"c":null}']
    rows = writers.long_metrics(df, "r", ["a"])
    assert writers.log_metrics(rows, str(tmp_path / "m")) and not writers.log_metrics(rows.select(F.raise_error(F.lit("no")).alias("x")), str(tmp_path / "n"))
    assert writers.append_missing(df, str(tmp_path / "t"), ["b"]) == 2 and writers.append_missing(df, str(tmp_path / "t"), ["b"]) == 0


def test_a_group_without_a_cap_is_an_error(spark):
    df = spark.createDataFrame([("x", 1), ("y", 2), ("y", 3)], "g string, i int")
    caps = spark.createDataFrame([("x", 5), ("y", None)], "g string, cap int")
    assert {(r["i"], r["cap"]) for r in sampling.with_caps(df, caps, "g", "cap").collect()} == {(1, 5), (2, None), (3, None)}
    with pytest.raises(Exception, match="no cap for g y"):
        sampling.with_caps(df, caps.filter("g = 'x'"), "g", "cap").collect()


def test_replace_exactly(spark):
    df = spark.createDataFrame([("one two",)], "t string")
    assert df.select(dialogs.replace_exactly(F.col("t"), "two", "2")).collect()[0][0] == "one 2"
    for literal in ("o", "three"):
        with pytest.raises(Exception, match="expected"):
            df.select(dialogs.replace_exactly(F.col("t"), literal, "x")).collect()


def test_masks(spark):
    df = spark.createDataFrame([([1, 4, 50, 9, 1, 3, 60, 9, 1, 4, 70, 71, 9], 8), ([1, 4, 5], 0), (None, 0)], "t array<int>, e int")
    labels = masks.span_labels([1, 4], 9)
    got = [r[0] for r in df.select(labels("t", "e")).collect()]
    assert got == [[-100] * 10 + [70, 71, 9], [-100, -100, 5], None]
    assert df.select(masks.padded(F.col("t"), F.lit(5), -100)).collect()[1][0] == [1, 4, 5, -100, -100]
    assert df.select(masks.cut_text(F.lit("abc"), 2), masks.cut_list(F.lit([1, 2, 3]), 2)).collect()[0] == ("ab", [1, 2])


def test_containment_in_blocks(spark, monkeypatch):
    corpus = spark.createDataFrame([(i, t) for i, t in enumerate(["a long needle that stands in this text here", "two words onlyhereandnowherelse verylongwordofmany", None, ""])], "id long, t string")
    needles = spark.createDataFrame([(1, "needle that stands in this text"), (2, "needle that stands in this text"), (3, "onlyhereandnowherelse verylongword"), (4, "  A  LONG needle that\tstands in this "), (5, "not there at all in any of the texts")], "n long, s string")
    want = {(0, 1), (0, 2), (0, 4), (1, 3)}
    for most in (16_000_000, 1):
        monkeypatch.setattr(text, "NEEDLES", most)
        got = [tuple(r) for r in text.containment(corpus, F.col("t"), "id", needles, "n", F.col("s")).collect()]
        assert set(got) == want and len(got) == len(want)
    assert text.containment(corpus, F.col("t"), "id", needles.limit(0), "n", F.col("s")).count() == 0


def test_schemas_and_leaves():
    assert function_definition({"name": "f", "parameters": {"type": "dict", "properties": {}}})["function"] == {"name": "f", "description": "", "parameters": {"type": "object", "properties": {}}}
    flat = without_null_branch({"type": "object", "properties": {"a": {"anyOf": [{"type": "null"}, {"type": "string", "title": "x"}], "title": "A"}, "b": {"type": "integer"}}})
    assert flat["properties"] == {"a": {"type": "string", "title": "A"}, "b": {"type": "integer"}}
    assert leaf_numbers({"a": [1, [2.5, "x", True]], "b": {"c": 3}}) == [1, 2.5, 3]


def test_scores_never_raise():
    def score(rows):
        return {"score": len(rows) / len(rows), "note": "x", "n": len(rows)}

    assert scored(score, json.dumps([1, 2])) == {"score": 1.0, "n": 2.0} and scored(score, "[broken") == {"score": 0.0} and scored(score, None) == {"score": 0.0}


def test_a_cluster_needs_a_shared_folder(spark):
    class Session:
        class conf:
            get = staticmethod(lambda key, default=None: default)

        class sparkContext:
            master = "spark://somewhere:7077"

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_folder(Session)
    Session.sparkContext.master = "local[4]"
    assert shared_folder(Session)
