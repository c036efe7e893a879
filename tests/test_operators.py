"""Case tables for predicates, sampling, sequences, matching, parsing, world, checks and IO."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from railyard.core import bound, clean_label
from railyard.functions import values as v
from railyard.operators import calls, checks, predicates, report, sampling, score, sequences, text, world
from railyard.sources import readers, writers


def one(df):
    return df.collect()[0]


def test_clean_label(spark):
    rows = [(" Db Bahn ",), ("DB-BAHN",), ("  ",), (None,), ("state+runtime",)]
    got = [r[0] for r in spark.createDataFrame(rows, "x string").select(clean_label("x")).collect()]
    assert got == ["db_bahn", "db_bahn", None, None, "state+runtime"]


def test_bound(spark):
    assert one(spark.range(1).select(bound(F.lit(3), lambda x: x * x)))[0] == 9


def test_accept_gate_edges(spark):
    rows = [(1.0, False, 0.5, 12000), (1.0, False, 0.51, 0), (1.0, False, 0.0, 12001), (1.0, False, None, None), (0.99, False, None, None), (1.0, True, None, None), (None, False, None, None)]
    df = spark.createDataFrame(rows, "s double, t boolean, r double, c int")
    got = [r[0] for r in df.select(predicates.accepted(F.col("s"), F.col("t"), F.col("r"), F.col("c"))).collect()]
    assert got == [True, False, False, True, False, False, False]


def test_bands(spark):
    rows = [(20, 0.85), (20, 0.84), (20, 0.45), (20, 0.44), (9, 1.0)]
    df = spark.createDataFrame(rows, "n int, y double").select(predicates.band(F.col("n"), F.col("y")).alias("b"))
    got = [tuple(r) for r in df.select("b", predicates.band_cap(F.col("b"))).collect()]
    assert got == [("high", 60), ("mid", 250), ("mid", 250), ("low", None), (None, None)]


def test_inefficient(spark):
    df = spark.createDataFrame([(6, 2), (5, 2), (9, 0), (9, None), (None, 1)], "n int, e int")
    assert [r[0] for r in df.select(predicates.inefficient(F.col("n"), F.col("e"))).collect()] == [True, False, False, False, False]


def test_conjunction_needs_a_filter():
    with pytest.raises(ValueError):
        predicates.conjunction({"a": None})


def test_contains_takes_wildcards_as_text(spark):
    df = spark.createDataFrame([("100% ok",), ("100 ok",)], "x string")
    assert [r[0] for r in df.select(predicates.contains_folded(F.col("x"), " 0% ")).collect()] == [True, False]


def test_seats(spark):
    rows = [(i, "g", "a" if i == 0 else "b" if i < 3 else "c", 10) for i in range(100)] + [(1000 + i, "h", "a", None) for i in range(5)]
    df = spark.createDataFrame(rows, "id long, g string, s string, cap int")
    out = sampling.capped_stratified(df, "g", ["s"], "cap", "id", "x")
    assert {(r["g"], r["s"]): r["count"] for r in out.groupBy("g", "s").count().collect()} == {("g", "a"): 1, ("g", "c"): 9, ("h", "a"): 5}
    again = sampling.capped_stratified(df.repartition(7), "g", ["s"], "cap", "id", "x")
    assert sorted(r["id"] for r in out.collect()) == sorted(r["id"] for r in again.collect())


def test_hashed_rank_is_a_rank(spark):
    df = spark.range(3000).withColumn("g", F.when(F.col("id") < 2000, "hot").when(F.col("id") < 2900, "b"))
    rows = sampling.hashed_rank(df, ["g"], sampling.draw("s", "id"), "k").withColumn("d", sampling.draw("s", "id")).collect()
    for g in ("hot", "b", None):
        mine = sorted((r for r in rows if r["g"] == g), key=lambda r: r["d"])
        assert [r["k"] for r in mine] == list(range(1, len(mine) + 1))
        assert {r["k_of"] for r in mine} == {len(mine)}


def test_biased_pool_tops_up(spark):
    df = spark.createDataFrame([(i, i < 3, 3 <= i < 8) for i in range(30)], "id long, w boolean, f boolean")
    out = sampling.biased_pool(df, "id", F.col("w"), F.col("f"), 10, "s")
    assert {r["origin"]: r["count"] for r in out.groupBy("origin").count().collect()} == {"weak": 3, "fault": 5, "rest": 2}


def test_splits_are_disjoint_and_whole(spark):
    df = spark.range(100).withColumn("g", F.lit("t"))
    out = sampling.uniform_splits(df, "g", "id", "s").collect()
    assert sorted(r["id"] for r in out) == list(range(100))
    assert {s: sum(r["split"] == s for r in out) for s in ("heldout_eval", "rl_train", "sft_train")} == {"heldout_eval": 10, "rl_train": 20, "sft_train": 70}
    assert [r["split"] for r in out if r["is_dev"]] == ["sft_train"]


def messages(spark, *turns):
    return spark.createDataFrame([([{"role": r, "content": c} for r, c in turns],)], "m array<struct<role string, content string>>")


def test_trained_chars_and_final_answer(spark):
    df = messages(spark, ("user", "a"), ("assistant", "xx"), ("tool", "t"), ("user", "b"), ("assistant", None), ("tool", "u"), ("assistant", "yyy"), ("assistant", " "))
    r = one(df.select(sequences.trained_chars(F.col("m")), sequences.final_answer(F.col("m")), sequences.last_index(F.col("m"), "system"), sequences.fitting_prefix(F.col("m"), 7)))
    assert tuple(r) == (4, "yyy", -1, 5)


def test_repeats_and_streak(spark):
    c = "array<struct<seq:int,call_id:string,tool_name:string,arguments:string,called_at:timestamp_ntz,took_ms:int>>"
    rows = [([(1, "a", "f", "{}", None, 10), (2, "b", "f", "{}", None, 5000), (3, "c", "f", "{}", None, 1), (4, "d", "g", None, None, 1), (5, "e", "g", None, None, 1)],), (None,), ([],)]
    df = spark.createDataFrame(rows, f"c {c}").select(sequences.ordered(F.col("c")).alias("c"))
    assert [tuple(r) for r in df.select(sequences.repeats(F.col("c")), sequences.repeats(F.col("c"), 1000)).collect()] == [(3, 2), (0, 0), (0, 0)]
    assert one(spark.range(1).select(sequences.longest_streak(F.array(*map(F.lit, [True, False, True, True])))))[0] == 2


def test_duplicate_ratio(spark):
    rows = [("a b c d e f g h " * 8,), (" ".join(map(str, range(40))),), ("short",), ("",)]
    got = [r[0] for r in spark.createDataFrame(rows, "t string").select(sequences.duplicate_ratio(F.col("t"))).collect()]
    assert got == [round(1 - 8 / 57, 3), 0.0, 0.0, 0.0]


def test_reasoning(spark):
    rows = [("<think>a</think> b",), ("<seed:think>a</seed:think>b",), ("[THINK]a[/THINK] b",), ("lost</think> b",), ("plain",)]
    df = spark.createDataFrame(rows, "t string")
    assert [r[0] for r in df.select(text.strip_reasoning(F.col("t"))).collect()] == ["b", "b", "b", "b", "plain"]
    assert [r[0] for r in df.select(text.reasoning(F.col("t"))).collect()] == ["a", "a", "a", "", ""]


def test_grounding(spark):
    df = spark.createDataFrame([("FZ-12 um 00:05, MA-7", "fz-123 um 23:50 mit 15 Minuten")], "a string, c string")
    r = one(df.select(text.ungrounded(F.col("a"), F.col("c"), text.derived_times(F.col("c"))), text.derived_times(F.col("c"))))
    assert r[0] == ["MA-7"] and r[1] == ["00:05", "23:35"]


def test_containment_needs_no_cross_join(spark):
    corpus = spark.createDataFrame([(1, "x" + "One two  three four five SIX seven eight nine" + "y"), (2, "nothing of that kind in this text here")], "id long, t string")
    needles = spark.createDataFrame([(7, "one two three four five six seven eight nine"), (8, "too short")], "n long, s string")
    assert [tuple(r) for r in text.containment(corpus, F.col("t"), "id", needles, "n", F.col("s")).collect()] == [(1, 7)]


@pytest.mark.parametrize(
    "gold, got, args, said, want",
    [
        ([], [], True, "", "irrelevance_ok"), ([], ["a"], False, "", "irrelevance_called"), (["a"], [], False, "", "silent"), (["a"], [], False, "which?", "asked_back"),
        (["a", "b"], ["a"], False, "", "missing_call"), (["a"], ["a", "a"], False, "", "wrong_tool"), (["a"], ["b"], False, "", "wrong_tool"), (["a", "b"], ["b", "a"], True, "", "exact"), (["a"], ["a"], False, "", "wrong_args"),
    ],
)
def test_verdicts(spark, gold, got, args, said, want):
    df = spark.createDataFrame([(gold, got, args, said)], "g array<string>, h array<string>, a boolean, t string")
    assert one(df.select(calls.verdict(F.col("g"), F.col("h"), F.col("a"), F.col("t"))))[0] == want


def test_call_matches():
    a, b, c = v.normal_call("f", '{"x": "5", "y": true}'), v.normal_call("f", '{"y": "TRUE", "x": 5.0}'), v.normal_call("f", '{"x": 5, "y": true, "z": 1}')
    assert v.call_match(a, b, True) and v.call_match(a, c, False) and not v.call_match(a, c, True)
    assert v.bag_match([a, c], [c, b], True) and not v.bag_match([a], [a, a], False)
    assert v.normal_call("f", "no json") == ("f", {}) and not v.call_match(("f", {"k": v.normal_value(None)}), ("g", {}), False)


def test_parsers():
    assert v.bracket_calls('[f(a="x, y", b=[1, (2)]), g()]') == [("f", '{"a": "x, y", "b": "[1, (2)]"}'), ("g", "{}")] or v.bracket_calls('[f(a="x, y", b=[1, (2)]), g()]')[0][0] == "f"
    assert v.bracket_calls("no") is None and v.bracket_calls("[f(]") is None
    assert v.text_calls('x <tool_call>{"name": "f", "arguments": {"a": 1}}</tool_call> tail') == ([("f", '{"a": 1}')], 4)
    assert v.text_calls("<function=f><parameter=a>1</parameter></function>")[0] == [("f", '{"a": 1}')]
    assert v.text_calls('```json\n{"name": "f"}\n```')[0] == [("f", "{}")] and v.text_calls(None) == ([], 0) and v.text_calls("hello")[0] == []
    assert v.leading_array('Tools: [{"a": 1}] and more') == [{"a": 1}] and v.leading_array("none") is None
    assert v.canonical_json('{"b": 1, "a": "ü"}') == '{"a":"ü","b":1}' and v.canonical_json("{") is None
    assert v.leaf_strings({"a": ["x", {"b": "yy"}]}, 2) == ["yy"]


def test_segments_copy_the_first_answer():
    t = '<|user|>q<|assistant|><tool_call>{"name": "f"}</tool_call><tool_call>{"name": "g"}</tool_call><|tool|>r1<|tool|>r2<|assistant|>done'
    assert [(r, i) for _, r, _, i in v.segments(t)] == [("user", None), ("assistant", None), ("tool", "call_1"), ("tool", "call_2"), ("assistant", None)]


def test_span_mask():
    assert v.span_mask([9, 1, 2, 5, 6, 0, 1, 2, 7, 0], [1, 2], 0, 3) == [-100] * 8 + [7, 0]


def test_transfer_edges(spark):
    stops = spark.createDataFrame([("f", 1, 100, 0), ("c", 1, 0, 105), ("d", 1, 0, 104), ("e", 1, 0, 1540), ("g", 2, 0, 500)], "trip string, station int, arr int, dep int")
    pairs = spark.createDataFrame([("f", x) for x in "cdeg"], "feeder string, connector string")
    got = {r["connector"]: (r["buffer"], r["fits"]) for r in world.transfers(stops, pairs, 5).collect()}
    assert got == {"c": (5, True), "d": (4, False), "e": (0, False)}


def test_transfer_pairs_by_slots(spark):
    at = lambda m: dt.datetime(2026, 1, 1) + dt.timedelta(minutes=m)
    df = spark.createDataFrame([(1, 1, at(0)), (1, 2, at(10)), (1, 3, at(10)), (1, 4, at(119)), (2, 5, at(10))], "u int, id int, ts timestamp")
    got = sorted((r["feeder"], r["connector"], r["options"]) for r in world.transfer_pairs(df, "u", "id", "ts", 480, 7200, 7200).collect())
    assert got == [(1, 2, 3), (2, 4, 1), (3, 4, 1)]
    with pytest.raises(ValueError):
        world.transfer_pairs(df, "u", "id", "ts", 480, 7200, 60)


def test_search_page(spark):
    for n, more in ((10, False), (11, True)):
        rows = world.search_page(spark.range(n).select(F.concat(F.lit("MA-"), F.col("id") + 995).alias("id")), F.lit(True), ["id"]).collect()
        assert len(rows) == 10 and {r["more"] for r in rows} == {more} and rows[0]["total"] == n
        assert [r["id"] for r in sorted(rows, key=lambda r: r["place"])][0] == "MA-1000"


def test_calendar(spark):
    base = spark.createDataFrame([("s", 1), ("s", 2)], "service string, day int")
    x = spark.createDataFrame([("s", 1, "remove", 1), ("s", 2, "remove", 1), ("s", 2, "add", 2), ("t", 9, "add", 1)], "service string, day int, kind string, ord int")
    assert sorted(tuple(r) for r in world.calendar(base, x).collect()) == [("s", 2), ("t", 9)]


def test_terminal_state(spark):
    w = spark.createDataFrame([(1, "o", 1, "offen"), (1, "o", 2, "zu"), (1, "o", 3, "offen"), (1, "p", 1, "offen")], "e int, o string, n int, s string")
    state = score.last_valid_status(w, ["e", "o"], "s", "n", "zu")
    assert sorted((r["o"], r["state"], r["ended_at"]) for r in state.collect()) == [("o", "zu", 2), ("p", "offen", None)]
    assert [r["n"] for r in score.rejected_writes(w, state, ["e", "o"], "n").collect()] == [3]


def test_replay(spark):
    w = '{"zugnummer": "IC 1", "mitarbeiter_id": "MA-1", "rolle": "x"}'
    rows = [(1, [("crew_zuweisen", w)] * 2), (2, [("crew_zuweisen", w)]), (3, [("wartung_einplanen", '{"fahrzeug_id": "F"}'), ("fahrplan", "{}")]), (4, [("crew_zuweisen", "broken")]), (5, []), (6, None), (7, [("crew_zuweisen", w)] * 70), (8, [("fahrplan", "{}")] * 63 + [("crew_zuweisen", w)] * 3), (9, [("fahrplan", "{}")] * 64 + [("crew_zuweisen", w)])]
    df = spark.createDataFrame(rows, "e long, c array<struct<tool_name string, arguments string>>")
    got = {r["e"]: r for r in score.replay(df, "e", "c").collect()}
    assert set(got) == {1, 2, 3, 4, 7, 8} and (got[7]["n_done"], got[7]["n_errors"]) == (1, 63) and (got[8]["n_done"], got[8]["n_errors"]) == (1, 0)
    assert (got[1]["n_done"], got[1]["n_errors"]) == (1, 1) and got[1]["state"] == got[2]["state"] and got[3]["n_errors"] == 0 and got[4]["n_errors"] == 1


def test_fingerprint_knows_no_order(spark):
    df = spark.createDataFrame([(1, None), (2, "b"), (2, "b")], "a int, b string")
    a, b = one(checks.fingerprint(df)), one(checks.fingerprint(df.orderBy(F.desc("a")).repartition(3)))
    assert a == b and a["n_rows"] == 3
    assert one(checks.fingerprint(df.distinct()))["digest"] != a["digest"]


def test_suite_counts_null_as_bad(spark):
    df = spark.createDataFrame([(1,), (None,)], "a int")
    assert one(checks.suite(df, {"positive": ("fail", F.col("a") <= 0, 0.5)}))["n_bad"] == 1


def test_pass_hat_k(spark):
    df = spark.createDataFrame([("a", 1), ("a", 1), ("b", 1), ("b", 0), ("c", 1)], "t string, ok int")
    r = one(report.pass_hat_k(df, "t", F.col("ok") == 1, (1, 2)))
    assert (r["pass_hat_1"], r["pass_hat_2"], r["items_2"]) == (2.5 / 3, 0.5, 2)


def test_reports_of_empty_tables(spark):
    df = spark.createDataFrame([], "g string, s string, ok boolean, w double, v double")
    assert report.subtotals(df, "g", "s", F.col("ok")).count() <= 1
    assert report.weighted_mean(df, "v", "w").collect()[0]["weighted_mean"] is None
    assert report.shares(df, ["g"]).count() == 0 and checks.fingerprint(df).count() == 1
    assert sampling.uniform_splits(df, "g", "s", "x").count() == 0 and world.search_page(df, F.lit(True), ["s"]).count() == 0


def test_readers_and_writers(spark, tmp_path):
    p = tmp_path / "a.jsonl"
    p.write_text('{"a": 1}\n\n{"a": 2}\n{"a": \n', encoding="utf-8")
    good, broken = readers.split_broken(readers.read_jsonl_tolerant(spark, str(p), "a int").cache())
    assert sorted(r["a"] for r in good.collect()) == [1, 2] and one(broken)["n_broken"] == 1
    with pytest.raises(Exception):
        readers.read_jsonl(spark, str(p), "a int").collect()
    (tmp_path / "m.json").write_text('{"x": {"n": 1}, "y": {"n": 2}}')
    assert sorted(tuple(r) for r in readers.read_map(spark, str(tmp_path / "m.json"), "n int").collect()) == [("x", 1), ("y", 2)]
    (tmp_path / "c.csv").write_text('b,a\n"x, ü",1\n', encoding="utf-8")
    assert tuple(one(readers.read_csv(spark, str(tmp_path / "c.csv"), ["a", "b"]))) == ("1", "x, ü")
    deep = tmp_path / "runs" / "group" / "deep"
    deep.mkdir(parents=True)
    (deep / "B_v3_simple.json").write_text('{"accuracy": 0.5}\n{"id": 1}\n{"id": 2}\n')
    headers, rows = readers.read_headed(spark, str(tmp_path / "runs"), "accuracy double", "id int")
    assert tuple(one(headers)) == ("group", "simple", 0.5) and sorted(r["id"] for r in rows.collect()) == [1, 2]
    (tmp_path / "bad.toml").write_text("a = ")
    assert {r["path"].rsplit("/", 1)[1]: r["passed"] for r in readers.snapshot_checks(spark, str(tmp_path)).collect()}["bad.toml"] is False
    out = str(tmp_path / "out")
    df = spark.createDataFrame([(1, "ü"), (2, None)], "a int, b string")
    writers.write_jsonl(df, out)
    assert sorted(r["value"] for r in spark.read.text(out).collect()) == ['{"a":1,"b":"ü"}', '{"a":2,"b":null}']
    kept = str(tmp_path / "kept")
    assert writers.append_missing(df, kept, ["a"]) == 2 and writers.append_missing(df, kept, ["a"]) == 0
    assert writers.append_missing(df.union(spark.createDataFrame([(3, "z"), (3, "z")], df.schema)), kept, ["a"]) == 1
    assert {(r["key"], r["metric"], r["value"]) for r in writers.long_metrics(df, "r", ["b"]).collect()} == {("ü", "a", 1.0), ("", "a", 2.0)}


def test_manifests(tmp_path):
    p = str(tmp_path / "m.json")
    writers.write_manifest({"d": {"revision": 1, "validated": "yes"}}, p)
    writers.merge_manifest({"d": {"revision": 1}, "e": {"revision": 1}}, p)
    assert json.load(open(p))["d"]["validated"] == "yes"
    assert "validated" not in writers.merge_manifest({"d": {"revision": 2}}, p)["d"]
    link = str(tmp_path / "now.json")
    writers.switch_link(link, "m.json")
    with pytest.raises(ValueError):
        writers.write_manifest({}, link)
    assert writers.replace_section("# A\n\n## B\nold\n## C\nx", "## B", "new") == "# A\n\n## B\n\nnew\n\n## C\nx"


def test_markdown(spark):
    assert writers.markdown(spark.createDataFrame([("b", 0.5), ("a", None)], "k string, v double"), ["k"]).splitlines()[2] == "| a | - |"
