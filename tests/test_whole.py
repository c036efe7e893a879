"""Queries that leave no row out: each against a plain version of it over a small folder."""

import json

from railyard.plans import parsing, registry


def run(spark, folder, name, table, rows, schema):
    spark.createDataFrame(rows, schema).write.mode("overwrite").parquet(f"{folder}/{table}.parquet")
    return [tuple(r) for r in registry.queries()[name](spark, str(folder)).collect()]


def test_language_of_every_text(spark, tmp_path):
    texts = ["Der Zug ist da, né?", "Bäder und Räder", "FÜR für", "→ mit ’auf‘", "le train est là", "日本 der 日本", "日本der", None, ""]
    got = run(spark, tmp_path, "language_proxy", "documents", list(enumerate(texts)), "doc_id long, text string")
    want = [(0, 3, True), (1, 1, True), (2, 2, True), (3, 0, False), (4, 0, False), (5, 1, False), (6, 0, False), (8, 0, False)]
    assert sorted(got) == want


def test_reasoning_of_whole_texts(spark, tmp_path):
    texts = ["a" * 500 + "b" * 500 + "c" * 500 + "d" * 500, "abc\n" * 3000, "kurz", "", None, "é" * 9, "x y " * 50]
    got = run(spark, tmp_path, "think_strip", "documents", list(enumerate(texts)), "doc_id long, text string")
    want = []
    for i, t in enumerate(texts):
        if t is not None:
            k = len(t) // 4
            blank = "\t\n\v\f\r "
            want.append((i, (t if i % 3 == 0 else t[k : 2 * k].lstrip(blank) + t[3 * k :].lstrip(blank)).strip(" ")))
    assert sorted(got) == want


CALLS = "trace_id long, tool_calls array<struct<seq int, call_id string, tool_name string, arguments string>>"


def test_all_calls_of_a_trace(spark, tmp_path):
    many = [(i, f"c{i}", f"f{i}", '{"a": 1}') for i in range(1, 6)]
    traces = [(1, many[::-1]), (2, [many[0], (2, "x", "g", '{"kennung": "ICE 75'), many[3], many[3]]), (3, []), (4, None)]
    extra = ", called_at timestamp, took_ms int>>"
    rows = [(t, None if c is None else [(*x, None, None) for x in c]) for t, c in traces]
    got = run(spark, tmp_path, "tool_call_extract", "db_traces_chat", rows, CALLS.replace(">>", extra))
    assert sorted(got) == [(1, i - 1, f"f{i}") for i in range(1, 6)] + [(2, 0, "f1"), (2, 1, "f4")]


def test_quotes_in_the_bracket_form(spark, tmp_path):
    values = ["IC 1", 'IC "2"', "IC \\3", '4", x="(', "5\n6", "ü)]", "'", "{\"a\": [1, \"b)\"]}", ""]
    rows = [(i, [(1, "c", "fahrplan", z), (2, "d", None, z), (3, "e", "f", None)]) for i, z in enumerate(values)]
    got = run(spark, tmp_path, "bracket_dsl", "db_traces_chat", rows, CALLS)
    assert sorted(got) == [(i, 1, "c", "fahrplan", z) for i, z in enumerate(values)]


def plain_segments(messages):
    """segment_episode by a walk over the messages."""
    out, waiting, n = [], None, 0
    for role, content in messages:
        content = (content or "").strip()
        if role == "tool":
            if waiting:
                out.append((role, content, waiting))
            waiting = None
            continue
        if role == "assistant":
            waiting = None
            if not content:
                n, content = n + 1, parsing.CALL
                waiting = f"call_{n}"
        out.append((role, content, None))
    return [(i, *x) for i, x in enumerate(out)]


def test_segments_of_all_chats(spark, tmp_path):
    chats = [
        [("system", " trim me\n"), ("user", "q {a} [b]"), ("assistant", None), ("tool", "r1"), ("tool", "dropped"), ("assistant", "done")],
        [("tool", "nobody waits"), ("user", ""), ("assistant", " "), ("user", "between"), ("tool", "[1]"), ("assistant", ""), ("assistant", "no"), ("tool", "x")],
        [("assistant", ""), ("assistant", ""), ("tool", "late")],
        [("user", "plain")],
    ]
    got = run(spark, tmp_path, "segment_episode", "areal_chat", [*enumerate(chats), (9, []), (8, None)], "chat_id long, messages array<struct<role string, content string>>")
    assert sorted(got, key=lambda r: r[:2]) == [(i, *x) for i, c in enumerate(chats) for x in plain_segments(c)]


def test_segments_of_the_smallest_data(spark, small):
    rows = spark.read.parquet(f"{small}/areal_chat.parquet").select("chat_id", "messages").collect()
    want = [(r["chat_id"], *x) for r in rows for x in plain_segments(r["messages"] or [])]
    got = [tuple(r) for r in registry.queries()["segment_episode"](spark, small).collect()]
    assert sorted(got, key=lambda r: r[:2]) == sorted(want, key=lambda r: r[:2])


def test_closure_of_all_orders(spark, tmp_path):
    orders = [(k, "P" if k % 2 else "F", k * 10) for k in range(101, 111)]
    got = run(spark, tmp_path, "dependency_closure", "orders", orders, "o_orderkey long, o_orderstatus string, o_custkey long")
    want = {}
    for k, status, place in orders:
        for x in (k - 1, k // 2, k) if status == "P" else ():
            want[x] = min(place, want.get(x, place))
    assert sorted(got) == sorted(want.items())


def test_overlay_of_all_trips(spark, tmp_path):
    stops = [(k, n, 1, 1, float(n), 1.0, 0.0, 0.0, "R" if n == 1 else "N", "O", None) for k in (3, 50, 99) for n in (1, 2, 3)]
    columns = "l_orderkey long, l_linenumber int, l_partkey long, l_suppkey long, l_quantity double, l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp"
    got = run(spark, tmp_path, "delay_overlay", "lineitem", stops, columns)
    assert sorted(got) == sorted((e, k, n, 900.0 + n) for k in (3, 50, 99) for e, n in (("R", 1), ("N", 3)))
