"""Edge cases of the operators over training data, and brute-force versions where SQL cannot say the same."""

import datetime as dt
import itertools
import json
import random
from collections import Counter
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from railyard.llm import encode, leaks, mixing, mojibake, overlaps, packing, queries, quota, runs
from tests.oracle import compare, connect

T0 = dt.datetime(2026, 1, 1)
CALL = "array<struct<seq:int,call_id:string,tool_name:string,arguments:string,called_at:timestamp_ntz,took_ms:int>>"
MESSAGES = "array<struct<role:string,content:string>>"


# queries over the small data


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_matches_sql(spark, small, name):
    compare(spark, connect(small), small, queries.queries()[name], queries.oracle_sql()[name])


@pytest.mark.parametrize("name", ["p1_found", "p4_found", "p5_found", "p8_found"])
def test_found_has_no_repeats(spark, small, name):
    df = queries.queries()[name](spark, small)
    rows = df.collect()
    assert len(rows) == len(set(rows))


# 1 leaks

ITEM = "Send back the walnut espresso machine provided that $859.91 lands with Carlen Quenby before October 10. The jigsaw puzzle reached Halden 19 days late, therefore order #W1511018 got reported by Quilla Ostrup."


def leak_cases():
    words = ITEM.split()
    edited = list(words)
    edited[4], edited[12], edited[20] = "coffee", "ahead", "box"
    return {
        1: (ITEM, True), 2: (" ".join(words[3:24]).upper(), True), 3: (" ".join(words[:12]), False), 4: (json.dumps(json.dumps(ITEM)), True), 5: ("> " + ITEM.replace(" puzzle", "\n> puz-\n> zle"), True),
        6: ("".join(chr(ord(c) + 0xFEE0) if c.isalnum() and c.isascii() else c for c in ITEM), True), 7: (ITEM.replace("a", "a​"), True), 8: (" ".join(edited), True),
        9: (ITEM.replace("Carlen", "Linnet").replace("Quenby", "Ostrup").replace("859.91", "1.02").replace("walnut", "teal").replace("Halden", "Westmere").replace("19", "44").replace("October 10", "May 3").replace("W1511018", "W9").replace("Quilla Ostrup", "Pirlo Moorcamp").replace("machine", "cup"), False),
        10: ("", False), 11: (None, False), 12: ("word " * 5000 + ITEM + " word" * 5000, True),
    }


def test_leak_cases(spark):
    cases = leak_cases()
    chats = spark.createDataFrame([(i, [{"role": "user", "content": "hi"}, {"role": "assistant", "content": t}], "x") for i, (t, _) in cases.items()] + [(90, None, "x"), (91, [], "x"), (None, [{"role": "u", "content": ITEM}], "x")], f"chat_id long, messages {MESSAGES}, item_id string")
    items = spark.createDataFrame([(5, ITEM, "d"), (5, ITEM, "d"), (6, None, "d"), (7, "too short", "d"), (8, "", "d")], "item_id long, item_text string, chat_id string")
    got = sorted(tuple(r) for r in leaks.find_leaks(chats, items).collect())
    assert got == [(i, 5) for i, (_, hit) in cases.items() if hit]
    assert leaks.find_leaks(chats, items.limit(0)).count() == 0 and leaks.find_leaks(chats.limit(0), items).count() == 0


def test_align_against_brute_force():
    def brute(item, text):
        for i in range(len(item)):
            for n in range(leaks.RUN, len(item) - i + 1):
                for j in range(len(text)):
                    for k in range(j + 1, len(text) + 1):
                        a, b = item[i : i + n], text[j:k]
                        if a[0] == b[0] and a[-1] == b[-1] and abs(len(a) - len(b)) <= n // leaks.EDIT and distance(a, b) <= n // leaks.EDIT:
                            return True
        return False

    def distance(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            new = [i]
            for j, y in enumerate(b, 1):
                new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
            row = new
        return row[-1]

    rng = random.Random(1)
    for _ in range(60):
        item = [rng.randrange(50) for _ in range(23)]
        text = list(item[rng.randrange(3) :])
        for _ in range(rng.randrange(6)):
            at = rng.randrange(len(text))
            text[at : at + 1] = rng.choice([[], [99], [text[at], 98]])
        assert leaks.align(np.array(item), np.array(text)) == brute(item, text)


def test_index_meets_all_within_radius():
    """The multi-index finds every window pair within the radius that a scan of all pairs finds."""
    rng = random.Random(2)
    vocabulary = [f"w{i}" for i in range(60)]
    items = [(i, " ".join(rng.choice(vocabulary) for _ in range(30))) for i in range(20)]
    finder = leaks.Finder(items)
    words = [w for _, t in items[:6] for w in t.split()]
    for i in range(0, len(words), 7):
        words[i] = rng.choice(vocabulary)
    codes = finder.code(words)
    starts = np.arange(len(codes) - leaks.WINDOW + 1)
    prints = leaks.simhashes(finder.bits[codes], starts).view(np.uint64).reshape(-1, 2)
    want = set()
    for i, j in itertools.product(range(len(starts)), range(len(finder.owner))):
        near = int(np.bitwise_count(prints[i] ^ finder.wide[j]).sum()) <= leaks.RADIUS
        mine, theirs = (Counter([*w, *zip(w, w[1:])]) for w in (codes[starts[i] : starts[i] + leaks.WINDOW].tolist(), finder.words[j].tolist()))
        if near and (mine & theirs).total() / (mine | theirs).total() >= leaks.LEAST_ALIKE:
            want.add((i, j))
    assert set(zip(*(x.tolist() for x in finder.candidates(codes, starts)))) == want and want
    assert {i for i, _ in want} <= set(finder.starts(codes).tolist())


def test_three_edits_stay_similar():
    """A window keeps LEAST_ALIKE with some window of the text after any three words replaced, left out or added."""
    rng = random.Random(3)
    for _ in range(300):
        item = [rng.randrange(40) for _ in range(leaks.WINDOW)]
        text = [90 + i for i in range(20)] + item + [150 + i for i in range(20)]
        for _ in range(3):
            at = rng.randrange(20, 20 + leaks.WINDOW)
            text[at : at + 1] = rng.choice([[], [99], [text[at], 98]])
        windows = np.array([text[i : i + leaks.WINDOW] for i in range(len(text) - leaks.WINDOW + 1)])
        assert leaks.similarity(leaks.shingles(windows), np.repeat(leaks.shingles(np.array([item])), len(windows), axis=0)).max() >= leaks.LEAST_ALIKE


# 2 quotas


def test_controlled_rounding_keeps_margins():
    rng = random.Random(3)
    for _ in range(40):
        rows, cols = rng.randint(1, 7), rng.randint(1, 6)
        table = [[Fraction(rng.randint(0, 400), 97) for _ in range(cols)] for _ in range(rows)]
        out = quota.controlled_rounding(table)
        near = lambda x, n: x.__floor__() <= n <= x.__ceil__()
        assert all(near(table[i][j], out[i][j]) for i in range(rows) for j in range(cols))
        assert all(near(sum(table[i]), sum(out[i])) for i in range(rows))
        assert all(near(sum(r[j] for r in table), sum(r[j] for r in out)) for j in range(cols))
        assert near(sum(map(sum, table)), sum(map(sum, out)))


def traces(spark, rows):
    return spark.createDataFrame(rows, "trace_id long, task_id string, sample_idx int, template string, fault string, replan boolean, recovery_mode string, teacher string, ingested_at timestamp_ntz, category string")


def test_quota_sample(spark):
    rows = [(i, f"t{i}", 0, "Big One" if i < 300 else "small", None, None, None, f"l{i % 3}", T0, "clash") for i in range(310)]
    rows += [(1000 + i, f"t{i}", 0, "big_one", "x", True, "y", "l0", T0 + dt.timedelta(1), "clash") for i in range(50)]  # delivered again
    rows += [(2000, None, 0, "small", None, None, None, None, None, "clash"), (2001, None, 0, None, None, None, None, None, None, "clash")]
    t = traces(spark, rows)
    targets = spark.createDataFrame([(1, "template", "big_one", 100, 900, 1), (1, "template", "small", 100, 50, 8), (1, "template", "none_there", 100, 50, 1), (2, "replan", "false", 10, 1000, 0), (2, "replan", "false", 10, 1000, 0), (None, "replan", "true", 10, 500, 0)], "request_id long, category_field string, category string, sample_size long, target_permille int, min_rows long")
    report = {(r["request_id"], r["category"]): r for r in quota.quota_report(t, targets).collect()}
    assert (report[1, "big_one"]["n_available"], report[1, "small"]["n_available"], report[2, "false"]["n_available"]) == (300, 11, 312)
    assert {k for k, r in report.items() if r["short"]} == {(1, "none_there")} and report[1, "none_there"]["n_required"] == 5
    sample = quota.quota_sample(t, targets).collect()
    assert len({(r["request_id"], r["trace_id"]) for r in sample}) == len(sample) and not any(1000 <= r["trace_id"] < 2000 for r in sample)
    for k, r in report.items():
        assert sum((x["request_id"], x["category"]) == k for x in sample) == r["n_given"]
    assert report[1, "small"]["n_given"] == 8 and report[2, "false"]["n_given"] == 10
    assert sorted(map(tuple, sample)) == sorted(map(tuple, quota.quota_sample(t.repartition(5), targets).collect()))
    assert quota.quota_report(t.limit(0), targets).filter("short").count() == 4 and quota.quota_sample(t, targets.limit(0)).count() == 0


def test_quota_below_target(spark):
    """Minimums of small categories cost the large one its target: reported, though nothing is short."""
    t = traces(spark, [(i, f"t{i}", 0, "abc"[i % 3], None, None, None, "l", T0, "x") for i in range(1500)])
    targets = spark.createDataFrame([(1, "template", c, 100, p, m) for c, p, m in (("a", 900, 0), ("b", 50, 30), ("c", 50, 30))], "request_id long, category_field string, category string, sample_size long, target_permille int, min_rows long")
    report = {r["category"]: r for r in quota.quota_report(t, targets).collect()}
    assert [report[c]["n_given"] for c in "abc"] == [40, 30, 30] and not any(r["short"] for r in report.values())
    assert report["a"]["below_target"] and report["a"]["reason"] == "minimums of other categories" and not report["b"]["below_target"] and report["b"]["reason"] is None


# 3 mixing


def test_mix_by_brute_force(spark):
    """The rows drawn are those that a sort of all keys of a source gives."""
    rng = random.Random(13)
    rows = [(i, f"o{i}", rng.choice("aab"), [{"role": rng.choice(["assistant", "user"]), "content": "wort " * rng.randrange(1, 40)}], T0) for i in range(300)]
    r = spark.createDataFrame(rows, f"record_id long, origin_id string, source string, messages {MESSAGES}, ingested_at timestamp_ntz")
    targets = spark.createDataFrame([(1, "a", 20_000, 500, 3), (1, "b", 20_000, 500, 3), (2, "a", 1000, 1000, 1), (3, "b", 10**6, 1000, 2)], "mix_id long, source string, total_chars long, target_permille int, max_repeats int")
    keyed = mixing.distinct_records(r).withColumn("key", -F.log(mixing.hash_unit("record_id", seed=42)) / F.col("weight")).orderBy("key", "record_id").collect()
    want = set()
    for mix, source, total, permille, most in targets.collect():
        mine = [x for x in keyed if x["source"] == source]
        budget, size = total * permille // 1000, sum(x["n_chars"] for x in mine)
        epochs = min(most, budget // size)
        rest, upto = (budget - epochs * size if epochs < most else 0), 0
        for x in mine:
            upto += x["n_chars"]
            times = epochs + (rest > 0 and 2 * upto - x["n_chars"] <= 2 * rest)
            if times:
                want.add((mix, source, x["record_id"], x["n_chars"], times))
    assert {tuple(x) for x in mixing.mix_records(r, targets).collect()} == want
    assert {(x["mix_id"], x["source"]) for x in mixing.mix_report(r, targets).filter("short").collect()} == {(3, "b")}


def test_quality(spark):
    m = lambda *contents, role="assistant": [{"role": role, "content": c} for c in contents]
    rows = [(1, m("a plain answer in words")), (2, m("a plain answer in words", None)), (3, m("so " * 50)), (4, m("#{}|~ #{}|~")), (5, m("a plain answer in words", role="user")), (6, None), (7, []), (8, m("")), (9, [None])]
    q = {r["i"]: r["q"] for r in spark.createDataFrame(rows, f"i long, messages {MESSAGES}").select("i", mixing.quality_of(F.col("messages")).alias("q")).collect()}
    assert q[1] > 0.9 and all(mixing.LEAST <= q[i] < q[1] for i in range(2, 10)) and q[6] == q[7] == q[8] == q[9] == mixing.LEAST


def test_mix(spark):
    message = lambda n: [{"role": "user", "content": "é" * n}, {"role": "assistant", "content": None}]
    rows = [(i, f"o{i}", "DB-Bahn", message(10), T0, 1) for i in range(200)] + [(500 + i, f"o{i}", "db_bahn", message(10), T0 + dt.timedelta(1), 1) for i in range(20)]
    rows += [(900, "s1", "faq ", message(30), T0, 1), (901, None, "faq", message(20), None, 1), (902, "n", None, message(9), T0, 1), (903, "e", "empty", None, T0, 1), (904, "e2", "empty", [], T0, 1)]
    r = spark.createDataFrame(rows, f"record_id long, origin_id string, source string, messages {MESSAGES}, ingested_at timestamp_ntz, n_chars int")
    targets = spark.createDataFrame([(1, "db_bahn", 1000, 700, 1), (1, "faq", 1000, 260, 4), (1, "empty", 1000, 20, 9), (1, "gone", 1000, 20, 9), (2, "faq", 1000, 130, 3)], "mix_id long, source string, total_chars long, target_permille int, max_repeats int")
    report = {(x["mix_id"], x["source"]): x for x in mixing.mix_report(r, targets).collect()}
    assert {k for k, x in report.items() if x["short"]} == {(1, "faq"), (1, "empty"), (1, "gone")}
    assert report[1, "db_bahn"]["actual_chars"] == 700 and report[1, "db_bahn"]["source_chars"] == 2000
    assert report[1, "faq"]["actual_chars"] == 200 and report[1, "faq"]["most_repeats"] == 4
    assert report[2, "faq"]["epochs"] == 2 and 100 <= report[2, "faq"]["actual_chars"] <= 150
    rows = mixing.mix_records(r, targets).collect()
    assert all(x["times"] <= 4 for x in rows) and len({(x["mix_id"], x["record_id"]) for x in rows}) == len(rows) and not any(500 <= x["record_id"] < 900 for x in rows)
    assert mixing.mix_records(r.limit(0), targets).count() == 0 and mixing.mix_report(r.limit(0), targets).filter("short").count() == 5 and mixing.mix_report(r, targets.limit(0)).count() == 0


# 4 overlaps

TICKET = "Moin, Bei EC 29558 fehlt am 09.01.2026 ab Plön Altstadt ein Lokführer. Bitte suche jemanden mit der Befähigung Gefahrgut, der um 08:39 Uhr verfügbar ist."


def test_overlaps(spark):
    fill = [f"Bei {p} {1000 + i} fehlt am {1 + i % 28:02d}.02.2026 ab {o} ein {r}. Bitte suche jemanden mit der Befähigung {b}, der um {i % 24:02d}:{i % 60:02d} Uhr verfügbar ist." for i, (p, o, r, b) in enumerate(itertools.islice(itertools.cycle(itertools.product(["EC", "IC"], ["Plön Altstadt", "Ulm West"], ["Lokführer", "Techniker"], ["Gefahrgut", "Rangieren"])), 120))]
    variants = {
        1: (TICKET, "sft_train"), 2: (TICKET.upper(), "sft_val"), 3: (TICKET.replace("ö", "oe").replace("ü", "ue").replace("09.01.2026", "2026-01-09").replace("08:39", "8.39"), "rl_val"),
        4: (TICKET.replace("Lokführer", "Techniker"), "sft_val"), 5: (TICKET.replace("29558", "29559"), "sft_val"), 6: (TICKET.replace("verfügbar", "verfgübar"), "heldout_eval"),
        7: (TICKET, "rl_train"), 8: (None, "sft_val"), 9: ("", "sft_val"), 10: (TICKET, "sft_val"),
    }
    rows = [(n, f"k{n}", t, "other" if n == 10 else None if n == 3 else "A b", "w", T0, 0) for n, (t, _) in variants.items()]
    rows += [(100 + i, f"f{i}", t, "a_b", "w", T0, 0) for i, t in enumerate(fill)] + [rows[0][:5] + (T0 + dt.timedelta(1), 0)]
    tasks = spark.createDataFrame(rows, "task_no long, task_id string, ticket string, template string, source string, exported_at timestamp_ntz, class_id int")
    splits = spark.createDataFrame([(s, f"k{n}", 1) for n, (_, s) in variants.items()] + [("sft_train", f"f{i}", 1) for i in range(120)] + [("sft_train", "k1", 1), ("sft_val", "unknown", 1), ("sft_val", "k1", 1)], "split string, task_id string, task_no int")
    got = {tuple(r) for r in overlaps.overlap_pairs(tasks, splits).collect()}
    assert got == {(1, 2), (1, 3), (1, 6)}
    assert {r["eval_split"]: r["n_pairs"] for r in overlaps.overlap_report(tasks, splits).collect()} == {"sft_val": 1, "rl_val": 1, "heldout_eval": 1}
    assert overlaps.overlap_pairs(tasks.limit(0), splits).count() == 0 and overlaps.overlap_pairs(tasks, splits.limit(0)).count() == 0


def test_copies_make_no_small_talk(spark):
    ticket = "Wartung {} am {:02d}.01.2026 ist gemeldet. Setze den Status bitte auf {} und bestätige mir das Werk Lindenrain."
    texts = {1: ticket.format(4711, 9, "geplant"), 2: ticket.format(4711, 9, "erledigt"), 3: ticket.format(4711, 9, "geplant")}
    texts |= {10 + i: ticket.format(5000, 7, "geplant") for i in range(40)} | {100 + i: f"Bei IC {1000 + i} fehlt am {1 + i % 28:02d}.02.2026 ein Techniker." for i in range(60)}
    tasks = spark.createDataFrame([(n, f"k{n}", t, "a", "w", T0) for n, t in texts.items()], "task_no long, task_id string, ticket string, template string, source string, exported_at timestamp_ntz")
    splits = spark.createDataFrame([("sft_val" if n in (2, 3) else "sft_train", f"k{n}") for n in texts], "split string, task_id string")
    assert {tuple(r) for r in overlaps.overlap_pairs(tasks, splits).collect()} == {(1, 3)}


def test_alternatives_make_no_small_talk(spark):
    """A sentence in every ticket that names one of a few values stays, however few they are; one that is the same in all goes."""
    ticket = "Wartung {} am {:02d}.01.2026 ist gemeldet. Setze den Status bitte auf {} und bestätige mir das Werk {}. Der Drucker hier streikt schon wieder."
    kinds = list(itertools.product(["geplant", "erledigt"], ["Lindenrain", "Oberlohe"]))
    texts = {i: ticket.format(1000 + i, 1 + i % 28, *kinds[i % 4]) for i in range(100)}
    texts |= {500: ticket.format(1000, 1, *kinds[1]), 501: ticket.format(1000, 1, *kinds[0]).replace(" Der Drucker hier streikt schon wieder.", ""), 502: ticket.format(1001, 2, *kinds[0])}
    tasks = spark.createDataFrame([(n, f"k{n}", t, "a", "w", T0) for n, t in texts.items()], "task_no long, task_id string, ticket string, template string, source string, exported_at timestamp_ntz")
    splits = spark.createDataFrame([("sft_val" if n >= 500 else "sft_train", f"k{n}") for n in texts], "split string, task_id string")
    assert {tuple(r) for r in overlaps.overlap_pairs(tasks, splits).collect()} == {(0, 501)}


def test_rare_greetings_are_small_talk():
    """A greeting counts by its share of the tickets that have one, a longer sentence by its share of all."""
    counts = {"hello": 6, "quick question": 6, "hallo": 60, "please be quick about it": 6, "wagen 7": 60}
    assert overlaps.small_talk(counts, 10.0, 5.0) == ["hallo", "hello", "quick question"]
    assert overlaps.small_talk(counts, 5.0, 5.0) == ["hallo", "hello", "please be quick about it", "quick question"]


def test_slips_in_tickets_without_values(spark):
    """Near-copies of number-free tickets of ten words and more are met: at least 0.99 of those with one slip."""
    rng = random.Random(14)
    words = ["".join(rng.choice(c) for c in ("bdfgklmnprst", "aeiou") * 3) for _ in range(400)]
    texts = [" ".join(rng.sample(words, rng.randint(10, 16))) for _ in range(400)]

    def slipped(text):
        at = rng.choice([i for i, c in enumerate(text[:-1]) if c != " " and text[i + 1] != " "])
        return rng.choice([text[:at] + text[at + 1 :], text[:at] + text[at + 1] + text[at] + text[at + 2 :], text[:at] + "x" + text[at + 1 :]])

    prints = [overlaps.fingerprints([t, slipped(t)]) for t in texts]
    met = [len(np.intersect1d(overlaps.blocks_of(*a), overlaps.blocks_of(*b))) > 0 and np.count_nonzero(a[0] != b[0]) <= overlaps.WORD_RADIUS for a, b in prints]
    assert sum(met) >= 0.99 * len(met)
    apart = [len(np.intersect1d(overlaps.blocks_of(*a[0]), overlaps.blocks_of(*b[0]))) > 0 for a, b in itertools.combinations(prints[:100], 2)]
    assert sum(apart) <= 0.05 * len(apart)
    rows = [(i, f"k{i}", t, None, "w", T0) for i, t in enumerate(texts)] + [(1000 + i, f"k{1000 + i}", slipped(t), None, "w", T0) for i, t in enumerate(texts[:100])]
    tasks = spark.createDataFrame(rows, "task_no long, task_id string, ticket string, template string, source string, exported_at timestamp_ntz")
    splits = spark.createDataFrame([("sft_val" if r[0] >= 1000 else "sft_train", r[1]) for r in rows], "split string, task_id string")
    _, classes, _ = overlaps.classes_of(overlaps.tasks_in_splits(tasks, splits))
    assert overlaps.candidates(classes).count() >= 99


def test_blocks_meet_all_within_the_radius():
    rng = np.random.RandomState(3)
    for _ in range(200):
        a = rng.rand(256) < 0.5
        b = a.copy()
        b[rng.choice(256, overlaps.RADIUS, replace=False)] ^= True
        assert len(np.intersect1d(overlaps.blocks_of(a, True), overlaps.blocks_of(b, True)))


def test_report_counts_as_the_pairs_do(spark, monkeypatch):
    """Sizes of classes give what the expanded pairs give, also for tasks in both splits; blocks cut into parts lose nothing."""
    rng = random.Random(15)
    rows = [(i, f"k{i}", f"Bitte prüfe, ob MA-000{rng.randrange(12)} am {1 + i % 3:02d}.02.2026 eingeteilt werden darf.", rng.choice(["a", "b", None]), rng.choice(["w", "x", None]), T0) for i in range(150)]
    tasks = spark.createDataFrame(rows, "task_no long, task_id string, ticket string, template string, source string, exported_at timestamp_ntz")
    where = [(s, r[1]) for r in rows for s in ("sft_train", "sft_val", "rl_val", "other") if rng.random() < 0.45]
    splits = spark.createDataFrame(where, "split string, task_id string")
    inside = {r[1]: {s for s, k in where if k == r[1]} for r in rows}
    key = lambda r: r[2].split("MA-")[1][:14]
    linked = [(a, b) for a in rows for b in rows if a[0] != b[0] and key(a) == key(b) and None in (a[3], b[3], None if a[3] == b[3] else "") and "sft_train" in inside[a[1]] and inside[b[1]] & {"sft_val", "rl_val"}]
    want = {}
    for a, b in linked:
        for s in inside[b[1]] & {"sft_val", "rl_val"}:
            want.setdefault((s, b[4]), []).append((a[0], b[0]))
    for hot in (2000, 2):
        monkeypatch.setattr(overlaps, "HOT", hot)
        got = {(r["eval_split"], r["source"]): (r["n_pairs"], r["n_eval_tasks"], r["n_train_tasks"]) for r in overlaps.overlap_report(tasks, splits).collect()}
        assert got == {k: (len(v), len({b for _, b in v}), len({a for a, _ in v})) for k, v in want.items()}
        assert {tuple(r) for r in overlaps.overlap_pairs(tasks, splits).collect()} == {(min(a[0], b[0]), max(a[0], b[0])) for a, b in linked}


@pytest.mark.parametrize("text, want", [("am 9.1.2026", "D20260109"), ("2026-01-09", "D20260109"), ("9. Januar 2026", "D20260109"), ("January 9, 2026", "D20260109"), ("um 8.39 Uhr", "T0839"), ("8 Uhr", "T0800"), ("3:05 pm", "T1505"), ("08:39", "T0839")])
def test_dates_and_times(text, want):
    assert want in overlaps.tokens_of(overlaps.canonical(text))


# 5 runs


def brute_runs(calls):
    seen, kept = set(), []
    for c in sorted((c for c in calls if c and c[0] is not None), key=lambda c: (c[0], c[1] is None, c[1] or "")):
        if c[1] is None or c[1] not in seen:
            seen.add(c[1])
            kept.append(c)
    out, i = [], 0
    while i < len(kept):
        j = i
        while j + 1 < len(kept) and kept[j + 1][2] == kept[i][2] and runs.fold_arguments(kept[j + 1][3]) == runs.fold_arguments(kept[i][3]):
            j += 1
        if j > i:
            out.append((kept[i][0], kept[j][0]))
        i = j + 1
    return out


def test_runs_against_brute_force(spark):
    rng = random.Random(4)
    forms = ['{"zug": "IC 5"}', '{"zug":"ic5 "}', '{"zug": "IC 5", "seite": null}', '{"zug": "IC 6"}', '{"n": 5}', '{"n": "5.0"}', '{"zug": "', None, "[]", '{"o": "Köln", "a": {"b": [1, "2"]}}', '{"a": {"b": ["1", 2]}, "o": "KOELN"}']
    rows = []
    for i in range(150):
        calls = [(n + 1, f"c{n}", rng.choice(["f", "f", "g"]), rng.choice(forms), T0 + dt.timedelta(seconds=n) if rng.random() < 0.8 else None, 100) for n in range(rng.randrange(9))]
        if calls and rng.random() < 0.3:
            calls.append(rng.choice(calls))
        rng.shuffle(calls)
        rows.append((i, calls, "clash"))
    rows += [(900, None, "x"), (901, [], "x"), (902, [None, (None, "a", "f", "{}", None, 1), (1, "b", "f", "{}", None, None), (2, "c", "f", "{ }", None, None)], "x"), (903, [(n, str(n), "f", "{}", T0, 1) for n in range(1, 3001)], "x")]
    df = spark.createDataFrame(rows, f"trace_id long, tool_calls {CALL}, first_seq string")
    got = sorted((r["trace_id"], r["first_seq"], r["last_seq"]) for r in runs.collapse_runs(df).collect())
    assert got == sorted((i, a, b) for i, calls, _ in rows for a, b in brute_runs(calls or []))
    one = {r["trace_id"]: r for r in runs.collapse_runs(df).filter("trace_id >= 900").collect()}
    assert one[902]["duration_ms"] is None and (one[903]["n_calls"], one[903]["duration_ms"]) == (3000, 1)
    assert runs.collapse_runs(df, 1).agg(F.sum("n_calls")).collect()[0][0] == sum(len({c[1] for c in x or [] if c and c[0] is not None}) for _, x, _ in rows)
    assert runs.collapse_runs(df.limit(0)).count() == 0


def test_runs_of_irregular_numbering(spark):
    """Gaps, a start at 0, repeated seqs and repeated call_ids: with 1 or 2 calls at least, the runs are the same."""
    call = lambda n, i, f: (n, i, f, "{}", T0, 1)
    rows = [
        (1, [call(0, "a", "x"), call(1, "b", "y"), call(3, "c", "y")]), (2, [call(1, "b", "y"), call(3, "c", "y")]), (3, [call(1, "a", "x"), call(2, "a", "y"), call(3, "b", "x")]),
        (4, [call(1, "a", "x"), call(None, "b", "x"), call(3, "c", "x")]), (5, [call(7, None, "x"), call(7, None, "x")]), (6, [call(2**31 - 1, "a", "x"), call(2**31 - 2, "b", "x")]),
        (7, [call(1, "a", "x"), None, call(3, "c", "x")]), (8, [call(-1, "a", None), call(0, "b", None)]),
    ]
    rng = random.Random(12)
    rows += [(100 + i, [call(rng.choice([None, *range(-1, 9)]), rng.choice([None, "a", "b", *map(str, range(20))]), rng.choice("xxy")) for _ in range(rng.randrange(7))]) for i in range(400)]
    df = spark.createDataFrame(rows, f"trace_id long, tool_calls {CALL}")
    two = {(r["trace_id"], r["first_seq"], r["last_seq"], r["n_calls"]) for r in runs.collapse_runs(df).collect()}
    one = {(r["trace_id"], r["first_seq"], r["last_seq"], r["n_calls"]) for r in runs.collapse_runs(df, 1).filter("n_calls > 1").collect()}
    assert two == one and {(1, 1, 3, 2), (2, 1, 3, 2), (3, 1, 3, 2), (4, 1, 3, 2), (5, 7, 7, 2)} <= two
    assert {x[:3] for x in two} == {(i, a, b) for i, calls in rows for a, b in brute_runs(calls)}


@pytest.mark.parametrize("a, b, same", [('{"a": "ß"}', '{"A": "SS"}', True), ('{"a": 20}', '{"a": "20"}', True), ('{"a": 20}', '{"a": 20.0}', True), ('{"a": "007"}', '{"a": 7}', False), ('{"a": {}}', "{}", True), ('{"a": "x"}', '{"a": "y"}', False), ("{x", "{x ", False), (None, "{}", False), ('{"a": 1e999}', '{"a": 1e999}', True)])
def test_same_arguments(a, b, same):
    assert (runs.fold_arguments(a) == runs.fold_arguments(b)) is same


# 6 encoding

ODD = ["", " ", "  a  b\r\n\t", "aaaaaaaaaaaaaaa", "<|endoftext|>", "Grüße — “x”", "東京行き🚆✅", "\x00\x1c ", "don't we'LL", "x" * 5000, "ab " * 3000, "1234567890 " * 50]


@pytest.fixture(scope="module")
def tables():
    pytest.importorskip("public_tokenizers")
    return {n: encode.pair_table(encode.read_ranks(n)) for n in ("byte_bpe_50k", "byte_bpe_multi_50k")}


def test_encoding_equals_the_libraries(tables):
    tokenizers, tiktoken = pytest.importorskip("tokenizers"), pytest.importorskip("tiktoken")
    rng = random.Random(5)
    texts = ODD + ["".join(chr(rng.choice([rng.randrange(32, 127), rng.randrange(160, 900), 32])) for _ in range(rng.randrange(200))) for _ in range(200)]
    t = tokenizers.Tokenizer.from_file(f"{encode.TOKENIZERS}/byte_bpe_50k.json")
    t.encode_special_tokens = True
    assert encode.Encoder(tables["byte_bpe_50k"]).encode(texts) == [x.ids for x in t.encode_batch(texts, add_special_tokens=False)]
    m = tiktoken.Encoding("m", pat_str=encode.PATTERN, mergeable_ranks=encode.read_ranks("byte_bpe_multi_50k"), special_tokens={})
    e = encode.Encoder(tables["byte_bpe_multi_50k"])
    assert e.encode(texts) == [m.encode_ordinary(x) for x in texts] and e.count(texts) == [len(m.encode_ordinary(x)) for x in texts]
    word = "".join(rng.choice("abcdefgh") for _ in range(900))
    assert encode.merge_long(word.encode(), tables["byte_bpe_50k"], dict(zip(tables["byte_bpe_50k"]["keys"].tolist(), tables["byte_bpe_50k"]["tokens"].tolist()))) == t.encode(word, add_special_tokens=False).ids


def test_encode_rows(spark, tables):
    df = spark.createDataFrame([(i, t, "x") for i, t in enumerate([*ODD, None, "same", "same"])], "doc_id long, text string, ids string")
    got = {r["doc_id"]: list(r["ids"]) for r in encode.encode_texts(df).collect()}
    assert len(got) == len(ODD) + 3 and got[0] == got[len(ODD)] == [] and got[1] and got[len(ODD) + 1] == got[len(ODD) + 2]
    assert encode.encode_texts(df.limit(0)).count() == 0


# 7 packing


def test_boundaries_are_optimal():
    rng = random.Random(6)
    for _ in range(80):
        lengths = np.array(sorted(rng.sample(range(1, 60), rng.randint(1, 9))))
        counts = np.array([rng.randint(1, 9) for _ in lengths])
        k = rng.randint(1, 5)
        cost = lambda ends: sum(c * (min(e for e in ends if e >= x) - x) for x, c in zip(lengths.tolist(), counts.tolist()))  # noqa: E731,B023
        best = min(cost(e) for n in range(1, k + 1) for e in itertools.combinations(lengths.tolist(), min(n, len(lengths))) if e[-1] == lengths[-1])
        got = packing.best_boundaries(lengths, counts, k).tolist()
        assert cost(got) == best and len(got) <= max(k, 1)


def test_best_fill_is_best():
    rng = random.Random(7)
    for _ in range(100):
        sizes = np.array(sorted(rng.sample(range(1, 20), 4)))
        left = np.array([rng.randint(0, 3) for _ in sizes])
        room = rng.randint(0, 40)
        best = max(sum(s * k for s, k in zip(sizes.tolist(), ks)) for ks in itertools.product(*(range(n + 1) for n in left.tolist())) if sum(s * k for s, k in zip(sizes.tolist(), ks)) <= room)
        chosen = packing.best_fill(sizes, left, room)
        assert sum(int(sizes[t]) * k for t, k in chosen) == best and all(k <= left[t] for t, k in chosen)


@pytest.mark.parametrize("mix, group", [(True, 200_000), (True, 3), (False, 200_000)])
def test_packing(spark, monkeypatch, mix, group):
    monkeypatch.setattr(packing, "GROUP", group)
    rng = random.Random(8)
    sizes = [(1, i, rng.choice([3, 7, 40, 60, 61, rng.randint(1, 100)])) for i in range(800)] + [(1, 9000, 350), (1, 9001, 300), (1, 9002, 0), (2, 1, 5), (2, 2, 5), (3, 1, 1)]
    df = spark.createDataFrame(sizes, "pack_id long, doc_id long, n long")
    rows = packing.pack_items(df, {1: 100, 2: 12}, buckets=12, mix=mix).collect()
    room, total = {}, {}
    for r in rows:
        room[r["pack_id"], r["container_id"]] = room.get((r["pack_id"], r["container_id"]), 0) + r["n_tokens"]
        total[r["pack_id"], r["doc_id"]] = total.get((r["pack_id"], r["doc_id"]), 0) + r["n_tokens"]
    assert total == {(p, d): n for p, d, n in sizes if n and p < 3}
    assert all(n <= (100 if p == 1 else 12) for (p, _), n in room.items())
    assert sorted(r["piece"] for r in rows if r["doc_id"] == 9000) == [0, 1, 2, 3] and sorted(r["piece"] for r in rows if r["doc_id"] == 9001) == [0, 1, 2]
    ids = sorted(c for p, c in room if p == 1)
    assert ids == list(range(len(ids)))
    if mix:
        assert sum(n for (p, _), n in room.items() if p == 1) / (100 * len(ids)) > 0.86


def test_pack_documents(spark, tables):
    docs = spark.createDataFrame([(1, "a b c", 0), (2, "", 0), (3, None, 0), (4, " ", 0), (5, "word " * 100, 0), (6, "x", 0)], "doc_id long, text string, place int")
    packs = spark.createDataFrame([(1, "byte_bpe_50k", 16), (1, "byte_bpe_50k", 16), (2, "byte_bpe_multi_50k", 1000), (3, None, 5), (4, "byte_bpe_50k", 0)], "pack_id long, tokenizer string, capacity long")
    rows = packing.pack_documents(docs, packs).collect()
    assert {(r["pack_id"], r["doc_id"]) for r in rows} == {(p, d) for p in (1, 2) for d in (1, 4, 5, 6)}
    mine = sorted((r["first_token"], r["n_tokens"]) for r in rows if r["pack_id"] == 1 and r["doc_id"] == 5)
    assert all(a + n == b for (a, n), (b, _) in zip(mine, mine[1:])) and sum(n for _, n in mine) >= 100
    for p, c in {(r["pack_id"], r["container_id"]) for r in rows}:
        inside = sorted((r["place"], r["at_token"], r["n_tokens"]) for r in rows if (r["pack_id"], r["container_id"]) == (p, c))
        assert [x[0] for x in inside] == list(range(1, len(inside) + 1)) and inside[0][1] == 0 and all(a[1] + a[2] == b[1] for a, b in zip(inside, inside[1:]))
    assert packing.pack_documents(docs.limit(0), packs).count() == 0 and packing.pack_documents(docs, packs.limit(0)).count() == 0
    with pytest.raises(ValueError):
        packing.pack_documents(docs, spark.createDataFrame([(1, "no_such", 5)], packs.schema))


# 8 garbled text

CLEAN = ["Für die Strecke Köln – Görlitz gilt „überfällig“, außer Betrieb, 135,47 €", "Les voyageurs ont été dirigés à l’arrière du bâtiment", "Não há razão; INSPEÇÕES, ATENÇÃO, SÃO", "Podróżni mogą przejść, żółta halę", "東京行きの列車は遅れています。", "поезд прибывает на путь 4", "قطار متأخر", "├── werk\n│   └── auftrag", "½ Stunde, 3³ = 27, x² ≥ 4, ⁿ√8", "Temp. −4 °C, Strom 16⅔ Hz, ±3 µm, § 12", "M&uuml;nchen &amp; K&ouml;ln", "zug?id=M%C3%BCnster", '"nach": "G\\u00f6rlitz"', "🚆 ok ✅", "Köln,Düsseldorf,Görlitz,München,Nürnberg,Plön,Fürth,Tübingen,Würzburg", "příliš žluťoučký kůň", "Ærø og Tromsø, Malmö", "", " ", "plain"]


def garble(text, encoding, times=1):
    for _ in range(times):
        text = "".join(bytes([b]).decode(encoding, "replace") if encoding != "cp1252" or b not in (0x81, 0x8D, 0x8F, 0x90, 0x9D) else chr(b) for b in text.encode())
    return text


def test_clean_texts_stay():
    m = mojibake.Mender()
    for t in CLEAN:
        assert m.restore(t) == (0, 0, t)


@pytest.mark.parametrize("encoding, times", [("cp1252", 1), ("cp1252", 2), ("latin-1", 1), ("latin-1", 2), ("cp437", 1), ("cp850", 1), ("mac_roman", 1), ("cp1250", 1), ("cp1251", 1)])
def test_round_trip(encoding, times):
    m = mojibake.Mender()
    for t in CLEAN[:1]:
        bad = garble(t, encoding, times)
        if "�" not in bad:
            n, lost, new = m.restore(bad)
            assert n and new == t


@pytest.mark.parametrize("read_as", ["cp437", "cp850", "mac_roman"])
def test_swapped(read_as):
    t = "Für die Prüfung in Köln gilt: größere Änderung"
    n, _, new = mojibake.Mender().restore(t.encode("cp1252").decode(read_as))
    assert n and new == t


LANGUAGES = {
    "Russian": "поезд прибывает опоздание Москва вокзал путь ремонт платформа Здравствуйте скорый", "Czech": "příliš žluťoučký kůň úpěl ďábelské nádraží zpoždění Plzeň Děčín výluka dveře červený růže šest Žižkov ještě Říčany",
    "Turkish": "değişiklik güzergâh İstanbul Şişli ağır çalışma özür müdürlük kalkış ışık çağrı Iğdır gümüş öğle Çankırı", "Polish": "opóźnienie Łódź żółty część pociąg źródło Gdańsk Święto wyjątek następny",
    "German": "für über Prüfung Größe Türen Äußerst Öffnung häufig Überführung Straße", "French": "été première français dérangé où hôtel cœur élève À être", "Spanish": "mañana próximo estación avión señor ñandú ¿Dónde está? niño",
    "Greek": "καθυστέρηση τρένο σταθμός αναχώρηση Αθήνα Θεσσαλονίκη γραμμή", "East Asian": "列車は遅れています 東京駅 運転見合わせ 請注意安全 火车晚点 车站 北京西站", "Hungarian": "késés pályaudvar őszintén üdvözlöm fűtés Győr hűtő",
    "Swedish": "försening tåg Göteborg Malmö spår avgång nästa Ångström", "Hebrew": "רכבת תחנה איחור", "Arabic": "قطار محطة تأخير",
}


@pytest.mark.parametrize("language", LANGUAGES)
def test_restored_by_language(language):
    """UTF-8 read in four encodings, word by word: at least 0.95 come back, none comes back wrong; proper words stay."""
    m, right, n = mojibake.Mender(), 0, 0
    for word in LANGUAGES[language].split():
        assert m.restore(word) == (0, 0, word)
        for encoding in ("latin-1", "cp1252", "cp437", "mac_roman"):
            found, lost, new = m.restore(garble(word, encoding))
            n += 1
            right += new == word
            assert new == word or not found or lost
    assert right >= 0.95 * n


@pytest.mark.parametrize("was, read_as", [("cp1251", "latin-1"), ("cp1251", "cp1252"), ("koi8-r", "latin-1")])
def test_one_byte_cyrillic(was, read_as):
    m = mojibake.Mender()
    words = LANGUAGES["Russian"].split()
    got = [m.restore(w.encode(was).decode(read_as)) for w in words]
    assert sum(new == w for w, (_, _, new) in zip(words, got)) >= 0.9 * len(words) and all(new == w or lost for w, (_, lost, new) in zip(words, got))


@pytest.mark.parametrize("before", range(195, 206))
def test_long_places_are_cut_between_sequences(before):
    bad = "a" * before + garble("ü", "cp1252") + "b" * 300 + "&uuml;" + "c" * 150 + garble("Öl", "cp1252")
    n, lost, new = mojibake.Mender().restore(bad)
    assert n == 2 and lost == 0 and new == "a" * before + "ü" + "b" * 300 + "&uuml;" + "c" * 150 + "Öl"
    text = "列車は遅れています東京駅運転見合わせ" * 10
    assert mojibake.Mender().restore(garble(text, "latin-1")) == (1, 0, text)


def test_doubtful_readings_are_not_restored():
    m = mojibake.Mender()
    n, lost, new = m.restore("F" + garble("ü", "cp1250") + "r")  # "Für" or, by another encoding, "Får"
    assert (n, lost, new) == (1, 1, "F" + garble("ü", "cp1250") + "r")
    n, lost, new = m.restore(garble("Für die Tür in Köln außer Größe", "cp1250"))
    assert n == 5 and lost == 0 and new == "Für die Tür in Köln außer Größe"


def test_lost_bytes_are_reported():
    n, lost, new = mojibake.Mender().restore("Die T�r und die TÃ¼r")
    assert (n, lost, new) == (2, 1, "Die T�r und die Tür")


def test_find_garbled(spark):
    rows = [(i, t, "x") for i, t in enumerate(CLEAN)] + [(100, None, "x"), (101, "fã¼r", "x"), (102, "x" * 200_000 + " prÃ¼fen", "x"), (103, "Tür" * 20_000, "x"), (105, "ü" * 50_000, "x"), (104, "Ã¼" * 3000, "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, restored string")
    got = {r["doc_id"]: r["restored"] for r in mojibake.find_garbled(df).collect()}
    assert set(got) == {101, 102, 104} and got[101] == "für" and got[102].endswith(" prüfen")
    assert mojibake.find_garbled(df.limit(0)).count() == 0
