"""The general pipeline operators on small and awkward inputs, against plain Python."""

import datetime as dt
import json
import random

import pytest
from pyspark.sql import functions as F

from fieldspark.operators import drift, known_at, nested, prefix, profile, references, wide_table

T0 = dt.datetime(2024, 1, 1)
STATS = "game_id bigint, team_id bigint, home_away string, stat_name string, stat_label string, display_value string, stat_value double, loaded_at timestamp_ntz, stat_row_id bigint, val string"


def stats(spark, rows):
    full = [(g, t, "home", n, lab, d, x, T0 + dt.timedelta(hours=h), i, "clash") for i, (g, t, n, lab, d, x, h) in enumerate(rows)]
    return spark.createDataFrame(full, STATS)


def cells(df):
    return {(r.game_id, r.team_id, r.stat): r.val for r in wide_table.long_cells(df).collect()}


# ---------------------------------------------------------------- 1
def test_wide_notations_and_corrections(spark):
    rows = [
        (1, 1, "totalYards", "Total Yards", "1,015", None, 0),
        (1, 1, "totalYards", "Total Yards", "n/a", None, 9),  # unreadable: replaces nothing
        (1, 2, "total_yards ", None, " +20 ", None, 1),
        (1, 3, None, "TOTAL YARDS", "31.00", None, 1),  # by its label
        (1, 4, "", "unknown label", "5", None, 1),  # no attribute
        (1, 5, "totalYards", None, "(13)", None, 1),
        (1, 6, "totalYards", None, "−7", None, 1),
        (1, 7, "totalYards", None, None, 12.0, 1),
        (1, 8, "totalYards", None, None, 12.5, 1),  # no whole number
        (1, 9, "totalYards", None, "", 3.0, 1),  # empty text is a value, an unreadable one
        (None, 1, "totalYards", None, "1", None, 1),
        (1, None, "totalYards", None, "1", None, 1),
        (2, 1, "yardsPerPass", None, "8,1", None, 1),
        (2, 2, "yardsPerPass", None, ".6", None, 1),
        (2, 3, "yardsPerPass", None, None, 5.4, 1),
        (2, 4, "yardsPerPass", None, "-0.0", None, 1),
        (3, 1, "possessionTime", None, "00:21:50", None, 1),
        (3, 2, "possessionTime", None, "39m 35s", None, 1),
        (3, 3, "possessionTime", None, "27:04", None, 1),
        (3, 4, "possessionTime", None, None, 1780.0, 1),
        (4, 1, "completionAttempts", None, "8-19 (42%)", None, 1),
        (4, 2, "completionAttempts", None, "17 of 17", None, 1),
        (4, 3, "completionAttempts", None, "14–48", None, 1),
        (4, 4, "completionAttempts", None, "1 - 2", None, 1),
        (4, 5, "completionAttempts", None, None, 3.0, 1),  # a pair has no single number
        (5, 1, "totalYards", None, "5", None, 3),
        (5, 1, "totalYards", None, "6", None, 3),  # same time: the later row
        (5, 1, "totalYards", None, "7", None, 2),
    ]
    ty, yp, pt, ca = "totalYards", "yardsPerPass", "possessionTime", "completionAttempts"
    assert cells(stats(spark, rows)) == {
        (1, 1, ty): 1015, (1, 2, ty): 20, (1, 3, ty): 31, (1, 5, ty): -13, (1, 6, ty): -7, (1, 7, ty): 12,
        (2, 1, yp): 8100, (2, 2, yp): 600, (2, 3, yp): 5400, (2, 4, yp): 0,
        (3, 1, pt): 1310, (3, 2, pt): 2375, (3, 3, pt): 1624, (3, 4, pt): 1780,
        (4, 1, ca): 8019, (4, 2, ca): 17017, (4, 3, ca): 14048, (4, 4, ca): 1002, (5, 1, ty): 6,
    }


def test_wide_empty_and_types(spark):
    empty = stats(spark, [])
    assert cells(empty) == {}
    assert wide_table.wide_table(empty).columns == ["game_id", "team_id"]
    one = stats(spark, [(1, 1, "yardsPerPass", None, "8.1", None, 0), (1, 1, "completionAttempts", None, "2-3", None, 0), (1, 1, "turnovers", None, "2", None, 0)])
    types = dict(wide_table.wide_table(one).dtypes)
    assert types["yardsPerPass"] == "decimal(19,3)" and types["turnovers"] == "bigint" and types["completionAttempts"] == "struct<first:bigint,second:bigint>"


def test_wide_log_of_deltas(spark, tmp_path):
    a = stats(spark, [(1, 1, "turnovers", None, "1", None, 0), (1, 2, "turnovers", None, "4", None, 5)])
    b = stats(spark, [(1, 1, "turnovers", None, "2", None, 1), (1, 2, "turnovers", None, "3", None, 1), (1, 2, "firstDowns", None, "9", None, 1)])
    log = wide_table.WideTableLog(spark, f"{tmp_path}/t")
    log.append(a, 1)
    log.append(b, 2)
    log.append(b, 2)  # again: no change
    want = {(1, 1): (2, None), (1, 2): (4, 9)}
    for t in (log, log.merge(f"{tmp_path}/m")):
        assert {(r.game_id, r.team_id): (r.c_turnovers.a, r.c_firstdowns and r.c_firstdowns.a) for r in t.read().collect()} == want


def test_wide_log_keeps_rows_that_only_have_a_label(spark, tmp_path):
    named = stats(spark, [(1, 1, "yardsPerPass", "Yards per Pass", "8.5", None, 0)])
    labelled = stats(spark, [(1, 1, None, "YARDS PER PASS", "9.25", None, 2), (1, 2, None, "Yards per pass", "7", None, 2), (1, 2, None, "Yards per pass", "12:30", None, 3), (1, 3, None, "other", "7", None, 3)])
    for order in ([named, labelled], [labelled, named]):
        log = wide_table.WideTableLog(spark, f"{tmp_path}/{id(order)}")
        for k, rows in enumerate(order):
            log.append(rows, k)
        for t in (log, log.merge(f"{tmp_path}/m{id(order)}")):
            assert {(r.team_id, r.stat, r.val) for r in t.long().collect()} == {(1, "yardsPerPass", 9250), (2, "yardsPerPass", 7000)}


def test_wide_numbers_at_the_edge(spark):
    big = 9_000_000_000_000_000
    rows = [(1, 1, "yardsPerPass", None, f"{big}", None, 0), (1, 1, "turnovers", None, "9" * 18, None, 0), (1, 2, "turnovers", None, "9" * 40, None, 0), (1, 2, "yardsPerPass", None, "9" * 25, None, 0), (1, 3, "turnovers", None, None, float("inf"), 0)]
    (r,) = wide_table.wide_table(stats(spark, rows)).collect()
    assert (r.team_id, int(r.yardsPerPass), r.turnovers) == (1, big, 10**18 - 1)


# ---------------------------------------------------------------- 3
def test_orphans_against_plain_python(spark):
    rnd = random.Random(5)
    day = lambda k: T0 + dt.timedelta(days=k)
    parents = [(k, day(rnd.randrange(300)), None if rnd.random() < 0.3 else day(rnd.randrange(300, 600))) for k in [rnd.randrange(30) for _ in range(60)]]
    parents += [(None, day(1), None), (50, None, day(100)), (51, day(100), day(50))]
    refs = [(f"s{i % 2}", i, rnd.choice([*range(40), 50, 51, None]), day(rnd.randrange(700)), "clash") for i in range(600)] + [("s0", 900, 3, None, "x")] * 2
    p = spark.createDataFrame(parents, "key bigint, start timestamp_ntz, stop timestamp_ntz")
    r = spark.createDataFrame(refs, "src string, row_id bigint, key bigint, at timestamp_ntz, kind0 string")

    def kind(key, at):
        rows = [x for x in parents if x[0] == key and key is not None]
        if not rows:
            return "missing"
        if at is not None and any((a is None or a <= at) and (b is None or at < b) for _, a, b in rows):
            return None
        return "late" if at is not None and all(a is not None and a > at for _, a, _ in rows) else "deleted"

    want = sorted((s, i, kind(k, at)) for s, i, k, at, _ in refs if kind(k, at))
    for bits, rows in ((None, None), (1 << 16, 40), (64, 7)):  # a tiny filter lets all through, large keys are cut; the result stays
        got = references.orphans(r, p, bits, rows)
        assert sorted((x.src, x.row_id, x.kind) for x in got.collect()) == want
    assert references.orphans(r, p.limit(0)).where("kind <> 'missing'").count() == 0
    assert references.orphans(r.limit(0), p).count() == 0


def test_bloom_filter_has_no_false_negatives(spark):
    keys = spark.range(5000).withColumnRenamed("id", "k")
    f = references.bloom_filter(keys, "k")
    probe = spark.range(20000).withColumn("m", references.might_contain(f, F.col("id")))
    assert probe.where("id < 5000 and not m").count() == 0
    assert probe.where("id >= 5000 and m").count() < 1500


# ---------------------------------------------------------------- prefix
def test_running_totals(spark):
    rows = [(k, i // 3, i, (i * 7) % 5 if i % 4 else None) for k in "ab" for i in range(20)]
    df = spark.createDataFrame(rows, "k string, b int, i int, v int")
    for agg, run in ((max, prefix.running_max), (sum, prefix.running_sum)):
        got = {(r.k, r.i): r.out for r in run(df, ["k"], "b", [F.col("i")], "v", "out").collect()}
        for k in "ab":
            seen = []
            for _, _, i, v in [r for r in rows if r[0] == k]:
                seen += [v] if v is not None else []
                assert got[k, i] == (agg(seen) if seen else (0 if agg is sum else None))


# ---------------------------------------------------------------- 4
def test_profile_limits_are_exact(spark):
    rows = []
    add = lambda load, n, v: rows.extend([(load, v, "10", "clash")] * n)
    add(1, 70, "1"), add(1, 30, None)  # exactly 30 %: no issue but constant
    add(2, 69, " 2 "), add(2, 31, None)
    add(3, 50, "1"), add(3, 47, "2.0"), add(3, 3, "x")
    add(4, 50, "1"), add(4, 46, "2"), add(4, 4, "")
    add(5, 98, "3"), add(5, 2, "9")
    add(7, 97, "3"), add(7, 3, "-1")
    df = spark.createDataFrame(rows, "load int, down string, distance string, issue string")
    got = {(r.load, r.issue) for r in profile.load_issues(df, "load", {"down": (1, 4)}).collect()}
    assert got == {(1, "constant"), (2, "nulls"), (2, "constant"), (2, "shift"), (3, "shift"), (4, "pattern"), (5, "shift"), (7, "range")}
    assert profile.load_issues(df.limit(0), "load", {"down": (1, 4)}).count() == 0
    p = {(r.load, r.col): r for r in profile.column_profile(df, "load", ["down", "distance"]).collect()}
    r = p[3, "down"]
    assert (r.rows, r.nulls, r.violations, r.low, r.high, r.s1, r.s2) == (100, 0, 3, 1.0, 2.0, 144.0, 238.0) and r.distinct_values == 3
    assert p[3, "distance"].sd == 0.0 and p[3, "distance"].std_diff is None


def test_profile_of_every_type(spark):
    import decimal
    import math

    d = decimal.Decimal
    rows = [(1, 1.5, d("2.25"), True, T0, "a", 5), (1, 2.25, d("-12345678901.5"), False, T0 + dt.timedelta(days=1), "b", 10**18), (1, -0.0, None, None, None, " ", -(10**18)), (1, float("nan"), None, None, None, None, 7), (1, 0.0, None, None, None, None, 7), (1, 3e12, None, None, None, None, None)]
    df = spark.createDataFrame(rows, "load int, x double, m decimal(20,4), b boolean, t timestamp_ntz, s string, col bigint")
    p = {r.col: r for r in profile.column_profile(df, "load", df.columns, {"s": r"\S"}).collect()}
    x = p["x"]
    assert (x.nulls, x.violations, x.s0, x.low, x.high, x.distinct_values, x.decimals) == (0, 1, 5, 0.0, 3e12, 5, 9) and x.s1 == 3e12 + 3.75
    assert x.s2 == pytest.approx(9e24) and x.s2_units == str((3 * 10**21) ** 2 + 1500000000**2 + 2250000000**2)
    assert (p["m"].s1_units, p["m"].nulls, p["m"].violations) == ("-12345678899250000000", 4, 0) and p["m"].mean == pytest.approx(-6172839449.625)
    assert (p["b"].s0, p["b"].mean, p["t"].s0, p["t"].high - p["t"].low, p["s"].violations, p["s"].distinct_values) == (2, 0.5, 0, 86400e6, 1, 3)
    assert (p["col"].s1_units, p["col"].s2_units, p["col"].distinct_values, p["load"].sd) == ("19", str(2 * 10**36 + 25 + 98), 4, 0.0) and math.isnan(rows[3][1])


def test_running_values_of_a_large_key(spark):
    rows = [(k, i // 2, i, (i * 7) % 5 if i % 4 else None) for k in ["a"] * 3 + ["b"] for i in range(30)]
    df = spark.createDataFrame([(*r, n) for n, r in enumerate(rows)], "k string, o int, i int, v int, n int")
    want = {}
    for k in "ab":
        mine = sorted((o, n, v) for n, (g, o, _, v) in enumerate(rows) if g == k)
        for p, (_, n, _) in enumerate(mine):
            seen = [v for *_, v in mine[: p + 1] if v is not None]
            want[n] = (sum(seen), max(seen, default=None))
    for limit in (1000, 20, 3):
        got = prefix.running(df, ["k"], ["o", "n"], sums={"s": "v"}, maxima={"m": "v"}, rows=limit)
        assert {r.n: (r.s, r.m) for r in got.collect()} == want and set(got.columns) == {*df.columns, "s", "m"}


# ---------------------------------------------------------------- 5
@pytest.mark.parametrize("group_rows", [10**6, 40, 7, 1])
def test_known_at_against_plain_python(spark, group_rows):
    rnd = random.Random(group_rows)
    at = lambda: T0 + dt.timedelta(hours=rnd.randrange(200))
    ks = [1] * 6 + [2, 3, None]
    ev = [(rnd.choice(ks), 2024, i, rnd.choice([None, *range(12)]) if i % 50 == 0 else rnd.randrange(12), at() if i % 40 else None, "clash") for i in range(400)]
    ve = [(rnd.choice(ks), rnd.choice([2024, 2024, 2025]), rnd.randrange(10), at(), i, "clash") for i in range(300)]
    ve += ve[:20]  # repeated rows
    e = spark.createDataFrame(ev, "k bigint, season int, ev_id bigint, bound int, at timestamp_ntz, valid0 string")
    v = spark.createDataFrame(ve, "k bigint, season int, valid int, known timestamp_ntz, version_id bigint, at string")
    want = {}
    for k, s, i, b, t, _ in ev:
        if None in (k, b, t):
            continue
        c = [(x[2], x[3], -x[4]) for x in ve if x[0] == k and x[1] == s and x[2] < b and x[3] <= t]
        if c:
            want[i] = -max(c)[2]
    got = known_at.known_at(e, v, ["k", "season"], group_rows).collect()
    assert len(got) == len(want) and {r.ev_id: r.version_id for r in got} == want
    assert known_at.known_at(e.limit(0), v, ["k", "season"]).count() == 0
    assert known_at.known_at(e, v.limit(0), ["k", "season"]).count() == 0


# ---------------------------------------------------------------- 6
DOC = {
    "id": "7",
    "header": {"competitions": [{"id": 7.0, "competitors": [None, 3, [], {}, {"team": {"id": "1"}, "linescores": [{"displayValue": "7"}, {}, {"value": 3}]}, {"team": {"id": None}, "linescores": [{"value": 1}]}]}, {"competitors": [{"team": {"id": 9}}]}]},
    "boxscore": {
        "teams": {"1": {"statistics": [{"name": "a", "label": "A"}, {"label": "B"}, {"name": " ", "displayValue": "3"}, "x"]}, "season": 2024, "2": {"statistics": {"name": "c"}}},
        "players": [{"team": {"id": 1}, "statistics": {"name": "rush", "athletes": {"athlete": {"id": 5}, "stats": ["1"]}}}, {"team": {"id": 2}, "statistics": [{"keys": [], "athletes": [{"athlete": {"id": 6}}]}]}],
    },
    "betting": {"Oak": {"game_spread": 1.5}, "Ash": {}, "n": 3},
}
FOUND = {
    ("competitor", "7", "1"), ("linescore", "1", "1"), ("linescore", "1", "3"), ("team_stat", "1", "a"), ("team_stat", "1", "B"), ("team_stat", "2", "c"),
    ("athlete_line", "1/rush", "5"), ("betting", "7", "Oak"),
}


def docs(spark, bodies):
    return spark.createDataFrame([(i, g, T0 + dt.timedelta(hours=h), b, "clash") for i, (g, h, b) in enumerate(bodies)], "doc_row_id bigint, game_id bigint, loaded_at timestamp_ntz, body string, doc string")


@pytest.mark.parametrize("wrap", [json.dumps, lambda d: json.dumps([d]), lambda d: json.dumps(json.dumps(d)), lambda d: " \n" + json.dumps([json.dumps(d)], indent=1) + "\n", lambda d: "\ufeff" + json.dumps(d)])
def test_nested_shapes_and_wrappings(spark, wrap):
    df = docs(spark, [(7, 0, '{"betting": {"odds_source": "old"}}'), (7, 1, wrap(DOC)), (7, 2, wrap(DOC)[:-9]), (7, 3, ""), (7, 4, None), (7, 5, "<html>"), (7, 6, "[]"), (7, 7, '"x"'), (7, 8, "3"), *[(7, 9 + i, b) for i, b in enumerate(['{"betting": []} x', "{}{}", "{}]", "{}}", "{},", "[{},{}]", "[{}][", '"{}" 1', "{}],[{}", "{}},{}"])]])
    rows = nested.found_rows(nested.readable_documents(df)).collect()
    assert {tuple(r)[1:] for r in rows} == FOUND and len(rows) == len(FOUND)


def test_nested_tables_keep_links(spark):
    d = nested.readable_documents(docs(spark, [(7, 0, json.dumps(DOC)), (8, 0, "{}")]))
    assert [(r.competition, r.team, r.period, r.score) for r in nested.flat_table(d, "linescore").orderBy("period").collect()] == [("7", "1", 1, "7"), ("7", "1", 3, "3")]
    assert [(r.athlete, r.stat, r.value) for r in nested.athlete_stats(d).collect()] == [("5", "stat_0", "1")]
    assert nested.found_rows(nested.readable_documents(docs(spark, []))).count() == 0


def test_power_index_items(spark):
    bodies = [(1, 0, '{"power_index": {"items": [{"team": "5", "fpi": 1.5}, {}, 3]}}'), (2, 0, '{"power_index": [{"team": 6}]}'), (3, 0, '{"power_index": {"season": 2024}}'), (4, 0, "{}")]
    got = nested.power_index(nested.readable_documents(docs(spark, bodies))).collect()
    assert sorted((r.game_id, r.i, r.fields["team"]) for r in got) == [(1, 0, "5"), (2, 0, "6")]


# ---------------------------------------------------------------- 7
def raw(spark, files):
    rows = [(f, "d", n, json.dumps(r) if r is not None else "{broken") for (f, n), recs in files.items() for r in recs]
    return spark.createDataFrame([(i, *r, "clash") for i, r in enumerate(rows)], "record_row_id bigint, feed_id bigint, dataset string, file_no int, body string, field string")


def test_drift_changes(spark):
    rec = lambda i, **kw: {"id": i, **kw}
    files = {
        (1, 1): [rec(i, a=i, b="t%d" % i, c=i % 2 == 0, n=None, z=i) for i in range(6)],
        (1, 2): [rec(i, A1=str(i), b="t%d" % i, c=i % 2 == 0, n=None, z=i + 0.5) for i in range(3, 9)] + [None],
        (1, 4): [rec(i, A1=None, b=["t%d" % i], d=99 * i, n=1, z=i) for i in range(6, 12)],
        (1, 5): [rec(i, a=i, b=["t%d" % i], d=99 * i, n=2, z=i) for i in range(6, 12)],
        (2, 9): [rec(1, q=1)],
    }
    got = {(r.feed_id, r.file_no, r.field, r.change) for r in drift.changes(raw(spark, files)).collect()}
    assert got == {
        (1, 2, "A1", "renamed"), (1, 2, "A1", "retyped"), (1, 2, "z", "retyped"),
        (1, 4, "b", "retyped"), (1, 4, "c", "removed"), (1, 4, "d", "added"), (1, 4, "z", "retyped"),
        (1, 5, "A1", "removed"), (1, 5, "a", "added"),
    }


def test_drift_type_survives_empty_files_and_renames(spark):
    f = lambda name, v: [{"id": i, name: v(i), "k": "x%d" % i} for i in range(4)]
    files = {(1, 1): f("a", lambda i: i), (1, 2): f("a", lambda i: None), (1, 3): f("a", lambda i: i), (1, 4): [{"id": i, "b": i, "k": "x%d" % i} for i in range(4)], (1, 5): f("b", lambda i: "t%d" % i)}
    got = {(r.file_no, r.field, r.change) for r in drift.changes(raw(spark, files)).collect()}
    assert got == {(4, "b", "renamed"), (5, "b", "retyped")}


def test_drift_unified_table(spark):
    files = {(1, 1): [{"id": i, "a": i, "t": {"value": "x"}} for i in range(4)], (1, 2): [{"id": i, "b": [i], "t": "y"} for i in range(4)], (2, 1): [{"id": 9, "a": "5"}]}
    u = drift.unified_table(raw(spark, files), "d")
    assert dict(u.dtypes)["a"] == "bigint" and "b" not in u.columns
    assert sorted((r.id, r.a, r.t) for r in u.collect()) == sorted([(i, i, t) for i in range(4) for t in "xy"] + [(9, 5, None)])
    case = {(1, 1): [{"id": 1, "EPA": 1.5, "k": 1, "K": "x"}], (2, 1): [{"id": 2, "epa": 2, "k": 5}]}
    c = drift.unified_table(raw(spark, case), "d")
    assert sorted(n.lower() for n in c.columns) == sorted(["feed_id", "file_no", "record_row_id", "id", "epa", "k", "k_2"])
    assert sorted((r.id, r.EPA, r.k, r.K_2) for r in c.collect()) == [(1, 1.5, 1, "x"), (2, 2.0, 5, None)]
    # a name that comes back while its successor lives: both fill one column; records without fields stay
    again = {(1, 1): [{"id": i, "a": i} for i in range(4)], (1, 2): [{"id": i, "b": i} for i in range(4)], (1, 3): [{"id": 7, "b": 8, "a": 9}, {"id": 8, "b": None, "a": 5}], (1, 4): [{}]}
    back = drift.unified_table(raw(spark, again), "d")
    assert sorted((r.file_no, r.id or 0, r.a or 0) for r in back.where("file_no > 2").collect()) == [(3, 7, 9), (3, 8, 5), (4, 0, 0)] and "b" not in back.columns
    assert drift.changes(raw(spark, {})).count() == 0
    assert drift.unified_table(raw(spark, {}), "d").count() == 0
