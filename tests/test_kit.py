"""Expressions, reshaping, gates, models, sinks and streams on tiny frames."""

import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from fieldspark.functions import exprs as X
from fieldspark.operators import fourth_down, gates, labels, leaderboards, metrics, models, odds, plays, reshape, summaries, weekly
from fieldspark.sources import readers, sinks
from fieldspark.streaming import snapshots


def one(spark, *cols):
    return spark.range(1).select(*[c.alias(f"c{i}") for i, c in enumerate(cols)]).first()


# ---------------------------------------------------------------- expressions
def test_null_and_zero_rules(spark):
    lit = F.lit
    r = one(spark, X.safe_div(lit(1.0), lit(0.0)), X.clip_null(lit(None).cast("int"), 0, 5), X.clip_null(lit(9), 0, 5), X.american_prob(lit(-110)), X.american_prob(lit(150)), X.american_prob(lit(0)), X.lookup([1.0, 2.0], lit(7)), X.finite(lit(float("nan"))))
    assert r[0] is None and r[1] is None and r[2] == 5 and r[3] == pytest.approx(110 / 210) and r[4] == pytest.approx(0.4) and r[5] is None and r[6] == 2.0 and r[7] is None
    assert one(spark, X.translate(lit(9.0), -1.0, 1.0, 0.0, 10.0))[0] == 10.0


@pytest.mark.parametrize("x", [-6.0, -2.5, -0.1, 0.0, 0.7, 3.0, 8.0])
def test_norm_cdf(spark, x):
    assert one(spark, X.norm_cdf(F.lit(x)))[0] == pytest.approx(0.5 * math.erfc(-x / math.sqrt(2)), abs=2e-7)


def test_average_rank_puts_nulls_last(spark):
    df = spark.createDataFrame([("a", 3.0), ("b", 1.0), ("c", 3.0), ("d", None), ("e", 5.0), ("f", None)], "k string, v double")
    got = {r.k: (r.up, r.down) for r in df.select("k", X.avg_rank("v", [], ["k"]).alias("up"), X.avg_rank("v", [], ["k"], ascending=False).alias("down")).collect()}
    assert got == {"b": (1, 4), "a": (2.5, 2.5), "c": (2.5, 2.5), "e": (4, 1), "d": (5, 5), "f": (6, 6)}


def test_whole_number_readings(spark):
    texts = ["12", " +12 ", "12.00", "-3", "12.5", "", "abc", "1e3", None, "99999999999999999999"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    assert [r[0] for r in df.orderBy("i").select(X.whole_number("t")).collect()] == [12, 12, 12, -3, None, None, None, None, None, None]


def test_back_fill_and_labels(spark):
    df = spark.createDataFrame([(1, i, "TD" if i == 2 else "run") for i in range(4)], "g int, i int, t string")
    got = labels.next_event(df, ["g"], ["i"], F.col("t") == "TD", F.col("t"), "none").orderBy("i")
    assert [r.next_label for r in got.collect()] == ["TD", "TD", "TD", "none"]
    seq = labels.out_of_sequence(spark.createDataFrame([(1, 1, 5), (1, 2, 3), (1, 3, 4)], "k int, o int, v int"), ["k"], ["o"], "v").orderBy("o")
    assert [r.late_overwrite for r in seq.collect()] == [True, False, False]


# ---------------------------------------------------------------- reshape
def test_union_widens_before_it_casts(spark):
    a, b = spark.createDataFrame([(1, 2)], "x int, y int"), spark.createDataFrame([("t", 2.5, [1])], "x string, y double, z array<int>")
    u = reshape.diagonal_union([a, b])
    assert dict(u.dtypes) == {"x": "string", "y": "double", "z": "array<int>"} and u.count() == 2


def test_cells_and_zips(spark):
    df = spark.createDataFrame([(1, [], [7], [1, 2], ["a", "b"], ["1", "2"]), (2, None, [8], [3], ["a"], ["1", "2"])], "i int, e array<int>, o array<int>, m array<int>, k array<string>, v array<string>")
    n = {r.i: r for r in reshape.normalise_frame(df.select("i", "e", "o", "m")).collect()}
    assert n[1].e is None and n[1].o == "7" and n[1].m == "[1,2]" and n[2].m == "3"
    z = sorted(map(tuple, reshape.unbox(df, "k", "v", ["i"]).collect()))
    assert z == [(1, "a", "1"), (1, "b", "2"), (2, "stat_0", "1"), (2, "stat_1", "2")]


def test_column_conventions(spark):
    df = spark.createDataFrame([(1, 2, 3)], "id int, x_rank_off int, y int")
    assert reshape.rank_last(df).columns == ["id", "x_off_rank", "y"]
    assert reshape.conform(df, ["y", "id"], ("x_rank_off",)).columns == ["y", "id"]
    assert reshape.alias_absent(df, {"y": "z", "id": "y"}).columns == ["id", "x_rank_off", "z"]
    assert reshape.join_suffixed(df, df, ["id"], "_b").columns == ["id", "x_rank_off", "y", "x_rank_off_b", "y_b"]
    assert reshape.numeric_features(df, ["id"]) == ["y"]
    d = {k: v for k, v in zip("sib", spark.range(1).select(*reshape.decode_name(F.lit("x_rank_off")).values()).first(), strict=True)}
    assert d == {"s": "off", "i": True, "b": "x"}


def test_dynamic_objects_skip_scalars(spark):
    df = spark.createDataFrame([(1, '{"10": {"a": 1}, "season": 2024, "11": {"a": 2}}')], "i int, j string")
    assert sorted(r.key for r in reshape.dynamic_objects(df, "j", ["i"]).collect()) == ["10", "11"]


# ---------------------------------------------------------------- plays, boards, odds, weeks
def test_success_and_kneel(spark):
    df = spark.createDataFrame([(1, 10, 5, "x"), (2, 10, 6, "Team takes a knee"), (3, 2, 2, None), (4, None, 5, ""), (7, 1, 9, "")], "d int, y int, g int, t string")
    got = df.select(plays.rule_success(F.col("d"), F.col("y"), F.col("g")).alias("s"), plays.is_kneel(F.col("t")).alias("k")).collect()
    assert [(r.s, r.k) for r in got] == [(True, False), (False, True), (True, False), (False, False), (False, False)]


def test_boards(spark):
    names = spark.createDataFrame([("t", "A", 1), ("t", "A", 1), ("t", "B", 2), ("t", "B", 3), ("t", None, 4)], "team string, name string, id int")
    known = leaderboards.unambiguous(names, ["team", "name"], "id")
    assert [tuple(r) for r in known.collect()] == [("t", "A", 1)]
    rows = spark.createDataFrame([("t", "A", None), ("t", "B", None), ("t", "A", 9)], "team string, name string, id int")
    assert sorted((r.name, r.id) for r in leaderboards.recover_ids(rows, known, ["team", "name"], "id").collect() if r.id) == [("A", 1), ("A", 9)]
    board = spark.createDataFrame([("a", 9, 1.0), ("b", 9, 2.0), ("c", 1, 9.0)], "k string, n int, v double")
    got = {r.k: r.v_rank for r in leaderboards.qualified_ranks(board, ["v"], F.col("n") > 5, [], ["k"]).collect()}
    assert got == {"a": 2.0, "b": 1.0, "c": None}


def test_odds(spark):
    df = spark.createDataFrame([("St. Mary St",), ("Ohio St.",), ("A&M  (TX)",), (None,)], "n string")
    assert [r[0] for r in df.select(odds.name_key(F.col("n"), {"ohio state": "osu"})).collect()] == ["st mary state", "osu", "a and m tx", None]
    votes = spark.createDataFrame([("x", "b"), ("x", "a"), ("x", "a"), ("x", "b"), ("x", None)], "k string, v string")
    assert [tuple(r) for r in odds.modal(votes, ["k"], "v").collect()] == [("x", "a", 2)]
    dbl, flag = (lambda v: F.lit(v).cast("double")), (lambda v: F.lit(v).cast("boolean"))
    # no spread; marked unavailable; the default pair without a mark; a real line that equals the default; an unmarked line
    cases = [(None, 1.0, True), (3.0, 1.0, False), (2.5, 55.5, None), (2.5, 55.5, True), (3.0, 1.0, None), (3.0, None, True)]
    q = one(spark, *[odds.missing_spread(dbl(s), dbl(t), flag(a)) for s, t, a in cases])
    assert tuple(q) == (True, True, True, False, False, False)


def test_weeks(spark):
    tot = spark.createDataFrame([("a", 1, 2, 5.0), ("a", 3, 1, 1.0), ("b", 2, 4, 2.0)], "k string, week int, n bigint, x double")
    cum = weekly.cumulative(tot, ["k"], "week", ["x"], tot.select("week").distinct())
    assert sorted(map(tuple, cum.collect())) == [("a", 1, 2, 5.0), ("a", 2, 2, 5.0), ("a", 3, 3, 6.0), ("b", 2, 4, 2.0), ("b", 3, 4, 2.0)]
    ev = spark.createDataFrame([(1, "a", 2), (2, "a", 1)], "e int, k string, week int")
    assert sorted((r.e, r.n) for r in weekly.as_of_previous(ev, cum, ["k"], "week").collect()) == [(1, 2), (2, None)]
    with pytest.raises(ValueError):
        weekly.assert_boundary(spark.createDataFrame([("a", 1, 5), ("a", 2, 5)], "k string, through_week int, n int"), ["k"], "n")


def test_percentiles_and_drives(spark):
    df = spark.createDataFrame([(float(i),) for i in range(5)] + [(float("nan"),), (None,)], "v double")
    p = {r.pctile: r.v for r in summaries.percentile_table(df, ["v"]).collect()}
    assert p[50] == 2.0 and p[10] == pytest.approx(0.4) and len(p) == 99


# ---------------------------------------------------------------- gates
def test_gates_fire(spark):
    df = spark.createDataFrame([(float(i), 2.0 * i, 1.0) for i in range(60)], "a double, b double, c double")
    with pytest.raises(gates.GateError):
        gates.assert_adjusted(df, {"a": "b"})
    with pytest.raises(gates.GateError):
        gates.assert_spread(df, "c", 0.01)
    with pytest.raises(gates.GateError):
        gates.assert_identity(df, F.col("a"), F.col("b"))
    with pytest.raises(gates.GateError):
        gates.assert_finite(df.withColumn("x", F.lit(float("inf"))), ["x"])
    with pytest.raises(gates.GateError):
        gates.assert_arms_differ(df, ["a"], ["a", "c"])
    with pytest.raises(gates.GateError):
        gates.assert_rows(df.limit(0), "empty")
    gates.assert_identity(df, F.col("b"), 2 * F.col("a"))
    kept, n = gates.kept_and_dropped(df.withColumn("m", F.when(F.col("a") > 9, 1)), ["m"])
    assert n == {"kept": 50, "dropped": 10} and kept.count() == 50


# ---------------------------------------------------------------- metrics and models
def test_auc_counts_ties_half(spark):
    rows = [(0.1, 0), (0.4, 0), (0.4, 1), (0.8, 1), (0.8, 0), (0.9, 1)]
    got = metrics.auc(spark.createDataFrame(rows, "p double, y int"), "p", "y").first()
    pairs = [(a > b) + 0.5 * (a == b) for a, y in rows if y for b, z in rows if not z]
    assert got.auc == pytest.approx(sum(pairs) / len(pairs))


def test_calibration_last_bin_is_closed(spark):
    b = metrics.calibration(spark.createDataFrame([(1.0, 1), (0.95, 0), (0.0, 0)], "p double, y int"), "p", "y", 10)
    assert sorted((r.bin, r.n) for r in b.collect()) == [(0, 1), (9, 2)]
    assert metrics.quantile_bins(spark.createDataFrame([(float(i), 1) for i in range(20)], "p double, y int"), "p", "y", 4).count() == 4


def test_linear_models_recover_planted_effects(spark):
    rng = np.random.default_rng(0)
    x = rng.normal(size=(500, 2))
    y = 3 + x @ [2.0, -1.0]
    df = spark.createDataFrame(pd.DataFrame({"a": x[:, 0], "b": x[:, 1], "y": y}))
    c = models.ols(df, ["a", "b"], "y")
    assert c["intercept"] == pytest.approx(3) and c["a"] == pytest.approx(2) and c["b"] == pytest.approx(-1)
    o, d = rng.normal(size=10), rng.normal(size=10)
    rows = [(int(i), int(j), float(o[i] + d[j] + rng.normal(scale=0.1))) for i in range(10) for j in range(10) if i != j for _ in range(20)]
    adj = models.opponent_adjusted(spark.createDataFrame(rows, "i int, j int, v double"), "i", "j", "v", penalty=1.0)
    assert np.corrcoef(adj["adj_off"], o)[0, 1] > 0.99 and np.corrcoef(adj["adj_def"], d)[0, 1] > 0.99
    assert models.blend_weight(df.withColumn("p", F.col("y")).withColumn("q", F.lit(0.0)), "p", "q", "y") == pytest.approx(1.0)
    smooth, _ = models.spline_fit(df.withColumn("z", F.abs("a")), ["a"], "z")
    assert smooth.select(F.corr("smooth", "z")).first()[0] > 0.98


def test_filter_learns_strength(spark):
    rng = np.random.default_rng(1)
    s = rng.normal(scale=10, size=8)
    rows = [(2024, k // 7, k, int(i), int(j), False, float(s[i] - s[j] + 2.5 + rng.normal())) for k, (i, j) in enumerate((i, j) for _ in range(6) for i in range(8) for j in range(8) if i != j)]
    games = pd.DataFrame(rows, columns=["season", "week", "game_id", "home_id", "away_id", "neutral_site", "margin"])
    g = models.filter_games(games)
    assert (g["margin"] - g["expected"]).abs().tail(150).mean() < 2.5
    fitted = models.fit_filter(spark.createDataFrame(games), rounds=1, grid={"week_var": [0.0, 3.0]})
    assert fitted["week_var"] == 0.0 and models.forecast_score(games, **fitted) >= models.forecast_score(games)


def test_filter_drifts_by_week_and_season():
    rows = [(2023, 1, 1, 10, 20, False, 14.0), (2023, 4, 2, 30, 40, True, 0.0), (2024, 1, 3, 10, 20, True, None)]
    g = models.filter_games(pd.DataFrame(rows, columns=["season", "week", "game_id", "home_id", "away_id", "neutral_site", "margin"]), week_var=2.0, season_var=5.0, season_share=0.5, prior_var=100.0, game_var=256.0, home=2.0)
    first = 100 + 100 + 256
    gain = 100 / first * 12.0
    assert g["expected"].tolist() == pytest.approx([2.0, 0.0, 0.5 * 2 * gain]) and g["variance"].iloc[0] == first
    left = 200 - 200 * 200 / first  # variance of the difference after the game, then three weeks' and a season's drift for both
    assert g["variance"].iloc[2] == pytest.approx((left + 2 * 3 * 2.0) * 0.25 + 2 * 5.0 + 256)


def test_expected_outcome_and_density(spark):
    df = spark.createDataFrame([(1, [0.5, 0.25, 0.25], [0.0, 4.0, 8.0], [False, True, True])], "i int, p array<double>, v array<double>, f array<boolean>")
    assert tuple(models.expected_outcome(df, "p", "v", "f", ["i"]).first()) == (1, 3.0, 6.0, 0.0)
    cells = spark.createDataFrame([(1, 1, 3), (1, 2, 1), (2, 5, 2)], "x int, y int, n int")
    d = models.kde_cells(cells, "x", "y", "n").groupBy("x").agg(F.sum("density").alias("s")).collect()
    assert all(r.s == pytest.approx(1.0) for r in d)


def test_folds_never_look_ahead(spark):
    df = spark.createDataFrame([(s, float(i), float(i * 2)) for s in (1, 2, 3) for i in range(10)], "season int, x double, y double")
    seen = []

    def head(train, test, features, target):
        seen.append((sorted(r[0] for r in train.select("season").distinct().collect()), test.first().season))
        return models.ridge_head(train, test, features, target)

    out = models.folds(df, "season", head, ["x"], "y")
    assert seen == [([1], 2), ([1, 2], 3)] and out.count() == 20
    arms = models.ablation(df, "season", models.ridge_head, {"with": ["x"], "without": []}, "y")
    assert {r.arm: r.n for r in arms.collect()} == {"with": 20, "without": 20}


def test_mllib_head(spark):
    df = spark.createDataFrame([(s, float(i % 10), float(i % 10 > 4)) for s in (1, 2) for i in range(40)], "season int, x double, y double")
    p = models.folds(df, "season", models.HEADS["logistic"], ["x"], "y")
    assert p.where("(pred > 0.5) = (y > 0.5)").count() == 40


# ---------------------------------------------------------------- sources and sinks
def test_season_tables_and_manifest(spark, tmp_path):
    base, df = str(tmp_path), spark.range(5)
    assert sinks.write_season(df, base, "d", 2023, csv=True) == 5
    assert sinks.write_season(df.limit(2), base, "d", 2024) == 2
    assert sinks.write_season(df.limit(3), base, "d", 2023) == 3  # replaced
    assert sinks.write_season(df.limit(0), base, "d", 2025) == 0
    assert [(r.season, r.row_count) for r in sinks.read_manifest(spark, base, "d").collect()] == [(2023, 3), (2024, 2)]
    assert spark.read.parquet(f"{base}/d/parquet").groupBy("season").count().count() == 2
    assert sinks.publish_plan(spark, base, "d", [2023]).count() == 1
    with pytest.raises(ValueError):
        sinks.publish_plan(spark, base, "d", [1999])
    with pytest.raises(ValueError):
        sinks.write_snapshot(df, base, "d", 3, publish=True)
    assert sinks.run_summary(spark, base, ["d"]).first().rows == 5


def test_writing_does_not_hinder_fitting(spark, tmp_path):
    sinks.write_season(spark.range(3), str(tmp_path), "d", 2023)
    df = spark.createDataFrame([(s, float(i % 10), float(i % 10 > 4)) for s in (1, 2) for i in range(40)], "season int, x double, y double")
    assert models.folds(df, "season", models.HEADS["logistic"], ["x"], "y").count() == 40


def test_curves_are_whole_or_an_error(spark, tmp_path, monkeypatch):
    (tmp_path / "c.csv").write_text("x,y\n" + "".join(f"{i},{i / 2}\n" for i in range(1001)))
    assert readers.curve(spark, f"{tmp_path}/c.csv", "x", "y") == [i / 2 for i in range(1001)]
    monkeypatch.setattr(readers, "MAX_CURVE", 1000)
    with pytest.raises(ValueError):
        readers.curve(spark, f"{tmp_path}/c.csv", "x", "y")


def test_readers(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"x": 1}')
    (tmp_path / "b.json").write_text('{"x": ')
    good, bad = readers.json_documents(spark, str(tmp_path))
    assert (good.count(), bad.count()) == (1, 1)
    ids = lambda *v: spark.createDataFrame([(i,) for i in v], "game_id int")
    assert sorted(r[0] for r in readers.union_ids(ids(1, 2), ids(2, 3, 4), ids(1, 3)).collect()) == [1, 3]
    pages, man = spark.createDataFrame([(1, "p"), (2, "q")], "year int, p string"), spark.createDataFrame([(1, True), (2, False)], "year int, complete boolean")
    assert readers.complete_years(pages, man).count() == 1
    with pytest.raises(ValueError):
        readers.complete_years(pages, man, [2])


# ---------------------------------------------------------------- streams
def test_streams_equal_batches(spark, data, tmp_path):
    src = tmp_path / "in"
    spark.read.parquet(f"{data}/events.parquet").repartition(3).write.parquet(str(src))
    schema = spark.read.parquet(str(src)).schema
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(src)).withColumn("week", F.weekofyear("ts"))
    q = snapshots.append_totals(stream, str(tmp_path / "out"), ["event_type"], "week", ["value"], str(tmp_path / "cp"))
    q.awaitTermination(60)
    got = snapshots.merged_totals(spark.read.parquet(str(tmp_path / "out")), ["event_type"], "week", ["value"])
    want = spark.read.parquet(str(src)).groupBy("event_type", F.weekofyear("ts").alias("week")).agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("value"))
    f = lambda d: sorted((r.event_type, r.week, r.n, round(r.value, 6)) for r in d.collect())
    assert f(got) == f(want)


def test_windowed_stream(spark, data, tmp_path):
    ev = spark.readStream.schema(spark.read.parquet(f"{data}/events.parquet").schema).parquet(f"{data}/events.parquet*").withColumn("ts", F.col("ts").cast("timestamp"))
    out = snapshots.windowed_totals(ev, "ts", ["event_type"], "value")
    q = out.writeStream.outputMode("complete").format("memory").queryName("windowed").trigger(availableNow=True).option("checkpointLocation", str(tmp_path / "c")).start()
    q.awaitTermination(60)
    assert spark.sql("select sum(n) from windowed").first()[0] == spark.read.parquet(f"{data}/events.parquet").count()
    assert {"start", "end"} <= set(snapshots.sessions(ev, "ts", "user_id").columns)
    assert snapshots.first_deliveries(ev, "event_id", "ts").isStreaming


# ---------------------------------------------------------------- leaderboards, ranges, groups
def test_passer_board_keeps_who_only_lost_the_ball(spark):
    rows = [("A", "Pass Reception", 2.0, 20, 1), ("A", "Passing Touchdown", 4.0, 30, 1), ("A", "Pass Incompletion", -1.0, 0, 2), ("A", "Sack", -3.0, -8, 2), ("A", "Interception Return", -4.0, None, 2), ("B", "Sack", -2.0, -5, 1), ("C", "Interception Return", -5.0, None, 3), (None, "Sack", -1.0, -1, 1)]
    df = spark.createDataFrame([(1, p, k, e, float(e > 0), y, g) for p, k, e, y, g in rows], "team int, who string, play_type string, epa double, epa_success double, stat_yardage int, game_id int")
    got = {r.passer: r for r in leaderboards.passer_board(df, F.col("who"), ["team"], 1.0).collect()}
    a, b, c = got["A"], got["B"], got["C"]
    assert set(got) == {"A", "B", "C"} and a.team_games == 3
    assert (a.att, a.comp, a.sacked, a.pass_int, a.dropbacks, a.games, a.yards, a.tepa, a.passing_td) == (3, 2, 1, 1, 5, 2, 50, -2.0, 1)
    assert a.comppct == 0.5 and a.epa_play == pytest.approx(-0.4) and a.yards_dropback == pytest.approx(42 / 5) and a.detmer == pytest.approx(25 / 400 * 2) and a.epa_play_rank == 1.0
    assert (b.att, b.sacked, b.games, b.tepa, b.comppct, b.success, b.epa_play_rank) == (0, 1, 1, -2.0, None, None, None) and (c.pass_int, c.comppct, c.tepa) == (1, 0.0, -5.0)


def test_receiver_board(spark):
    texts = [("Al Bo pass complete to Cy Dee for 9 yds", "Pass Reception", 9), ("Al Bo pass incomplete to Cy Dee", "Pass Incompletion", 0), ("Al Bo pass complete to Cy Dee for 30 yds", "Passing Touchdown", 30), ("Al Bo pass incomplete", "Pass Incompletion", 0)]
    df = spark.createDataFrame([(1, t, k, 1.0, 1.0, y, 1) for t, k, y in texts], "team int, play_text string, play_type string, epa double, epa_success double, stat_yardage int, game_id int")
    (r,) = leaderboards.receiver_board(df, leaderboards.actor(F.col("play_text"), leaderboards.CATCHER), ["team"]).collect()
    assert (r.receiver, r.targets, r.comp, r.yards, r.td, r.catchpct, r.epa_play_rank) == ("Cy Dee", 3, 2, 39, 1, pytest.approx(2 / 3), 1.0)


def test_percentiles_of_large_keys_are_exact(spark, monkeypatch):
    from fieldspark.operators import prefix

    rng = np.random.default_rng(3)
    rows = [(k, float(v)) for k, n in (("a", 101), ("b", 7), ("c", 1)) for v in rng.integers(0, 30, n)] + [("a", None), ("a", float("nan"))]
    df = spark.createDataFrame(rows, "k string, v double")
    for limit in (1000, 5):
        monkeypatch.setattr(prefix, "BUCKET_ROWS", limit)
        got = {(r.k, r.i): r.q for r in summaries.exact_percentiles(df, ["k"], "v", [0.0, 0.1, 0.5, 0.975, 1.0]).collect()}
        for k in "abc":
            v = [x for g, x in rows if g == k and x is not None and x == x]
            assert [got[k, i] for i in range(5)] == pytest.approx(np.quantile(v, [0.0, 0.1, 0.5, 0.975, 1.0]).tolist())


def test_groups_joined_back_keep_unknown_keys(spark):
    df = spark.createDataFrame([(None, 1.0), (None, 3.0), ("a", 5.0)], "k string, v double")
    assert sorted((r.k or "", r.v, r.s) for r in reshape.scaled_within(df, ["k"], "v", "s").collect()) == [("", 1.0, 0.0), ("", 3.0, 1.0), ("a", 5.0, 1.0)]
    assert sorted((r.k or "", r.v, r.t) for r in labels.group_total(df, ["k"], "v", "t").collect()) == [("", 1.0, 3.0), ("", 3.0, 3.0), ("a", 5.0, 5.0)]


# ---------------------------------------------------------------- fourth downs, samples, tests
def test_fourth_down_against_every_outcome(spark):
    rng = np.random.default_rng(9)
    win = lambda y, m, s: 1 / (1 + math.exp(-(0.1 * m + 0.02 * (50 - y) + 0.0001 * s)))
    rows, want = [], {}
    for k in range(40):
        y = int(rng.integers(1, 100))
        d = int(rng.integers(1, y + 1)) if k % 3 else min(y, 2)
        m, s, own, other = float(rng.integers(-14, 15)), int(rng.choice([1800, 125, 84, 30])), int(rng.integers(0, 4)), int(rng.integers(0, 4))
        p = rng.dirichlet(np.ones(76))
        rows.append((k, p.tolist(), y, d, m, s, own, other))
        go = ok = okw = 0.0
        for i in range(76):
            g = max(min(i - 10, y), y - 99)
            left = max(s - 6, 0)
            short = lambda t: (t == 0 and left < 120) or (t == 1 and left < 80) or (t == 2 and left < 40)  # noqa: B023, E731
            if g < d:
                w = 0.0 if -m < 0 and short(own) else 1 - win(100 - (y - g), -m, left)
            elif g == y:
                w = 1 - win(75, -m - 6, left)
            else:
                w = 1.0 if m > 0 and short(other) else win(y - g, m, left)
            go += p[i] * w
            if g >= d:
                ok, okw = ok + p[i], okw + p[i] * w
        want[k] = (go, ok, okw / ok if ok else None, (go - okw) / (1 - ok) if ok < 1 else None)
    df = spark.createDataFrame(rows, "k int, probs array<double>, yards_to_goal int, distance int, margin double, seconds int, own_timeouts int, other_timeouts int")
    head = lambda s: X.logistic(0.1 * s["margin"] + 0.02 * (50 - s["yards_to_goal"]) + 0.0001 * s["seconds"])
    got = {r.k: (r.go_wp, r.first_down_prob, r.wp_succeed, r.wp_fail) for r in fourth_down.decide(df, "probs", ["k"], head).collect()}
    for k, w in want.items():
        assert got[k] == pytest.approx(w, abs=1e-9)


def test_ridge_is_standardised(spark):
    rng = np.random.default_rng(2)
    x = np.column_stack([rng.normal(size=60), rng.normal(scale=500, size=60), np.ones(60)])
    y = 2 + x[:, 0] - 0.01 * x[:, 1] + rng.normal(size=60)
    got = models.ridge(spark.createDataFrame(pd.DataFrame({"a": x[:, 0], "b": x[:, 1], "c": x[:, 2], "y": y})), ["a", "b", "c"], "y")
    z = (x[:, :2] - x[:, :2].mean(0)) / x[:, :2].std(0)
    beta = np.linalg.solve(z.T @ z + 10 * np.eye(2), z.T @ (y - y.mean())) / x[:, :2].std(0)
    assert [got["a"], got["b"], got["c"]] == pytest.approx([*beta, 0.0]) and got["intercept"] == pytest.approx(y.mean() - x[:, :2].mean(0) @ beta)


def test_seeded_share_ignores_partitions(spark):
    a = {r.id for r in plays.seeded_share(spark.range(2000, numPartitions=1), "id", 0.25).collect()}
    assert a == {r.id for r in plays.seeded_share(spark.range(2000, numPartitions=7), "id", 0.25).collect()} and 400 < len(a) < 600


def test_play_filters(spark):
    df = spark.createDataFrame([(1, "Rush", False, 0.5, 1.0), (4, "Sack", True, 0.95, 1.0), (5, "Rush", False, 0.5, 1.0), (2, "Timeout", None, None, 1.0), (3, None, True, 0.5, 1.0), (3, "Sack", True, 0.5, None)], "start_down int, play_type string, pass boolean, wp_before double, epa double")
    assert [r.start_down for r in plays.model_rows(df, ["Timeout"], ["epa"]).orderBy("start_down").collect()] == [1, 4]
    assert plays.competitive(df).count() == 4 and plays.passes(df, ["Sack"]).count() == 2


def test_eras_and_totals(spark):
    df = spark.createDataFrame([(y,) for y in (2004, 2006, 2007, 2013, 2014, 2020, 2021, None)], "y int")
    assert [r[0] for r in df.select(X.era("y")).collect()] == [0, 0, 1, 1, 2, 2, 3, 3]
    assert [tuple(r) for r in df.where("y = 2013 or y is null").select(*X.era_dummies("y")).collect()] == [(0, 1, 0, 0), (None,) * 4]
    assert tuple(one(spark, odds.team_total(F.lit(7.0), F.lit(50.0), F.lit(True)), odds.team_total(F.lit(7.0), F.lit(50.0), F.lit(None).cast("boolean")))) == (28.5, 21.5)


def test_sigma_is_recovered(spark):
    rng = np.random.default_rng(0)
    df = spark.createDataFrame(pd.DataFrame({"g": 1, "e": rng.normal(scale=16.0, size=20000)}))
    assert metrics.sigma_from_logs(df, "e", ("g",)).first().sigma == pytest.approx(16.0, rel=0.03)
