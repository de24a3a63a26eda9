
from __future__ import annotations

import json
import math

import numpy as np
import pandas as pd
import pytest

from fieldspark.operators import drift, models, nested, profile


# ---------------------------------------------------------------- opponent_adjusted
def _adjusted_by_hand(p: pd.DataFrame, g: pd.DataFrame, lam: float = 325.0) -> pd.DataFrame:
    """One season of the operator, from a row per play."""
    p = p.merge(g, on="game_id")
    p["hfa"] = np.where(p["neutral_site"], 0, np.where(p["pos_team_id"] == p["home_id"], 1, -1))
    c = p[p["wp_before"].between(0.1, 0.9)]
    offs, defs = (sorted(c[k].unique(), key=str)[1:] for k in ("pos_team_id", "def_pos_team_id"))
    x = np.column_stack([c["hfa"], *[c["pos_team_id"] == t for t in offs], *[c["def_pos_team_id"] == t for t in defs]]).astype(float)
    y = c["epa"].to_numpy()
    z, n = (x - x.mean(0)) / x.std(0), len(y)
    beta = np.linalg.solve(z.T @ z + n * lam / y.std() * np.eye(z.shape[1]), z.T @ (y - y.mean())) / x.std(0)
    icept = y.mean() - x.mean(0) @ beta
    off, deff = dict(zip(offs, icept + beta[1:], strict=False)), dict(zip(defs, icept + beta[1 + len(offs) :], strict=True))
    m = p.groupby(["game_id", "pos_team_id", "def_pos_team_id"], as_index=False)["epa"].mean()
    own = m.assign(off=m["epa"] - m["def_pos_team_id"].map(deff))[["game_id", "pos_team_id", "off"]]
    other = m.assign(deff=m["epa"] - m["pos_team_id"].map(off), pos_team_id=m["def_pos_team_id"])[["game_id", "pos_team_id", "deff"]]
    b = own.merge(other, on=["game_id", "pos_team_id"], how="left")
    b["ok"] = b["off"].notna() & b["deff"].notna()
    t = b.groupby("pos_team_id").agg(valid_games=("ok", "sum"), off=("off", "mean"), deff=("deff", "mean"))
    t = t[t["valid_games"] >= 2]
    t["net"] = t["off"] - t["deff"]
    return t.assign(off_rank=t["off"].rank(ascending=False), def_rank=t["deff"].rank(), net_rank=t["net"].rank(ascending=False))


def test_opponent_adjustment_does_the_whole_job_per_season(spark):
    rng = np.random.default_rng(5)
    plays, games = [], []
    for season in (2023, 2024):
        meet = [(h, a) for h in range(8, 13) for a in range(8, 13) if h < a] + [(99, 12)]  # 99 has one game
        for k, (h, a) in enumerate(meet):
            gid = season * 100 + k
            games.append((gid, h, k % 4 == 0))
            for o, d in ((h, a), (a, h)):
                plays += [(season, gid, o, d, float(rng.normal(0.05 * o - 0.03 * d * (season - 2022), 1.3)), float(rng.uniform())) for _ in range(25)]
    p = pd.DataFrame(plays, columns=["season", "game_id", "pos_team_id", "def_pos_team_id", "epa", "wp_before"])
    g = pd.DataFrame(games, columns=["game_id", "home_id", "neutral_site"])
    got = models.opponent_adjusted_seasons(spark.createDataFrame(p), spark.createDataFrame(g), lam=0.5).toPandas()
    for season in (2023, 2024):
        want = _adjusted_by_hand(p[p["season"] == season], g, 0.5)
        mine = got[got["season"] == season].set_index("team_id").sort_index()
        assert 99 not in mine.index and mine.index.tolist() == want.index.tolist() and mine["valid_games"].tolist() == want["valid_games"].tolist()
        for c, w in {"adj_off_epa": "off", "adj_def_epa": "deff", "net_adj_epa": "net", "adj_off_epa_rank": "off_rank", "adj_def_epa_rank": "def_rank", "net_adj_epa_rank": "net_rank"}.items():
            assert mine[c].tolist() == pytest.approx(want[w].tolist(), abs=1e-8)


def test_opponent_adjusted_query_has_a_row_per_season(spark, data):
    import __spark_entry__ as e

    got = e.queries()["opponent_adjusted"](spark, data)
    assert {"season", "valid_games", "net_adj_epa", "net_adj_epa_rank"} <= set(got.columns)
    rows = got.collect()
    assert rows and len({(r.season, r.team_id) for r in rows}) == len(rows) and all(r.valid_games >= 2 for r in rows)


# ---------------------------------------------------------------- p7_found, p7_plays, p7_team_summaries
def test_renames_are_matched_until_no_pair_is_left(spark):
    old, new = ["flag_a", "flag_b"], ["flag_aa", "flag_zzz"]  # flag_b is nearer to flag_aa, which is flag_a's
    files = {(1, 1): [{"id": i, **dict.fromkeys(old, i % 2)} for i in range(4)], (1, 2): [{"id": i, **dict.fromkeys(new, i % 2)} for i in range(4)]}
    rows = [(f * 100 + n * 10 + i, f, "d", n, json.dumps(r)) for (f, n), rs in files.items() for i, r in enumerate(rs)]
    df = spark.createDataFrame(rows, "record_row_id bigint, feed_id bigint, dataset string, file_no int, body string")
    assert {(r.field, r.change) for r in drift.changes(df).collect()} == {("flag_aa", "renamed"), ("flag_zzz", "renamed")}


# ---------------------------------------------------------------- p4_profile
def test_profile_sums_numbers_of_any_size(spark):
    loads = {1: [10**12, 10**12 + 1, -7], 2: [9 * 10**12, 9 * 10**12 + 5, -(10**37), 10**37]}
    df = spark.createDataFrame([(k, str(v)) for k, vs in loads.items() for v in vs * 2], "load int, v string")
    got = {r.load: r for r in profile.column_profile(df, "load", ["v"]).collect()}
    for k, vs in loads.items():
        vs, r = vs * 2, got[k]
        n, s1, s2 = len(vs), sum(vs), sum(v * v for v in vs)
        assert (r.s0, r.s1, r.s2) == (n, float(s1), float(s2)) and r.mean == pytest.approx(s1 / n, rel=1e-12)
        assert r.sd == pytest.approx(float(n * s2 - s1 * s1) ** 0.5 / n, rel=1e-12)
    assert got[2].std_diff is not None


# ---------------------------------------------------------------- p6_found
@pytest.mark.parametrize("layers", ["s", "sssss", "aaaaaa", "sasasas", "uu", "ususu", " s"])
def test_bodies_are_unwrapped_to_the_last_layer(spark, layers):
    body = json.dumps({"id": 5, "k": "{v"})
    for w in layers:
        body = {"s": json.dumps(body), "a": f"[{body}]", " ": f" \n{body}", "u": '"' + "".join(f"\\u{ord(ch):04x}" for ch in body) + '"'}[w]
    df = spark.createDataFrame([(5, 1, 1, '{"id": 5, "k": "old"}'), (5, 2, 2, body), (6, 1, 3, "[[1]]"), (7, 1, 4, '"no object"')], "game_id bigint, loaded_at int, doc_row_id bigint, body string")
    got = nested.readable_documents(df).selectExpr("game_id", "variant_get(doc, '$.k', 'string') as k").collect()
    assert [tuple(r) for r in got] == [(5, "{v")]


# ---------------------------------------------------------------- season_simulation
def test_simulation_counts_each_season_for_itself(spark):
    games = [(2023, 1, 10, 20, 100.0, 1.0), (2023, 2, 20, 10, -100.0, 1.0), (2024, 3, 10, 20, -100.0, 1.0)]
    got = models.simulate_season(spark.createDataFrame(games, "season int, game_id bigint, home_id bigint, away_id bigint, expected double, sd double"), 20).collect()
    assert {(r.season, r.team_id): (r.mean_wins, r.unbeaten) for r in got} == {(2023, 10): (2.0, 1.0), (2023, 20): (0.0, 0.0), (2024, 10): (0.0, 0.0), (2024, 20): (1.0, 1.0)}


def test_season_simulation_query_uses_forecasts(spark, data):
    import __spark_entry__ as e

    q = e.queries()
    games = q["strength_forecasts"](spark, data).where("season is not null").toPandas()
    assert games["expected"].nunique() > 2
    got = q["season_simulation"](spark, data).toPandas().set_index(["season", "team_id"])
    assert got.index.is_unique
    for season, g in games.groupby("season"):
        teams = set(g["home_id"]) | set(g["away_id"])
        assert set(got.loc[season].index) == teams
        # the simulated mean follows the forecasts' win probabilities
        p = g.apply(lambda r: 0.5 * (1 + math.erf(r["expected"] / (2 * r["variance"]) ** 0.5)), axis=1)
        for t in teams:
            want = p[g["home_id"] == t].sum() + (1 - p[g["away_id"] == t]).sum()
            n = (g["home_id"] == t).sum() + (g["away_id"] == t).sum()
            assert abs(got.loc[(season, t), "mean_wins"] - want) < 5 * (0.25 * n / 200) ** 0.5
