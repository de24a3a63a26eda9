"""Queries of the analytics operators over the play-by-play tables, each with its SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fieldspark.functions import exprs as X
from fieldspark.operators import boxscore, fourth_down, gates, labels, leaderboards, metrics, models, odds, plays, records, reshape, summaries, weekly
from fieldspark.plans.problems import latest_games
from fieldspark.session import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}

# ---------------------------------------------------------------- shared inputs, in SQL
_PLAYS = r"""
plays as (select * from summaries_input where play_id is not null qualify row_number() over (partition by play_id order by load_no desc, loaded_at desc, game_play_number, stat_yardage, down, distance, play_text, epa) = 1),
scrim as (select * from plays where (pass or rush) and epa is not null and pos_team_id is not null and (coalesce(pass, false) or not coalesce(regexp_matches(play_text, '(?i)kneel|takes a knee'), false))),
m as (select *, cast(case start_down when 1 then stat_yardage >= 0.5 * start_distance when 2 then stat_yardage >= 0.7 * start_distance when 3 then stat_yardage >= start_distance when 4 then stat_yardage >= start_distance else false end as double) success0,
  cast(epa > 0 as double) epa_success, case when pass then epa >= 2.4 when coalesce(rush, false) then epa >= 1.8 else false end explosive, stat_yardage <= 0 play_stuffed, yards_to_goal <= 20 red_zone,
  coalesce(regexp_matches(lower(play_type), 'sack|interception|fumble'), false) or coalesce(stat_yardage < 0, false) havoc, coalesce(rush, false) and stat_yardage >= 4 opportunity_run,
  case when coalesce(rush, false) and stat_yardage is not null then cast(least(stat_yardage, 10) as double) end adj,
  case when start_down = 3 then cast(epa > 0 as double) end third_down_success, case when start_down <= 2 then epa end early_down_epa from scrim),
ms as (select *, coalesce(success0, 0.0) success, case when adj is null then null when stat_yardage < 0 then 1.2 * adj when stat_yardage <= 4 then adj when stat_yardage <= 10 then 0.5 * adj else 0.0 end line_yards,
  case when adj is null then null else (case when stat_yardage >= 5 then 0.5 * (adj - 5) else 0.0 end) + (case when stat_yardage > 10 then stat_yardage - adj else 0.0 end) end highlight_yards from m)"""
_GAMES = "games as (select * from schedules where game_id is not null qualify row_number() over (partition by game_id order by loaded_at desc) = 1)"
_AVG_RANK = "case when {x} is not null then rank() over (partition by {p} order by {x} {d} nulls last) + (count(*) over (partition by {p}, {x}) - 1) / 2.0 else cast(row_number() over (partition by {p} order by {x} {d} nulls last, {t}) as double) end"


def query(sql: str | None = None):
    def add(f: Callable[[SparkSession, str], DataFrame]):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


#: Added before rounding, so that halves fall the same way whatever order a sum was taken in.
NUDGE = 1e-10


def rnd(c, digits: int) -> Column:
    return F.round(X.col(c) + F.lit(NUDGE), digits)


def r6(c, name: str | None = None) -> Column:
    return rnd(c, 6).alias(name or c)


def _nudged(sql: str) -> str:
    """The same nudge in every round(x, 6 | 4 | 2) of an SQL text."""
    out, i = "", 0
    while (j := sql.find("round(", i)) >= 0:
        k, depth, comma = j + 6, 1, -1
        while depth:
            depth += {"(": 1, ")": -1}.get(sql[k], 0)
            if sql[k] == "," and depth == 1:
                comma = k
            k += 1
        inner, digits = (sql[j + 6 : comma], sql[comma + 1 : k - 1].strip()) if comma > 0 else (sql[j + 6 : k - 1], "")
        out += sql[i:j] + (f"round(({_nudged(inner)}) + {NUDGE}, {digits})" if digits in ("6", "4", "2") else f"round({_nudged(inner)}" + (f", {digits})" if digits else ")"))
        i = k
    return out + sql[i:]


def all_plays(spark: SparkSession, d: str) -> DataFrame:
    return plays.latest_delivery(table(spark, d, "summaries_input"))


def measured(spark: SparkSession, d: str) -> DataFrame:
    return plays.with_measures(plays.scrimmage(all_plays(spark, d)))


def game_margins(spark: SparkSession, d: str) -> DataFrame:
    return latest_games(spark, d).withColumn("margin", F.col("home_score") - F.col("away_score"))


# ---------------------------------------------------------------- plays and summaries
@query("with " + _PLAYS + """
select play_id, success, epa_success, explosive, havoc, play_stuffed, round(line_yards, 6) line_yards, round(highlight_yards, 6) highlight_yards, opportunity_run from ms""")  # fmt: skip
def play_measures(spark, d):
    return measured(spark, d).select("play_id", "success", "epa_success", "explosive", "havoc", "play_stuffed", r6("line_yards"), r6("highlight_yards"), "opportunity_run")


_SIDE = """
sides as (select season, 'off' side, pos_team_id team_id, ms.* exclude (season) from ms where pos_team_id is not null union all select season, 'def', def_pos_team_id, ms.* exclude (season) from ms where def_pos_team_id is not null),
ph as (select 'all' phase, * from sides union all select 'pass', * from sides where pass union all select 'rush', * from sides where rush),
agg as (select season, side, team_id, phase, count(*) plays, count(distinct game_id) n_games, count(distinct drive_id) + max(case when drive_id is null then 1 else 0 end) drives, coalesce(sum(epa), 0) tepa, avg(epa) epa_play,
  coalesce(sum(stat_yardage), 0) yards, avg(stat_yardage) yards_play, avg(epa_success) success, avg(cast(explosive as double)) explosive, avg(cast(havoc as double)) havoc, avg(third_down_success) third_down_success, avg(early_down_epa) early_down_epa,
  avg(line_yards) line_yards, avg(cast(pass as double)) passrate from ph group by all)"""


@query("with " + _PLAYS + "," + _SIDE + """
select season, team_id, max(case side when 'off' then plays end) plays_off, max(case side when 'def' then plays end) plays_def,
  round(max(case side when 'off' then tepa end), 6) tepa_off, round(max(case side when 'def' then tepa end), 6) tepa_def, round(max(case side when 'off' then epa_play end), 6) epa_play_off, round(max(case side when 'def' then epa_play end), 6) epa_play_def,
  round(max(case side when 'off' then success end), 6) success_off, round(max(case side when 'def' then success end), 6) success_def
from agg where phase = 'all' group by 1, 2 having count(*) filter (side = 'off') > 0""")  # fmt: skip
def side_summary(spark, d):
    s = summaries.side_summaries(measured(spark, d)).where("phase = 'all'")
    w = summaries.two_sided(s, ["season"], ["plays", "tepa", "epa_play", "success"])
    return w.select("season", "team_id", *[F.col(c).cast("bigint").alias(c) for c in ("plays_off", "plays_def")], *[r6(f"{m}_{x}") for m in ("tepa", "epa_play", "success") for x in ("off", "def")])


@query("with " + _PLAYS + "," + _SIDE + """
, w as (select season, team_id, max(case side when 'off' then epa_play end) o, max(case side when 'def' then epa_play end) f from agg where phase = 'all' group by 1, 2 having count(*) filter (side = 'off') > 0),
r as (select season, team_id, round(o - f, 9) x from w)
select season, team_id, round(x, 6) epa_play_margin, """ + _AVG_RANK.format(x="x", p="season", d="desc", t="team_id") + " epa_play_margin_rank from r")  # fmt: skip
def margins_ranked(spark, d):
    s = summaries.side_summaries(measured(spark, d)).where("phase = 'all'")
    w = summaries.two_sided(s, ["season"], ["epa_play"]).withColumn("epa_play_off", F.round("epa_play_off", 9)).withColumn("epa_play_def", F.round("epa_play_def", 9))
    m = w.withColumn("epa_play_margin", F.round(F.col("epa_play_off") - F.col("epa_play_def"), 9))
    return m.select("season", "team_id", r6("epa_play_margin"), X.avg_rank("epa_play_margin", [], ["team_id"], ascending=False, partition=["season"]).alias("epa_play_margin_rank"))


@query("with " + _PLAYS + "," + _SIDE + """
select season, side, team_id, phase, plays, n_games, drives, round(tepa, 6) tepa, round(epa_play, 6) epa_play, cast(yards as bigint) yards, round(success, 6) success, round(explosive, 6) explosive, round(havoc, 6) havoc,
  round(third_down_success, 6) third_down_success, round(early_down_epa, 6) early_down_epa, round(line_yards, 6) line_yards, round(yards / nullif(drives, 0)::double, 6) yards_drive, round(tepa / nullif(n_games, 0)::double, 6) epa_game from agg""")  # fmt: skip
def phase_split(spark, d):
    s = summaries.side_summaries(measured(spark, d))
    return s.select("season", "side", "team_id", "phase", "plays", "n_games", "drives", r6("tepa"), r6("epa_play"), F.col("yards").cast("bigint").alias("yards"), *[r6(c) for c in ("success", "explosive", "havoc", "third_down_success", "early_down_epa", "line_yards", "yards_drive", "epa_game")])


@query("with " + _PLAYS + """
, per as (select season, pos_team_id team_id, drive_id, arg_min(yards_to_goal, (coalesce(game_play_number, -1), play_id)) filter (yards_to_goal is not null) available, sum(coalesce(stat_yardage, 0)) gained from plays where drive_id is not null and pos_team_id is not null group by 1, 2, 3)
select season, team_id, cast(coalesce(sum(available), 0) as bigint) available_yards, cast(sum(gained) as bigint) gained_yards, round(sum(gained) / nullif(sum(available), 0)::double, 6) available_yards_pct from per group by 1, 2""")  # fmt: skip
def first_last_two_level(spark, d):
    t = summaries.drive_yards(all_plays(spark, d), "pos_team_id")
    return t.select("season", "team_id", F.col("available_yards").cast("bigint").alias("available_yards"), F.col("gained_yards").cast("bigint").alias("gained_yards"), r6("available_yards_pct"))


_RUSHERS = ", who as (select *, case when regexp_extract(play_text, '^(.+?) (?:run|rush) for ', 1) <> '' and upper(regexp_extract(play_text, '^(.+?) (?:run|rush) for ', 1)) <> 'TEAM' then regexp_extract(play_text, '^(.+?) (?:run|rush) for ', 1) end player from ms where rush)"


def _rushers(spark, d):
    return measured(spark, d).where("rush").withColumn("player", leaderboards.actor(F.col("play_text"), leaderboards.RUNNER))


@query("with " + _PLAYS + _RUSHERS + """
, g as (select season, pos_team_id, player, count(*) plays, count(distinct game_id) games, round(sum(epa), 6) tepa, round(avg(epa), 9) epa_play, coalesce(sum(stat_yardage), 0) yards from who where player is not null group by 1, 2, 3),
q as (select *, plays >= 3 ok, case when plays >= 3 then epa_play end x from g)
select season, pos_team_id, player, plays, games, tepa, cast(yards as bigint) yards, case when ok then """ + _AVG_RANK.format(x="x", p="season", d="desc", t="pos_team_id, player") + " end epa_play_rank from q")  # fmt: skip
def leaderboard_qualified(spark, d):
    b = leaderboards.player_summary(_rushers(spark, d), "player", ["season", "pos_team_id"]).withColumn("epa_play", F.round("epa_play", 9))
    r = leaderboards.qualified_ranks(b, ["epa_play"], F.col("plays") >= 3, ["season"], ["pos_team_id", "player"])
    return r.select("season", "pos_team_id", "player", "plays", "games", r6("tepa"), F.col("yards").cast("bigint").alias("yards"), "epa_play_rank")


@query("with " + _PLAYS + _RUSHERS + """
select season, week, player, count(*) rushes, cast(sum(stat_yardage) as bigint) yards, max_by(pos_team_id, (game_play_number, play_id)) team_id, round(avg(cast(epa > 0 as double)), 6) positive from who where player is not null group by 1, 2, 3
having count(*) >= 2 qualify row_number() over (partition by season, week order by sum(stat_yardage) desc, player) <= 10""".replace("max_by(pos_team_id, (game_play_number, play_id))", "arg_max(pos_team_id, (game_play_number, play_id))"))  # fmt: skip
def week_leaders(spark, d):
    g = _rushers(spark, d).where("player is not null and stat_yardage is not null").groupBy("season", "week", "player").agg(
        F.count(F.lit(1)).alias("rushes"), F.sum("stat_yardage").alias("yards"), X.last_by("pos_team_id", "game_play_number", "play_id").alias("team_id"), F.avg((F.col("epa") > 0).cast("double")).alias("positive")
    )
    w = Window.partitionBy("season", "week").orderBy(F.desc("yards"), "player")
    return g.where("rushes >= 2").withColumn("r", F.row_number().over(w)).where("r <= 10").select("season", "week", "player", "rushes", "yards", "team_id", r6("positive"))


SQL["week_leaders"] = SQL["week_leaders"].replace("where player is not null", "where player is not null and stat_yardage is not null")


@query("with " + _PLAYS + """
, p as (select season, pos_team_id, regexp_extract(play_text, '^(.+?) pass ', 1) player, count(*) att from scrim where pass and regexp_extract(play_text, '^(.+?) pass ', 1) <> '' and upper(regexp_extract(play_text, '^(.+?) pass ', 1)) <> 'TEAM' group by 1, 2, 3),
r as (select season, pos_team_id, regexp_extract(play_text, '^(.+?) (?:run|rush) for ', 1) player, count(*) rushes from scrim where rush and regexp_extract(play_text, '^(.+?) (?:run|rush) for ', 1) <> '' and upper(regexp_extract(play_text, '^(.+?) (?:run|rush) for ', 1)) <> 'TEAM' group by 1, 2, 3)
select season, pos_team_id, player, coalesce(att, 0) att, coalesce(rushes, 0) rushes from p full join r using (season, pos_team_id, player)""")  # fmt: skip
def full_outer_union(spark, d):
    s = plays.scrimmage(all_plays(spark, d))
    keys = ["season", "pos_team_id", "player"]
    one = lambda on, pat, out: s.where(on).withColumn("player", leaderboards.actor(F.col("play_text"), pat)).where("player is not null").groupBy(*keys).agg(F.count(F.lit(1)).alias(out))
    return leaderboards.key_union([one("pass", leaderboards.PASSER, "att"), one("rush", leaderboards.RUNNER, "rushes")], keys, ["att", "rushes"])


_PASSER = "coalesce(nullif(regexp_extract(play_text, '^(.+?) pass ', 1), ''), nullif(regexp_extract(play_text, '^(.+?) sacked ', 1), ''), nullif(regexp_extract(play_text, '^(.+?) pass intercepted', 1), ''))"
#: Dropbacks for every team game; the invented names of the tables recur too seldom for the published 14.
_PER_GAME = 0.15


@query("with " + _PLAYS + f""", d as (select *, case when upper({_PASSER}) <> 'TEAM' then {_PASSER} end passer, coalesce(contains(lower(play_type), 'sack'), false) sk, coalesce(contains(lower(play_type), 'interception'), false) pk, coalesce(contains(lower(play_type), 'incompletion'), false) inc,
  coalesce(contains(lower(play_type), 'touchdown'), false) td from ms where pass), tg as (select season, pos_team_id, count(distinct game_id) team_games from d group by 1, 2),
b as (select season, pos_team_id, passer, count(*) filter (not sk and not pk) att, count(*) filter (not sk and not pk and not inc) comp, count(*) filter (not sk and not pk and not inc and td) passing_td,
  coalesce(nullif(count(distinct game_id) filter (not sk and not pk), 0), count(distinct game_id)) games, count(*) filter (sk) sacked, count(*) filter (pk and not sk) pass_int, coalesce(sum(stat_yardage) filter (sk), 0) sack_yds, coalesce(sum(epa), 0) tepa,
  coalesce(sum(stat_yardage) filter (not sk and not pk and not inc), 0) yards, avg(epa_success) filter (not sk and not pk) success from d where passer is not null group by 1, 2, 3),
c as (select *, att + sacked + pass_int dropbacks, round(tepa / (att + sacked + pass_int), 9) epa_play, round(comp / nullif(att + pass_int, 0)::double, 9) comppct, round(yards / games::double / 400 * ((passing_td + pass_int) / (1.0 + abs(passing_td - pass_int))), 9) detmer from b join tg using (season, pos_team_id)),
q as (select *, dropbacks >= {_PER_GAME} * team_games enough, case when dropbacks >= {_PER_GAME} * team_games then epa_play end x, case when dropbacks >= {_PER_GAME} * team_games then comppct end y from c)
select season, pos_team_id, passer, att, comp, passing_td, games, sacked, pass_int, cast(yards as bigint) yards, dropbacks, team_games, round(tepa, 6) tepa, round(epa_play, 6) epa_play, round(comppct, 6) comppct, round(detmer, 6) detmer, round((yards - abs(sack_yds)) / dropbacks::double, 6) yards_dropback,
  case when enough then """ + _AVG_RANK.format(x="x", p="season", d="desc", t="season, pos_team_id, passer") + " end epa_play_rank, case when enough then " + _AVG_RANK.format(x="y", p="season", d="desc", t="season, pos_team_id, passer") + " end comppct_rank from q")  # fmt: skip
def leaderboard_passers(spark, d):
    p = measured(spark, d).where("pass")
    who = F.coalesce(*[leaderboards.actor(F.col("play_text"), x) for x in (leaderboards.PASSER, leaderboards.SACKED, leaderboards.PICKED)])
    b = leaderboards.passer_board(p, who, ["season", "pos_team_id"], _PER_GAME, ["season"])
    counts = ["att", "comp", "passing_td", "games", "sacked", "pass_int", F.col("yards").cast("bigint").alias("yards"), "dropbacks", "team_games"]
    return b.select("season", "pos_team_id", "passer", *counts, *[r6(c) for c in ("tepa", "epa_play", "comppct", "detmer", "yards_dropback")], "epa_play_rank", "comppct_rank")


@query("""with pairs as (select distinct school, abbreviation, team_id from teams where school is not null and abbreviation is not null and team_id is not null)
select * from pairs anti join (select school, abbreviation from pairs group by 1, 2 having count(*) > 1) using (school, abbreviation)""")  # fmt: skip
def ambiguous_anti(spark, d):
    return leaderboards.unambiguous(table(spark, d, "teams"), ["school", "abbreviation"], "team_id").select("school", "abbreviation", "team_id")


_PCT = ["epa_play", "success", "yards_play", "explosive"]


@query("with " + _PLAYS + """
, g as (select game_id, pos_team_id, avg(epa) epa_play, avg(epa_success) success, avg(stat_yardage) yards_play, avg(cast(explosive as double)) explosive from ms group by 1, 2), p as (select unnest(range(1, 100)) pctile)
select cast(pctile as int) pctile, """ + ", ".join(f"round((select quantile_cont({c}, list_transform(range(1, 100), lambda i: i / 100.0)) from g)[pctile], 6) {c}" for c in _PCT) + " from p")  # fmt: skip
def percentile_table(spark, d):
    g = measured(spark, d).groupBy("game_id", "pos_team_id").agg(F.avg("epa").alias("epa_play"), F.avg("epa_success").alias("success"), F.avg("stat_yardage").alias("yards_play"), F.avg(F.col("explosive").cast("double")).alias("explosive"))
    return summaries.percentile_table(g, _PCT).select("pctile", *[r6(c) for c in _PCT])


@query("with " + _PLAYS + """
, w as (select game_id, abs(wp_before - lag(wp_before) over (partition by game_id order by game_play_number nulls first, play_id)) a from plays where game_id is not null)
select game_id, round(coalesce(sum(a), 0) * 179.01777401608126 / count(*), 6) gei, count(*) plays from w group by 1""")  # fmt: skip
def game_excitement(spark, d):
    return summaries.game_excitement(all_plays(spark, d).where("game_id is not null"), plays.GEI_NORM).select("game_id", r6("gei"), "plays")


@query("with " + _PLAYS + "select game_id, round(avg(epa), 6) mean_epa, count(*) plays from scrim group by 1 having abs(avg(epa)) > 0.1")
def implausible_games(spark, d):
    return summaries.implausible_games(plays.scrimmage(all_plays(spark, d)), 0.1).select("game_id", r6("mean_epa"), "plays")


@query()
def matchup_table(spark, d):
    s = summaries.side_summaries(measured(spark, d)).where("phase = 'all'").select("season", "team_id", "side", "epa_play")
    a = s.where("side = 'off'").select("season", F.col("team_id").alias("away_id"), F.col("epa_play").alias("o"))
    h = s.where("side = 'def'").select("season", F.col("team_id").alias("home_id"), F.col("epa_play").alias("f"))
    return latest_games(spark, d).join(a, ["season", "away_id"]).join(h, ["season", "home_id"]).select("game_id", r6("o", "away_off"), r6("f", "home_def"), rnd(F.col("o") - F.col("f"), 6).alias("edge"))


SQL["matchup_table"] = "with " + _PLAYS + "," + _SIDE + """, games0 as (select * from schedules where game_id is not null qualify row_number() over (partition by game_id order by loaded_at desc) = 1)
select g.game_id, round(a.epa_play, 6) away_off, round(h.epa_play, 6) home_def, round(a.epa_play - h.epa_play, 6) edge from games0 g join agg a on a.season = g.season and a.team_id = g.away_id and a.side = 'off' and a.phase = 'all'
join agg h on h.season = g.season and h.team_id = g.home_id and h.side = 'def' and h.phase = 'all'"""


# ---------------------------------------------------------------- names, odds, crosswalks
@query(r"""select team_row_id, trim(regexp_replace(regexp_replace(regexp_replace(replace(regexp_replace(replace(lower(trim(school)), '&', ' and '), '[.]', '', 'g'), ' st ', ' state '), ' st$', ' state'), '[^a-z0-9 ]+', ' ', 'g'), '\s+', ' ', 'g')) school_key from teams""")
def name_normalize(spark, d):
    return table(spark, d, "teams").select("team_row_id", odds.name_key(F.col("school")).alias("school_key"))


@query("""select l_partkey, greatest(least(round(median(l_extendedprice / l_quantity), 6), 1500.0), 950.0) price, count(*) books from lineitem group by 1""")
def consensus_median(spark, d):
    li = table(spark, d, "lineitem").withColumn("price", F.col("l_extendedprice") / F.col("l_quantity"))
    c = odds.consensus(li, ["l_partkey"], "price")
    return c.select("l_partkey", X.clip_null(rnd("price", 6), 950.0, 1500.0).alias("price"), "books")


@query("select user_id, event_type, n from (select user_id, event_type, count(*) n, row_number() over (partition by user_id order by count(*) desc, event_type) r from events where event_type is not null group by 1, 2) where r = 1")
def modal_crosswalk(spark, d):
    return odds.modal(table(spark, d, "events"), ["user_id"], "event_type")


_QUOTES = "q as (select c_mktsegment seg, case o_orderstatus when 'F' then 'home' when 'O' then 'away' end side, cast(round(o_totalprice / 500) - 300 as double) o from orders join customer on o_custkey = c_custkey)"


@query("with " + _QUOTES + """, p as (select seg, side, case when o < 0 then -o / (-o + 100) when o > 0 then 100 / (o + 100) end x from q),
m as (select seg, median(x) filter (side = 'home') a, median(x) filter (side = 'away') b from p group by 1) select seg, round(a / (a + b), 6) home_prob, round(b / (a + b), 6) away_prob from m""")  # fmt: skip
def devig_pivot(spark, d):
    q = table(spark, d, "orders").join(table(spark, d, "customer"), F.col("o_custkey") == F.col("c_custkey")).select(
        F.col("c_mktsegment").alias("seg"), F.when(F.col("o_orderstatus") == "F", "home").when(F.col("o_orderstatus") == "O", "away").alias("side"), (F.round(F.col("o_totalprice") / 500) - 300).alias("o")
    )
    return odds.devig(q, "seg", "side", "o").select("seg", r6("home_prob"), r6("away_prob"))


@query("with " + _GAMES + """, b as (select game_id, cast(home_score - away_score as double) spread, case when attendance > 20000 then 55.5 end total, neutral_site available from games),
c as (select season * 100 + week k, median(cast(home_score - away_score as double)) s from games where home_score is not null and away_score is not null group by 1)
select b.game_id, case when gap and c.s is not null then c.s else b.spread end spread, case when gap and c.s is not null then 55.5 else b.total end total, gap and c.s is not null filled
from (select *, spread is null or coalesce(not available, false) or (coalesce(spread = 2.5 and total = 55.5, false) and not coalesce(available, false)) gap from b) b join games g using (game_id) left join c on c.k = g.season * 100 + g.week""")  # fmt: skip
def spread_backfill(spark, d):
    g = game_margins(spark, d)
    k = F.col("season") * 100 + F.col("week")
    full = g.join(latest_attendance(spark, d), "game_id")
    base = full.select("game_id", k.alias("k"), F.col("margin").cast("double").alias("spread"), F.when(F.col("attendance") > 20000, 55.5).alias("total"), F.col("neutral_site").alias("available"))
    cons = g.where("margin is not null").groupBy(k.alias("k")).agg(F.median("margin").alias("spread")).withColumn("total", F.lit(None).cast("double"))
    return odds.backfill(base, cons, "k").select("game_id", "spread", "total", "filled")


def latest_attendance(spark, d):
    return summaries.latest_per_key(table(spark, d, "schedules").where("game_id is not null"), ["game_id"], F.desc("loaded_at")).select("game_id", "attendance")


_ARCHIVE = "game_id week season_type kickoff home_id away_id neutral_site home_score away_score venue attendance status loaded_at".split()


@query("select season, count(*) as \"rows\", " + ", ".join(f"count(*) filter ({c} is null) null_{c}" for c in _ARCHIVE) + " from schedules group by 1")
def archive_report(spark, d):
    return odds.archive_report(table(spark, d, "schedules"))


# ---------------------------------------------------------------- windows and labels
@query("select event_id, user_id, first_value(case when event_type = 'purchase' then event_id end ignore nulls) over (partition by user_id order by ts, event_id rows between current row and unbounded following) next_label from events")
def backward_fill(spark, d):
    return labels.next_event(table(spark, d, "events"), ["user_id"], ["ts", "event_id"], F.col("event_type") == "purchase", F.col("event_id")).select("event_id", "user_id", "next_label")


@query("with " + _PLAYS + """, h as (select *, case when period <= 2 then 1 when period <= 4 then 2 else 3 end half, case when regexp_matches(lower(play_type), 'touchdown') then 'TD' when regexp_matches(lower(play_type), 'field goal good') then 'FG' end ev from plays)
select play_id, coalesce(first_value(ev ignore nulls) over (partition by game_id, half order by game_play_number nulls first, play_id rows between current row and unbounded following), 'none') next_label from h""")  # fmt: skip
def next_score(spark, d):
    t = F.lower("play_type")
    ev = F.when(t.rlike("touchdown"), "TD").when(t.rlike("field goal good"), "FG")
    p = all_plays(spark, d).withColumn("half", F.when(F.col("period") <= 2, 1).when(F.col("period") <= 4, 2).otherwise(3))
    return labels.next_event(p, ["game_id", "half"], ["game_play_number", "play_id"], ev.isNotNull(), ev, "none").select("play_id", "next_label")


@query("select event_id, user_id, max(value) over (partition by user_id) top, value = max(value) over (partition by user_id) is_top from events")
def group_total_flag(spark, d):
    return labels.group_total(table(spark, d, "events"), ["user_id"], "value", "top").select("event_id", "user_id", "top", (F.col("value") == F.col("top")).alias("is_top"))


@query("""with y as (select o_custkey, year(o_orderdate) yr, round(sum(o_totalprice), 4) spend, count(*) n from orders group by 1, 2)
select o_custkey, yr, spend, lag(spend) over (partition by o_custkey order by yr) prev_spend, lag(n) over (partition by o_custkey order by yr) prev_n, round(sqrt(n), 6) weight from y""")  # fmt: skip
def season_lag(spark, d):
    y = table(spark, d, "orders").groupBy("o_custkey", F.year("o_orderdate").cast("bigint").alias("yr")).agg(rnd(F.sum("o_totalprice"), 4).alias("spend"), F.count(F.lit(1)).alias("n"))
    return labels.lagged(y, ["o_custkey"], ["yr"], ["spend", "n"]).select("o_custkey", "yr", "spend", "prev_spend", "prev_n", rnd(F.sqrt("n"), 6).alias("weight"))


_LONG = "sides as (select season, week, game_id, kickoff, home_id team_id, away_id opp_id, home_score - away_score margin from games where home_id is not null union all select season, week, game_id, kickoff, away_id, home_id, away_score - home_score from games where away_id is not null)"


def team_games(spark, d):
    g = latest_games(spark, d).withColumn("hm", F.col("home_score") - F.col("away_score")).withColumn("am", F.col("away_score") - F.col("home_score"))
    sides = {"home": {"team_id": "home_id", "opp_id": "away_id", "margin": "hm"}, "away": {"team_id": "away_id", "opp_id": "home_id", "margin": "am"}}
    return reshape.long_sides(g, ["season", "week", "game_id", "kickoff"], sides).drop("side").where("team_id is not null")


@query("with " + _GAMES + "," + _LONG + " select * from sides")
def home_away_long(spark, d):
    return team_games(spark, d)


@query("with " + _GAMES + "," + _LONG + " select game_id, team_id, cast(date_diff('day', lag(cast(kickoff as date)) over (partition by team_id, season order by kickoff, game_id), cast(kickoff as date)) as int) rest_days from sides")
def rest_days(spark, d):
    return labels.rest_days(team_games(spark, d), "team_id", "season", "kickoff", "game_id").select("game_id", "team_id", "rest_days")


@query("""select event_id, later_min, coalesce(later_min < value, false) late_overwrite from (select event_id, value, min(value) over (partition by event_type order by ts, event_id rows between 1 following and unbounded following) later_min from events)""")
def out_of_sequence(spark, d):
    return labels.out_of_sequence(table(spark, d, "events"), ["event_type"], ["ts", "event_id"], "value").select("event_id", "later_min", "late_overwrite")


@query("with " + _PLAYS + " select play_id, pos_team_id, count(distinct game_id) over (partition by pos_team_id) + max(case when game_id is null then 1 else 0 end) over (partition by pos_team_id) team_games from scrim")
def distinct_window(spark, d):
    return summaries.distinct_over(plays.scrimmage(all_plays(spark, d)), ["pos_team_id"], "game_id", "team_games").select("play_id", "pos_team_id", "team_games")


@query("select o_custkey, o_orderkey, o_orderdate, o_totalprice from orders qualify row_number() over (partition by o_custkey order by o_orderdate desc, o_orderkey desc) = 1")
def latest_per_key(spark, d):
    return summaries.latest_per_key(table(spark, d, "orders"), ["o_custkey"], F.desc("o_orderdate"), F.desc("o_orderkey")).select("o_custkey", "o_orderkey", "o_orderdate", "o_totalprice")


@query("""with m as (select o_custkey, avg(o_totalprice) mean, count(*) n from (select * from orders qualify row_number() over (partition by o_custkey order by o_orderdate desc, o_orderkey desc) <= 4) group by 1)
select o_custkey, round(greatest(mean, (select quantile_cont(mean, 0.02) from m)), 4) mean, n from m""")  # fmt: skip
def last_n_mean_floor(spark, d):
    return labels.last_n_mean(table(spark, d, "orders"), "o_custkey", [F.desc("o_orderdate"), F.desc("o_orderkey")], "o_totalprice", 4, 0.02).select("o_custkey", rnd("mean", 4).alias("mean"), "n")


@query("select l_suppkey, round(sum(l_discount * l_quantity) / nullif(sum(l_quantity), 0), 6) discount from lineitem group by 1")
def weighted_mean(spark, d):
    return table(spark, d, "lineitem").groupBy("l_suppkey").agg(rnd(X.safe_div(F.sum(F.col("l_discount") * F.col("l_quantity")), F.sum("l_quantity")), 6).alias("discount"))


# ---------------------------------------------------------------- weekly snapshots and as-of
_WEEKLY = ", tot as (select season, pos_team_id team_id, week, count(*) n, sum(epa) epa from scrim where week is not null group by 1, 2, 3), cal as (select distinct week from tot), cum as (select t.season, t.team_id, c.week through_week, sum(t.n) n, sum(t.epa) epa from tot t join cal c on t.week <= c.week group by 1, 2, 3)"


def _snapshots(spark, d):
    p = plays.scrimmage(all_plays(spark, d)).where("week is not null").withColumnRenamed("pos_team_id", "team_id")
    tot = weekly.weekly_totals(p, ["season", "team_id"], "week", ["epa"])
    return weekly.cumulative(tot, ["season", "team_id"], "week", ["epa"], tot.select("week").distinct())


@query("with " + _PLAYS + _WEEKLY + " select season, team_id, through_week, cast(n as bigint) n, round(epa, 6) epa from cum")
def cumulative_weekly(spark, d):
    return _snapshots(spark, d).select("season", "team_id", "through_week", "n", r6("epa"))


@query("with " + _PLAYS + _WEEKLY + "," + _GAMES + "," + _LONG + " select s.game_id, s.team_id, cast(c.n as bigint) n, round(c.epa, 6) epa from sides s left join cum c on c.season = s.season and c.team_id = s.team_id and c.through_week = s.week - 1")
def asof_prev_week(spark, d):
    return weekly.as_of_previous(team_games(spark, d), _snapshots(spark, d), ["season", "team_id"], "week").select("game_id", "team_id", "n", r6("epa"))


@query("with " + _PLAYS + """, t as (select season, pos_team_id team_id, count(*) n, avg(epa) now from scrim where season is not null group by 1, 2)
select a.season, a.team_id, round(coalesce((a.n * a.now + 100 * b.now) / (a.n + 100), a.now, b.now), 6) blended from t a left join t b on b.team_id = a.team_id and b.season = a.season - 1""")  # fmt: skip
def prior_blend(spark, d):
    t = plays.scrimmage(all_plays(spark, d)).where("season is not null").groupBy("season", F.col("pos_team_id").alias("team_id")).agg(F.count(F.lit(1)).alias("n"), F.avg("epa").alias("now"))
    prior = t.select((F.col("season") + 1).alias("season"), "team_id", F.col("now").alias("prior"))
    return t.join(prior, ["season", "team_id"], "left").select("season", "team_id", rnd(weekly.prior_blend(F.col("now"), F.col("prior"), F.col("n"), 100.0), 6).alias("blended"))


@query("with " + _GAMES + "," + _LONG + """, st as (select team_id, avg(margin) strength from sides where margin is not null group by 1)
select s.team_id, count(*) games, sum(cast(margin > 0 as double)) wins, round(avg(st.strength), 6) sos, round(avg(margin), 6) margin, round(sum(cast(margin > 0 as double)) / count(*), 6) win_rate from sides s left join st on st.team_id = s.opp_id group by 1""")  # fmt: skip
def resume_sos(spark, d):
    g = team_games(spark, d)
    strength = g.where("margin is not null").groupBy("team_id").agg(F.avg("margin").alias("strength"))
    return weekly.resume(g, strength, "team_id", "opp_id").select("team_id", "games", "wins", r6("sos"), r6("margin"), r6("win_rate"))


# ---------------------------------------------------------------- metrics and models
def _labelled(spark, d):
    w = team_games(spark, d).where("margin is not null").select("game_id", F.col("team_id").alias("pos_team_id"), (F.col("margin") > 0).cast("int").alias("won"))
    return plays.scrimmage(all_plays(spark, d)).where("wp_before is not null").join(w, ["game_id", "pos_team_id"])


_LABELLED = "with " + _PLAYS + "," + _GAMES + "," + _LONG + ", lab as (select p.*, cast(s.margin > 0 as int) won from scrim p join sides s on s.game_id = p.game_id and s.team_id = p.pos_team_id where s.margin is not null and p.wp_before is not null)"


@query(_LABELLED + " select least(cast(floor(wp_before * 20) as bigint), 19) as bin, count(*) n, round(avg(wp_before), 6) predicted, round(avg(won), 6) actual from lab group by 1")
def calibration_bins(spark, d):
    return metrics.calibration(_labelled(spark, d), "wp_before", "won", 20).select(F.col("bin").cast("bigint").alias("bin"), "n", r6("predicted"), r6("actual"))


@query(_LABELLED + " , b as (select least(floor(wp_before * 20), 19) bin, count(*) n, abs(avg(wp_before) - avg(won)) d from lab group by 1) select round(sum(d * n) / sum(n), 6) mean_error, round(max(d), 6) max_error from b where n >= 20")
def calibration_error(spark, d):
    return metrics.calibration_error(metrics.calibration(_labelled(spark, d), "wp_before", "won", 20), least=20).select(r6("mean_error"), r6("max_error"))


@query(_LABELLED + " , q as (select season, least(greatest(wp_before, 1e-15), 1 - 1e-15) p, won y from lab) select season, count(*) n, round(avg(-(y * ln(p) + (1 - y) * ln(1 - p))), 6) log_loss, round(avg((p - y) * (p - y)), 6) brier from q group by 1")
def wp_metrics(spark, d):
    return metrics.binary(_labelled(spark, d), "wp_before", "won", ("season",)).select("season", "n", r6("log_loss"), r6("brier"))


@query(_LABELLED + " , r as (select won, rank() over (order by wp_before) + (count(*) over (partition by wp_before) - 1) / 2.0 r from lab), s as (select sum(won) n1, sum(1 - won) n0, sum(r) filter (won = 1) sr from r) select cast(n1 as bigint) n_pos, cast(n0 as bigint) n_neg, round((sr - n1 * (n1 + 1) / 2.0) / (n1::double * n0), 6) auc from s")
def auc_ranks(spark, d):
    return metrics.auc(_labelled(spark, d), "wp_before", "won").select("n_pos", "n_neg", r6("auc"))


@query("""with x as (select l_returnflag, l_extendedprice y, 1500.0 * l_quantity p from lineitem) select l_returnflag, count(*) n, round(avg(abs(y - p)), 4) mae, round(sqrt(avg((y - p) * (y - p))), 4) rmse, round(avg(y - p), 4) bias, round(corr(p, y), 6) corr,
round(regr_slope(y, p), 6) slope, round(regr_intercept(y, p), 2) intercept, round(stddev_pop(y - p), 4) resid_sd, round(regr_r2(y, p), 6) r2 from x group by 1""")  # fmt: skip
def margin_metrics(spark, d):
    x = table(spark, d, "lineitem").withColumn("p", 1500.0 * F.col("l_quantity"))
    m = metrics.margins(x, "p", "l_extendedprice", ("l_returnflag",))
    f = lambda c, k: F.round(c, k).alias(c)
    return m.select("l_returnflag", "n", f("mae", 4), f("rmse", 4), f("bias", 4), f("corr", 6), f("slope", 6), f("intercept", 2), f("resid_sd", 4), f("r2", 6))


@query("select round(regr_intercept(l_extendedprice, l_quantity), 2) intercept, round(regr_slope(l_extendedprice, l_quantity), 6) slope from lineitem")
def ols_price(spark, d):
    c = models.ols(table(spark, d, "lineitem"), ["l_quantity"], "l_extendedprice")
    return spark.range(1).select(rnd(F.lit(c["intercept"]), 2).alias("intercept"), rnd(F.lit(c["l_quantity"]), 6).alias("slope"))


@query("select s.l_suppkey, s.n, round((s.raw - m.m) * s.n / (s.n + 20.0), 4) effect from (select l_suppkey, count(*) n, avg(l_extendedprice) raw from lineitem group by 1) s, (select avg(l_extendedprice) m from lineitem) m")
def shrunk_group_effect(spark, d):
    return models.shrunk_effect(table(spark, d, "lineitem"), "l_suppkey", "l_extendedprice", 20.0).select("l_suppkey", "n", rnd("effect", 4).alias("effect"))


@query("with per as (select o_custkey, avg(o_totalprice) m from orders group by 1) select count(m) clusters, round(avg(m), 4) mean, round(stddev_samp(m) / sqrt(count(m)), 4) se from per")
def clustered_mean(spark, d):
    return metrics.clustered_mean(table(spark, d, "orders"), "o_custkey", "o_totalprice").select("clusters", rnd("mean", 4).alias("mean"), rnd("se", 4).alias("se"))


@query("select round(avg(abs(y - (select avg(o_totalprice) from orders))), 4) mae_mean, round(avg(abs(y - (select median(o_totalprice) from orders))), 4) mae_median from (select o_totalprice y from orders)")
def constant_baselines(spark, d):
    return metrics.baselines(table(spark, d, "orders"), "o_totalprice").select(rnd("mae_mean", 4).alias("mae_mean"), rnd("mae_median", 4).alias("mae_median"))


@query("select round(corr(adj_net, fei_net), 6) corr_adj, count(*) n from (select adj_net, fei_net from cfb_ratings_2025 where adj_net is not null and fei_net is not null and not isnan(adj_net) and not isnan(fei_net))")
def gate_report(spark, d):
    r = table(spark, d, "cfb_ratings_2025").where("adj_net is not null and fei_net is not null and not isnan(adj_net) and not isnan(fei_net)")
    rep = gates.adjustment_report(r, {"adj_net": "fei_net"})
    return spark.range(1).select(rnd(F.lit(rep["adj_net"]), 6).alias("corr_adj"), F.lit(rep["rows"]).cast("bigint").alias("n"))


# ---------------------------------------------------------------- scalars, filters, shapes
@query("select o_orderkey, o_totalprice from orders, (select avg(o_totalprice) m, stddev_pop(o_totalprice) s from orders) where abs(o_totalprice - m) < 1.5 * s")
def zscore_filter(spark, d):
    return plays.zscore_filter(table(spark, d, "orders"), "o_totalprice", 1.5).select("o_orderkey", "o_totalprice")


@query("select o_orderkey, round(coalesce((o_totalprice - min(o_totalprice) over (partition by o_orderpriority)) / nullif(max(o_totalprice) over (partition by o_orderpriority) - min(o_totalprice) over (partition by o_orderpriority), 0), 1.0), 6) scaled from orders")
def minmax_scale(spark, d):
    return reshape.scaled_within(table(spark, d, "orders"), ["o_orderpriority"], "o_totalprice", "s").select("o_orderkey", rnd("s", 6).alias("scaled"))


@query("with " + _PLAYS + """, t as (select pos_team_id, avg(success) - 0.4 sr, avg(stat_yardage) - 6 ypp from ms group by 1)
select pos_team_id, round(0.35 * (greatest(least(sr, 1.0), -1.0) + 1) / 2 * 10 + 0.30 * (greatest(least(ypp, 2.0), -2.0) + 2) / 4 * 10, 6) rating from t""")  # fmt: skip
def translate_index(spark, d):
    t = measured(spark, d).groupBy("pos_team_id").agg((F.avg("success") - 0.4).alias("sr"), (F.avg("stat_yardage") - 6).alias("ypp"))
    return t.select("pos_team_id", rnd(0.35 * X.translate("sr", -1.0, 1.0, 0.0, 10.0) + 0.30 * X.translate("ypp", -2.0, 2.0, 0.0, 10.0), 6).alias("rating"))


#: A lookup curve by rule: expected points fall linearly with the yards to the goal.
CURVE = [round(6.0 - 0.07 * i, 4) for i in range(101)]


@query("with " + _PLAYS + ", c as (select list_transform(range(101), lambda i: round(6.0 - 0.07 * i, 4)) v) select play_id, cast(round(v[1 + greatest(0, least(100, yards_to_goal - stat_yardage))] - v[1 + greatest(0, least(100, yards_to_goal))], 4) as double) gained_points from scrim, c where yards_to_goal is not null and stat_yardage is not null")
def curve_lookup(spark, d):
    s = plays.scrimmage(all_plays(spark, d)).where("yards_to_goal is not null and stat_yardage is not null")
    return s.select("play_id", rnd(X.lookup(CURVE, F.col("yards_to_goal") - F.col("stat_yardage")) - X.lookup(CURVE, "yards_to_goal"), 4).alias("gained_points"))


@query("with " + _PLAYS + " select play_id, game_id, period from plays where game_id not in (select game_id from plays where game_id is not null and (period > 4 or period < 1))")
def whole_game_exclusion(spark, d):
    return plays.whole_group_filter(all_plays(spark, d).where("game_id is not null"), "game_id", ~F.col("period").between(1, 4)).select("play_id", "game_id", "period")


SQL["whole_game_exclusion"] = "with " + _PLAYS + " select play_id, game_id, period from plays p where game_id is not null and not exists (select 1 from plays q where q.game_id = p.game_id and (q.period > 4 or q.period < 1))"


@query("select o_orderkey, l_linenumber, l_partkey from lineitem join orders on l_orderkey = o_orderkey where o_orderkey in (select l_orderkey from lineitem where l_returnflag = 'R') and o_orderkey not in (select l_orderkey from lineitem where l_linestatus = 'O')")
def semi_group_filter(spark, d):
    li, o = table(spark, d, "lineitem"), table(spark, d, "orders")
    j = li.join(o, li.l_orderkey == o.o_orderkey)
    j = j.join(li.where("l_returnflag = 'R'").select(F.col("l_orderkey").alias("o_orderkey")).distinct(), "o_orderkey", "left_semi")
    return j.join(li.where("l_linestatus = 'O'").select(F.col("l_orderkey").alias("o_orderkey")).distinct(), "o_orderkey", "left_anti").select("o_orderkey", "l_linenumber", "l_partkey")


@query("select game_id, season, home_id team_id, cast(null as varchar) school from schedules union all select null, null, team_id, school from teams")
def diagonal_union(spark, d):
    s = table(spark, d, "schedules").select("game_id", "season", F.col("home_id").alias("team_id"))
    return reshape.diagonal_union([s, table(spark, d, "teams").select("team_id", "school")])


@query("select event_id, cast(json_extract(props, '$.k') as bigint) k from events")
def json_flatten(spark, d):
    return table(spark, d, "events").select("event_id", F.expr("try_variant_get(try_parse_json(props), '$.k', 'bigint')").alias("k"))


@query("select event_id, 'k' as \"key\", cast(json_extract(props, '$.k') as bigint) as \"value\" from events where json_extract(props, '$.k') is not null")
def dynamic_keys(spark, d):
    e = table(spark, d, "events").select("event_id", F.explode(F.expr("map_entries(try_variant_get(try_parse_json(props), '$', 'map<string,variant>'))")).alias("e"))
    return e.select("event_id", F.col("e.key").alias("key"), F.expr("try_variant_get(e.value, '$', 'bigint')").alias("value"))


@query("select rating_id, measure, \"value\" from (unpivot (select rating_id, adj_off_epa, adj_def_epa, adj_st_epa from cfb_ratings_2025) on adj_off_epa, adj_def_epa, adj_st_epa into name measure value \"value\") union all select rating_id, m, null from cfb_ratings_2025, (select unnest(['adj_off_epa','adj_def_epa','adj_st_epa']) m) where case m when 'adj_off_epa' then adj_off_epa when 'adj_def_epa' then adj_def_epa else adj_st_epa end is null")
def wide_to_long(spark, d):
    return reshape.to_long(table(spark, d, "cfb_ratings_2025"), ["rating_id"], ["adj_off_epa", "adj_def_epa", "adj_st_epa"])


@query("select user_id, " + ", ".join(f"min(value) filter (event_type = '{t}') {t}" for t in ("click", "error", "purchase", "signup", "view")) + " from events group by 1")
def long_to_wide(spark, d):
    return reshape.to_wide(table(spark, d, "events"), ["user_id"], "event_type", F.col("value"), ["click", "error", "purchase", "signup", "view"])


_CLASSES = 5


@query(f"""with c as (select unnest(range({_CLASSES})) i), w as (select play_id, i, 1.0 / (1 + abs(i * 5 - greatest(0, least(20, stat_yardage)))) p from plays, c), n as (select play_id, i, p / sum(p) over (partition by play_id) q from w)
select play_id, round(sum(q * i * 5), 6) expected, round(sum(q * i * 5) filter (i * 5 >= 10) / sum(q) filter (i * 5 >= 10), 6) if_flag, round(sum(q * i * 5) filter (i * 5 < 10) / sum(q) filter (i * 5 < 10), 6) if_not from n group by 1""".replace("from plays, c", "from scrim, c where stat_yardage is not null").replace("with c as", "with " + _PLAYS + ", c as"))  # fmt: skip
def outcome_expectation(spark, d):
    s = plays.scrimmage(all_plays(spark, d)).where("stat_yardage is not null")
    y = X.clip_null("stat_yardage", 0, 20)
    ps = F.array(*[1.0 / (1 + F.abs(F.lit(i * 5) - y)) for i in range(_CLASSES)])
    p = s.select("play_id", ps.alias("w")).withColumn("t", F.aggregate("w", F.lit(0.0), lambda a, x: a + x))
    p = p.select("play_id", F.transform("w", lambda x: x / F.col("t")).alias("p"), F.array(*[F.lit(float(i * 5)) for i in range(_CLASSES)]).alias("v"), F.array(*[F.lit(i * 5 >= 10) for i in range(_CLASSES)]).alias("f"))
    return models.expected_outcome(p, "p", "v", "f", ["play_id"]).select("play_id", r6("expected"), r6("if_flag"), r6("if_not"))


@query("select o_orderkey, cast(year(o_orderdate) as bigint) yr, case when year(o_orderdate) < 1996 then 0 when year(o_orderdate) < 1998 then 1 when year(o_orderdate) < 2000 then 2 else 3 end era from orders")
def era_buckets(spark, d):
    y = F.year("o_orderdate")
    return table(spark, d, "orders").select("o_orderkey", y.cast("bigint").alias("yr"), F.when(y < 1996, 0).when(y < 1998, 1).when(y < 2000, 2).otherwise(3).alias("era"))


@query("with " + _PLAYS + " select play_id, down is null d0, coalesce(regexp_matches(play_text, '(?i)kneel|takes a knee'), false) kneel from plays")
def kneel_flags(spark, d):
    return all_plays(spark, d).select("play_id", F.col("down").isNull().alias("d0"), plays.is_kneel(F.col("play_text")).alias("kneel"))


@query("select o_orderstatus, o_orderpriority, count(*) n, round(sum(o_totalprice), 2) total from orders group by rollup (o_orderstatus, o_orderpriority)")
def rollup_totals(spark, d):
    return table(spark, d, "orders").rollup("o_orderstatus", "o_orderpriority").agg(F.count(F.lit(1)).alias("n"), rnd(F.sum("o_totalprice"), 2).alias("total"))


@query("with " + _GAMES + "," + _LONG + " (select game_id, team_id, margin from sides where margin is not null order by margin, game_id, team_id limit 10) union all (select game_id, team_id, margin from sides where margin is not null order by margin desc, game_id, team_id limit 10)")
def extreme_games(spark, d):
    g = team_games(spark, d).where("margin is not null").select("game_id", "team_id", "margin")
    return g.orderBy("margin", "game_id", "team_id").limit(10).unionByName(g.orderBy(F.desc("margin"), "game_id", "team_id").limit(10))


@query("with " + _GAMES + ", have as (select distinct season, week from summaries_input), want as (select distinct season, week from games) select * from want except select * from have")
def missing_weeks(spark, d):
    return gates.missing_weeks(table(spark, d, "summaries_input"), latest_games(spark, d), ["season", "week"])


@query("select distinct home_id team_id from schedules where home_id is not null intersect select distinct team_id from teams")
def known_hosts(spark, d):
    return table(spark, d, "schedules").where("home_id is not null").select(F.col("home_id").alias("team_id")).intersect(table(spark, d, "teams").select("team_id"))


@query("with " + _PLAYS + ", c as (select cast(start_down as int) x, cast(start_distance as int) y, count(*) n from scrim where start_down is not null and start_distance is not null group by 1, 2) select x, y, n, round(n / sum(n) over (partition by x), 6) share from c")
def cell_shares(spark, d):
    c = plays.scrimmage(all_plays(spark, d)).where("start_down is not null and start_distance is not null").groupBy(F.col("start_down").alias("x"), F.col("start_distance").alias("y")).agg(F.count(F.lit(1)).alias("n"))
    return c.select("x", "y", "n", rnd(F.col("n") / F.sum("n").over(Window.partitionBy("x")), 6).alias("share"))


# ---------------------------------------------------------------- box scores, logs, labels
#: Expected points by yard line, by the same rule as CURVE.
YARD_LINE_CURVE = [round(-1.0 + 0.07 * i, 4) for i in range(101)]
_EP = "(-1 + 0.07 * greatest(0, least(100, {0})))"
_OK = "coalesce(case start_down when 1 then stat_yardage >= 0.5 * start_distance when 2 then stat_yardage >= 0.7 * start_distance else case when start_down >= 4 then stat_yardage >= start_distance end end, false)"
_BOX = f""", pl as (select *, coalesce(pass, false) or coalesce(rush, false) sc, {_OK} ok, 100 - yards_to_goal yl, {_EP.format('100 - yards_to_goal + stat_yardage')} - {_EP.format('100 - yards_to_goal')} eq0, stat_yardage is not null and yards_to_goal is not null known,
  coalesce(try_cast(regexp_extract(play_text, '(?i) (?:kickoff|punt) for ([0-9]+) y', 1) as int), 0) ky from plays where game_id is not null and pos_team_id is not null),
dr0 as (select game_id, pos_team_id team_id, drive_id, arg_min(yl, (coalesce(game_play_number, -1), play_id)) filter (yl is not null) st, coalesce(sum(stat_yardage) filter (sc), 0) gained,
  max(case when contains(lower(play_type), 'touchdown') then 7 when contains(lower(play_type), 'field goal good') then 3 else 0 end) pts from pl where drive_id is not null group by 1, 2, 3),
dr as (select game_id, team_id, count(*) drives, count(*) filter (st + gained >= 60) chances, coalesce(avg(pts) filter (st + gained >= 60), 0) ppc, count(*) filter (st + gained >= 60 and pts > 0) scored from dr0 group by 1, 2),
bx as (select game_id, pos_team_id team_id, count(*) filter (sc) plays, avg(cast(ok as double)) filter (sc) success_rate, avg(case when sc then cast(coalesce(stat_yardage >= 15, false) as double) end) explosive_rate, avg(epa) filter (sc) epa_play,
  avg(eq0) filter (sc and known) eq_ppp, coalesce(avg(eq0) filter (sc and ok and known), 0) iso_ppp, coalesce(avg({_EP.format('yl + ky')} - {_EP.format('yl')}) filter (lower(play_type) = 'kickoff' and yl is not null), 0) kick_ppp,
  case when count(*) filter (lower(play_type) = 'kickoff') > 0 then -1.0 else 0.0 end kick_return_ppp, coalesce(avg({_EP.format('yl + ky')} - {_EP.format('yl')}) filter (lower(play_type) = 'punt' and yl is not null), 0) punt_ppp,
  count(*) filter (regexp_matches(lower(play_type), 'interception')) picks, count(*) filter (regexp_matches(lower(play_type), 'fumble recovery [(]opponent[)]')) fumbles,
  count(*) filter (regexp_matches(lower(play_type), 'sack')) sacks, count(*) filter (regexp_matches(lower(play_type), 'incompletion') and regexp_matches(play_text, '(?i)broken up')) broken_up, count(*) n from pl group by 1, 2),
box as (select bx.*, coalesce(drives, 0) drives, coalesce(chances, 0) chances, coalesce(ppc, 0) ppc, coalesce(chances / drives::double, 0) cr, coalesce(scored / drives::double, 0) cs from bx left join dr using (game_id, team_id))"""


@query("with " + _PLAYS + _BOX + " select game_id, team_id, plays, drives, round(success_rate, 6) success_rate, round(explosive_rate, 6) explosive_rate, round(epa_play, 6) epa_play, round(eq_ppp, 6) eq_ppp, round(iso_ppp, 6) iso_ppp, round(punt_ppp, 6) punt_ppp, round(ppc, 6) points_per_chance, chances, picks + fumbles turnovers, round(0.22 * (broken_up + picks) + 0.49 * fumbles, 6) expected_turnovers, round((picks + fumbles + sacks) / n::double, 6) havoc_rate from box")
def game_boxes(spark, d):
    b = boxscore.game_boxes(all_plays(spark, d), YARD_LINE_CURVE)
    return b.select("game_id", "team_id", "plays", "drives", *[r6(c) for c in ("success_rate", "explosive_rate", "epa_play", "eq_ppp", "iso_ppp", "punt_ppp", "points_per_chance")], "chances", "turnovers", r6("expected_turnovers"), r6("havoc_rate"))


def _diff(c: str, name: str) -> str:
    return f"case when two then {c} * 2 - sum({c}) over w end {name}"


def _range(x: str, lo: float, hi: float, out: float) -> str:
    return f"(greatest(least({x}, {hi}), {lo}) - {lo}) / {hi - lo} * {out}"


@query("with " + _PLAYS + _BOX + ", o as (select *, picks + fumbles t, 0.22 * (broken_up + picks) + 0.49 * fumbles et, sacks / n::double sr, (picks + fumbles + sacks) / n::double hr, count(*) over (partition by game_id) = 2 two from box), df as (select *, "
    + ", ".join(_diff(c, n) for c, n in (("success_rate", "a"), ("eq_ppp", "b"), ("ppc", "p"), ("cr", "c"), ("cs", "e"), ("sr", "s"), ("hr", "h"), ("t", "dt"))) + " from o window w as (partition by game_id)) select game_id, team_id, case when a is null or b is null or p is null then null else round(0.35 * "
    + _range("a", -1, 1, 10) + " + 0.30 * " + _range("b", -2, 2, 10) + " + 0.15 * (" + _range("p", -7, 7, 3.5) + " + " + _range("c", -1, 1, 4) + " + " + _range("e", -1, 1, 2.5) + ") + 0.10 * "
    + _range("0.37 * a - 0.21 * dt / greatest(1, plays) + 0.22 * (kick_ppp - kick_return_ppp)", -10, 10, 10) + " + 0.10 * (" + _range("et - t", -5, 5, 3) + " + " + _range("s", -1, 1, 3) + " + " + _range("h", -1, 1, 4) + "), 6) end rating from df")
def five_factors(spark, d):
    return boxscore.five_factors(boxscore.game_boxes(all_plays(spark, d), YARD_LINE_CURVE)).select("game_id", "team_id", r6("rating"))


@query("with " + _GAMES + " select game_id, home_id team_id, away_id opponent_id, true is_home, home_score - away_score margin, case when home_score > away_score then true when home_score < away_score then false end win from games where home_id is not null union all select game_id, away_id, home_id, false, away_score - home_score, case when away_score > home_score then true when away_score < home_score then false end from games where away_id is not null")
def game_log(spark, d):
    return records.game_log(latest_games(spark, d)).select("game_id", "team_id", "opponent_id", "is_home", "margin", "win")


@query("select season, week, cast(max(kickoff) as date) cutoff from schedules where season_type = 2 and week is not null and kickoff is not null group by 1, 2")
def week_cutoffs(spark, d):
    return records.week_cutoffs(table(spark, d, "schedules"))


_STRENGTH = "lg as (select game_id, season, neutral_site, home_id team_id, away_id opp, true hm, home_score - away_score margin from games where home_id is not null union all select game_id, season, neutral_site, away_id, home_id, false, away_score - home_score from games where away_id is not null), st as (select season, team_id, avg(margin) strength from lg where margin is not null group by 1, 2)"


@query("with " + _GAMES + "," + _STRENGTH + """, j as (select l.*, b.strength theirs, 1 / (1 + exp(-((coalesce(a.strength, 0) - coalesce(b.strength, 0) + case when coalesce(neutral_site, false) then 0.0 when hm then 2.5 else -2.5 end) / (16.0 * 0.5513)))) ew from lg l left join st a on a.season = l.season and a.team_id = l.team_id
left join st b on b.season = l.season and b.team_id = l.opp where margin is not null), g as (select season, team_id, count(*) games, sum(cast(margin > 0 as double)) wins, sum(ew) exp_wins, avg(theirs) sos from j group by 1, 2)
select season, team_id, games, wins, round(exp_wins, 6) exp_wins, round(wins - exp_wins, 6) luck_wins, round(sos, 6) sos_points, round((ln(greatest(least(wins / games, 0.99), 0.01)) - ln(1 - greatest(least(wins / games, 0.99), 0.01))) * 16.0 * 0.5513 + sos, 6) sor_points from g""")  # fmt: skip
def season_resume(spark, d):
    log = records.game_log(latest_games(spark, d))
    strength = log.where("margin is not null").groupBy("season", "team_id").agg(F.avg("margin").alias("strength"))
    return records.season_resume(log, strength, 16.0, 2.5).select("season", "team_id", "games", "wins", r6("exp_wins"), r6("luck_wins"), r6("sos_points"), r6("sor_points"))


@query("with " + _PLAYS + _RUSHERS + """, g as (select player, season, count(*) n_plays, count(*) filter (opportunity_run) n_opps, round(avg(epa), 9) u, round(avg(greatest(epa, -4.5)), 9) epa, avg(success) success, sum(highlight_yards) h from who where player is not null group by 1, 2 having count(*) > 3)
select player, season, n_plays, n_opps, round(u, 6) unadjusted_epa, round(epa, 6) epa, round(success, 6) success, round(coalesce(h / nullif(n_opps, 0), 0.0), 6) highlight_yards, round(lag(epa) over w, 6) l_epa, lag(n_plays) over w l_n_plays, round(sqrt(n_plays * n_plays + (lag(n_plays) over w) * (lag(n_plays) over w)), 6) weight from g window w as (partition by player order by season)""")  # fmt: skip
def rusher_seasons(spark, d):
    s = records.rusher_seasons(_rushers(spark, d), "player", 3).withColumn("epa", F.round("epa", 9)).withColumn("unadjusted_epa", F.round("unadjusted_epa", 9))
    out = records.with_season_lag(s, "player", ["epa", "n_plays"])
    return out.select("player", "season", "n_plays", "n_opps", r6("unadjusted_epa"), r6("epa"), r6("success"), r6("highlight_yards"), r6("l_epa"), "l_n_plays", r6("weight"))


@query("""select row_id, coalesce(loaded_at > min(loaded_at) over (partition by team_id, season order by through_week, row_id rows between 1 following and unbounded following), false) out_of_sequence,
coalesce((year(loaded_at) = season and month(loaded_at) >= 8) or (year(loaded_at) = season + 1 and month(loaded_at) <= 2), false) contemporaneous from cfb_higher_models""")  # fmt: skip
def snapshot_flags(spark, d):
    return records.snapshot_flags(table(spark, d, "cfb_higher_models"), ["team_id", "season"], ["through_week", "row_id"], "loaded_at", "season").select("row_id", "out_of_sequence", "contemporaneous")


@query("with " + _PLAYS + """, h as (select *, case when period in (1, 2) then 1 else 2 end half, case when regexp_matches(play_type, 'Touchdown|Field Goal Good|Safety') then struct_pack(k := play_type, by := case when regexp_matches(play_type, 'Return|Safety') then def_pos_team_id else pos_team_id end) end s from plays),
n as (select play_id, pos_team_id, first_value(s ignore nulls) over (partition by game_id, half order by game_play_number nulls first, play_id rows between current row and unbounded following) x from h),
l as (select play_id, case when contains(x.k, 'Touchdown') then case when coalesce(pos_team_id = x.by, false) then 'Touchdown' else 'Opp_Touchdown' end when contains(x.k, 'Field Goal Good') then case when coalesce(pos_team_id = x.by, false) then 'Field_Goal' else 'Opp_Field_Goal' end
  when contains(x.k, 'Safety') then case when coalesce(pos_team_id = x.by, false) then 'Safety' else 'Opp_Safety' end else 'No_Score' end next_score from n)
select play_id, next_score, cast(list_position(['Touchdown', 'Opp_Touchdown', 'Field_Goal', 'Opp_Field_Goal', 'Safety', 'Opp_Safety', 'No_Score'], next_score) - 1 as int) "label" from l""")  # fmt: skip
def next_score_classes(spark, d):
    t = F.col("play_type")
    scorer = F.when(t.rlike("Return|Safety"), F.col("def_pos_team_id")).otherwise(F.col("pos_team_id"))
    p = labels.next_score_labels(all_plays(spark, d), ["game_play_number", "play_id"], "pos_team_id", "play_type", F.coalesce(t.rlike("Touchdown|Field Goal Good|Safety"), F.lit(False)), scorer)
    return p.select("play_id", "next_score", "label")


# ---------------------------------------------------------------- decisions, drives, filters, joins, tests
@query("with " + _PLAYS + """, f as (select play_id, yards_to_goal y, start_distance d, wp_before from plays where start_down = 4 and yards_to_goal is not null and start_distance is not null and start_distance <= yards_to_goal and wp_before > 0 and wp_before < 1),
w as (select f.*, i, 1.0 / (1 + abs(i - 10 - 4)) p, ln(wp_before / (1 - wp_before)) l, greatest(least(i - 10, y), y - 99) g from f, (select unnest(range(76)) i)), n as (select *, p / sum(p) over (partition by play_id) q, g >= d kept, g >= d and g = y scored from w),
a as (select *, not kept or scored lost, case when scored then 75 when not kept then 100 - (y - g) else y - g end s from n),
v as (select *, case when lost then -l - case when scored then 0.9 else 0.0 end else l end + 0.15 * (3 - 0.06 * s) lw from a), z as (select *, case when lost then 1 - 1 / (1 + exp(-lw)) else 1 / (1 + exp(-lw)) end wp from v)
select play_id, round(sum(q * wp), 6) go_wp, round(coalesce(sum(q) filter (kept), 0), 6) first_down_prob, round(sum(q * wp) filter (kept) / sum(q) filter (kept), 6) wp_succeed, round(sum(q * wp) filter (not kept) / sum(q) filter (not kept), 6) wp_fail from z group by 1""")  # fmt: skip
def fourth_down_go(spark, d):
    """Fourth downs under stand-in models (the tables carry no scores or clock): the margin is the log-odds before the play over 0.15 points."""
    p = all_plays(spark, d).where("start_down = 4 and yards_to_goal is not null and start_distance is not null and start_distance <= yards_to_goal and wp_before > 0 and wp_before < 1")
    weights = F.transform(F.sequence(F.lit(0), F.lit(fourth_down.GAINS - 1)), lambda i: F.lit(1.0) / (1 + F.abs(i - 14)))
    p = p.select("play_id", "yards_to_goal", F.col("start_distance").alias("distance"), (X.logit("wp_before") / 0.15).alias("margin"), F.lit(1800).alias("seconds"), F.lit(3).alias("own_timeouts"), F.lit(3).alias("other_timeouts"), weights.alias("w"))
    p = p.withColumn("t", F.aggregate("w", F.lit(0.0), lambda a, x: a + x)).withColumn("probs", F.transform("w", lambda x: x / F.col("t")))
    got = fourth_down.decide(p, "probs", ["play_id"], lambda s: X.logistic(0.15 * (s["margin"] + 3 - 0.06 * s["yards_to_goal"])))
    return got.select("play_id", *[r6(c) for c in ("go_wp", "first_down_prob", "wp_succeed", "wp_fail")])


@query("with " + _PLAYS + """ select game_id, drive_id, count(*) n_plays, arg_min(pos_team_id, (coalesce(game_play_number, -1), play_id)) filter (pos_team_id is not null) team_id, min(period) first_period, max(period) last_period,
  arg_min(yards_to_goal, (coalesce(game_play_number, -1), play_id)) filter (yards_to_goal is not null) start_yards_to_goal, cast(coalesce(sum(stat_yardage), 0) as bigint) yards, arg_max(play_type, (coalesce(game_play_number, -1), play_id)) filter (play_type is not null) as "result" from plays where game_id is not null and drive_id is not null group by 1, 2""")  # fmt: skip
def drives_table(spark, d):
    return plays.drives(all_plays(spark, d)).withColumn("yards", F.col("yards").cast("bigint"))


@query("with " + _PLAYS + " select play_id, start_down, start_distance, epa, wp_before from plays where start_down between 1 and 4 and play_type not in ('Timeout', 'Penalty', 'Kickoff') and epa is not null and (wp_before between 0.1 and 0.9)")
def model_rows(spark, d):
    p = plays.competitive(plays.model_rows(all_plays(spark, d), ["Timeout", "Penalty", "Kickoff"], ["epa"]))
    return p.select("play_id", "start_down", "start_distance", "epa", "wp_before")


@query("with " + _PLAYS + "," + _SIDE + """, names as (select team_id, school, conference from teams where team_id is not null and school is not null qualify row_number() over (partition by team_id order by added_at desc nulls last, team_row_id desc) = 1)
select a.season, a.team_id, n.school, n.conference, a.plays, round(a.epa_play, 6) epa_play from agg a left join names n using (team_id) where a.phase = 'all' and a.side = 'off'""")  # fmt: skip
def named_summaries(spark, d):
    """Season summaries with each team's name as registered last."""
    t = table(spark, d, "teams").where("team_id is not null and school is not null")
    names = t.groupBy("team_id").agg(F.max_by(F.struct("school", "conference"), F.struct("added_at", "team_row_id")).alias("n")).select("team_id", "n.*")
    s = summaries.side_summaries(measured(spark, d)).where("phase = 'all' and side = 'off'")
    return s.join(names, "team_id", "left").select("season", "team_id", "school", "conference", "plays", r6("epa_play"))


@query("with " + _PLAYS + _WEEKLY + """, rt as (select season, team_id, avg(adj_net) adj_net, count(*) draws from cfb_ratings_2025 where adj_net is not null and not isnan(adj_net) and season is not null and team_id is not null group by 1, 2)
select c.season, c.team_id, c.through_week, cast(c.n as bigint) n, round(c.epa, 6) epa, round(r.adj_net, 6) adj_net, coalesce(r.draws, 0) draws from cum c left join rt r on r.season = c.season and r.team_id = c.team_id""")  # fmt: skip
def weekly_ratings(spark, d):
    """Weekly snapshots with the mean of the season's rating draws."""
    r = table(spark, d, "cfb_ratings_2025").where("adj_net is not null and not isnan(adj_net) and season is not null and team_id is not null")
    r = r.groupBy("season", "team_id").agg(F.avg("adj_net").alias("adj_net"), F.count(F.lit(1)).alias("draws"))
    return _snapshots(spark, d).join(r, ["season", "team_id"], "left").select("season", "team_id", "through_week", "n", r6("epa"), r6("adj_net"), F.coalesce("draws", F.lit(0)).alias("draws"))


@query("with b as (select cast(round(adj_net * 20) as bigint) as bin, count(*) n, avg(adj_net) p, avg(fei_net) a from cfb_ratings_2025 where adj_net is not null and fei_net is not null and not isnan(adj_net) and not isnan(fei_net) and not isinf(adj_net) and not isinf(fei_net) group by 1) select round(sum(n * abs(p - a)) / sum(n), 6) mae, count(*) bins, cast(sum(n) as bigint) n from b")
def rounded_calibration(spark, d):
    r = table(spark, d, "cfb_ratings_2025").where(X.finite("adj_net").isNotNull() & X.finite("fei_net").isNotNull())
    return metrics.rounded_calibration_mae(r, "adj_net", "fei_net", 20.0).select(r6("mae"), "bins", "n")


@query("""with s as (select l_returnflag g, avg(l_extendedprice) m, var_samp(l_extendedprice) v, count(*) n from lineitem where l_returnflag in ('A', 'R') group by 1), p as (select max(case g when 'A' then m end) ma, max(case g when 'R' then m end) mb, max(case g when 'A' then v / n end) va, max(case g when 'R' then v / n end) vb, max(case g when 'A' then n end) na, max(case g when 'R' then n end) nb from s)
select round((ma - mb) / sqrt(va + vb), 6) t, round((va + vb) * (va + vb) / (va * va / (na - 1) + vb * vb / (nb - 1)), 2) df from p""")  # fmt: skip
def welch_test(spark, d):
    return metrics.welch(table(spark, d, "lineitem"), "l_returnflag", "A", "R", "l_extendedprice").select(r6("t"), rnd("df", 2).alias("df"))


@query("""with x as (select l_extendedprice - 1500.0 * l_quantity r from lineitem), m as (select avg(r) mu from x), c as (select avg((r - mu) ** 2) m2, avg((r - mu) ** 3) m3, avg((r - mu) ** 4) m4, count(*) n from x, m)
select n, round(sqrt(m2), 4) sd, round(m3 / m2 ** 1.5, 6) skewness, round(m4 / (m2 * m2) - 3, 6) excess_kurtosis from c""")  # fmt: skip
def residual_shape(spark, d):
    x = table(spark, d, "lineitem").select((F.col("l_extendedprice") - 1500.0 * F.col("l_quantity")).alias("r"))
    return metrics.shape(x, "r").select("n", rnd("sd", 4).alias("sd"), r6("skewness"), r6("excess_kurtosis"))


@query("""with o as (select o_orderstatus a, o_orderpriority b, count(*) n from orders group by 1, 2), t as (select *, sum(n) over (partition by a) ra, sum(n) over (partition by b) rb, sum(n) over () al from o)
select round(sum(n * n / (ra * rb / al::double)) - max(al), 6) chi2, (count(distinct a) - 1) * (count(distinct b) - 1) df from t""")  # fmt: skip
def chi_square(spark, d):
    return metrics.chi_square(table(spark, d, "orders"), "o_orderstatus", "o_orderpriority").select(r6("chi2"), "df")


_SIDES = "x as (select season, side, team_id, max(case phase when 'pass' then epa_play end) pe, max(case phase when 'rush' then epa_play end) re, max(case phase when 'all' then passrate end) pr, max(case phase when 'all' then plays / n_games::double end) pace from agg group by 1, 2, 3)"


@query("with " + _PLAYS + "," + _SIDE + "," + _GAMES + "," + _SIDES + """, j as (select g.game_id, coalesce(ho.pe, 0) + coalesce(ad.pe, 0) peh, coalesce(ao.pe, 0) + coalesce(hd.pe, 0) pea, coalesce(ho.re, 0) + coalesce(ad.re, 0) reh, coalesce(ao.re, 0) + coalesce(hd.re, 0) rea,
  0.5 * coalesce(ho.pr, 0.5) + 0.5 * coalesce(ad.pr, 0.5) rate, 0.5 * coalesce(ho.pace, 70) + 0.5 * coalesce(ao.pace, 70) pace from games g left join x ho on ho.season = g.season and ho.team_id = g.home_id and ho.side = 'off' left join x hd on hd.season = g.season and hd.team_id = g.home_id and hd.side = 'def'
  left join x ao on ao.season = g.season and ao.team_id = g.away_id and ao.side = 'off' left join x ad on ad.season = g.season and ad.team_id = g.away_id and ad.side = 'def')
select game_id, round(peh - pea, 6) pass_edge_net, round(reh - rea, 6) rush_edge_net, round(rate, 6) pass_rate_home, round(pace, 6) pace_expected, round((rate * (peh - pea) + (1 - rate) * (reh - rea)) * pace, 6) epa_net, round((peh + pea + reh + rea) * pace, 6) epa_total from j""")  # fmt: skip
def matchup_features(spark, d):
    s = summaries.side_summaries(measured(spark, d))
    of = lambda phase, c: F.max(F.when(F.col("phase") == phase, F.col(c)))
    sides = s.groupBy("season", "team_id", "side").agg(of("pass", "epa_play").alias("pass_epa"), of("rush", "epa_play").alias("rush_epa"), of("all", "passrate").alias("pass_rate"), of("all", "plays_game").alias("pace"))
    m = weekly.matchup_features(latest_games(spark, d).select("game_id", "season", "home_id", "away_id"), sides)
    return m.select("game_id", *[r6(c) for c in ("pass_edge_net", "rush_edge_net", "pass_rate_home", "pace_expected", "epa_net", "epa_total")])


@query("select o_orderkey, " + ", ".join(f"cast({c} as int) era{i}" for i, c in enumerate(("y <= 1996", "y > 1996 and y <= 1998", "y > 1998 and y <= 2000", "y > 2000"))) + " from (select o_orderkey, year(o_orderdate) y from orders)")
def era_dummies(spark, d):
    return table(spark, d, "orders").withColumn("y", F.year("o_orderdate")).select("o_orderkey", *X.era_dummies("y", (1996, 1998, 2000)))


@query("with " + _GAMES + "," + _LONG + """ select s.game_id, s.team_id, (g.home_score + g.away_score + case when s.team_id = g.home_id then g.home_score - g.away_score else g.away_score - g.home_score end) / 2.0 team_total from sides s join games g using (game_id)""")
def team_totals(spark, d):
    """Each side's total, with the game's own margin and total in place of the lines."""
    g = latest_games(spark, d).select("game_id", "home_id", (F.col("home_score") - F.col("away_score")).alias("spread"), (F.col("home_score") + F.col("away_score")).alias("total"))
    return team_games(spark, d).select("game_id", "team_id").join(g, "game_id").select("game_id", "team_id", odds.team_total(F.col("spread"), F.col("total"), F.col("team_id") == F.col("home_id")).alias("team_total"))


@query("select l_returnflag, count(*) n, round(exp(avg(ln(abs(r))) + (0.5772156649015329 + 0.6931471805599453) / 2), 4) sigma from (select l_returnflag, l_extendedprice - 1500.0 * l_quantity r from lineitem) where r <> 0 group by 1")
def residual_sigma(spark, d):
    x = table(spark, d, "lineitem").select("l_returnflag", (F.col("l_extendedprice") - 1500.0 * F.col("l_quantity")).alias("r"))
    return metrics.sigma_from_logs(x, "r", ("l_returnflag",)).select("l_returnflag", "n", rnd("sigma", 4).alias("sigma"))


# ---------------------------------------------------------------- without SQL: iterative or numeric
@query()
def opponent_adjusted(spark, d):
    return models.opponent_adjusted_seasons(plays.scrimmage(all_plays(spark, d)), latest_games(spark, d))


@query()
def strength_forecasts(spark, d):
    return models.strength_forecasts(game_margins(spark, d).withColumn("league", F.lit("all")), "league")


@query()
def filter_grid(spark, d):
    return models.grid_search(game_margins(spark, d), [{"season_share": h, "week_var": v} for h in (0.72, 0.9) for v in (0.35, 1.5)])


@query()
def bootstrap_margin(spark, d):
    return models.bootstrap(game_margins(spark, d), "week", "margin", 500)


@query()
def season_simulation(spark, d):
    g = models.strength_forecasts(game_margins(spark, d).where("season is not null").withColumn("league", F.lit("all")), "league")
    return models.simulate_season(g.select("season", "game_id", "home_id", "away_id", "expected", F.sqrt("variance").alias("sd")), 200)


@query()
def kde_density(spark, d):
    s = plays.scrimmage(all_plays(spark, d)).where("start_down is not null and start_distance is not null").withColumn("one", F.lit(1))
    return models.kde_cells(s.select(F.col("start_down").alias("x"), F.col("start_distance").alias("y"), "one"), "x", "y", "one")


@query()
def normal_scores(spark, d):
    g = models.strength_forecasts(game_margins(spark, d).withColumn("league", F.lit("all")), "league").where("margin is not null")
    return metrics.distribution_scores(g.select(F.col("expected").alias("mu"), F.sqrt("variance").alias("sigma"), "margin"), "mu", "sigma", "margin")


@query()
def spline_smooth(spark, d):
    s = plays.scrimmage(all_plays(spark, d)).where("stat_yardage is not null and yards_to_goal is not null")
    out, _ = models.spline_fit(s.select("play_id", "epa", F.col("stat_yardage").cast("double").alias("gain"), F.col("yards_to_goal").cast("double").alias("ytg")), ["gain", "ytg"], "epa")
    return out.select("play_id", "smooth")


@query()
def walk_forward_ridge(spark, d):
    g = game_margins(spark, d).where("margin is not null").withColumns({"w": F.col("week").cast("double"), "n": F.coalesce("neutral_site", F.lit(False)).cast("double")})
    return models.folds(g.select("game_id", "season", "w", "n", F.col("margin").cast("double").alias("margin")), "season", models.ridge_head, ["w", "n"], "margin").select("game_id", "season", "margin", "pred")

SQL = {k: _nudged(v) for k, v in SQL.items()}
