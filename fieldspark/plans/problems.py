"""Queries of the general pipeline problems, each over its whole tables, with SQL where SQL can say it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldspark.functions.exprs import whole_number
from fieldspark.operators import drift, known_at, nested, profile, references, wide_table
from fieldspark.plans import problem_sql
from fieldspark.session import table

DOWN_RANGES = {"down": (1, 4), "distance": (1, 99)}
#: The columns of summaries_input as SQL reads them: whole numbers, decimals, times, texts that are numbers, other texts.
_WHOLE = "play_id load_no game_id season week drive_id game_play_number period pos_team_id def_pos_team_id start_down start_distance yards_to_goal stat_yardage rush pass".split()
_DECIMAL, _NUMBER_TEXT, _TEXT = ["epa", "wp_before"], ["down", "distance"], ["play_type", "play_text"]


# ---------------------------------------------------------------- 1
def p1_found(spark: SparkSession, d: str) -> DataFrame:
    return wide_table.long_cells(table(spark, d, "reshapers_statistics"))


def p1_wide(spark: SparkSession, d: str) -> DataFrame:
    return wide_table.wide_table(table(spark, d, "reshapers_statistics"))


# ---------------------------------------------------------------- 3
def team_references(spark: SparkSession, d: str) -> DataFrame:
    """src, row_id, period, key, at of every row that refers to a team."""
    models = table(spark, d, "cfb_higher_models").select(
        F.lit("cfb_higher_models").alias("src"), F.col("row_id"), F.concat_ws("-", "season", "through_week").alias("period"), F.col("team_id").alias("t"), F.col("published_at").alias("at")
    )
    ratings = table(spark, d, "cfb_ratings_2025").select(
        F.lit("cfb_ratings_2025").alias("src"), F.col("rating_id").alias("row_id"), F.date_format("rated_at", "yyyy-MM").alias("period"), F.col("team_id").cast("string").alias("t"), F.col("rated_at").alias("at")
    )
    both = models.unionByName(ratings).where(F.col("t").rlike(r"[^\s\x{00A0}]"))
    return both.select("src", "row_id", "period", whole_number("t").alias("key"), "at")


def _orphans(spark: SparkSession, d: str) -> DataFrame:
    teams = table(spark, d, "teams").select(F.col("team_id").alias("key"), F.col("added_at").alias("start"), F.col("deleted_at").alias("stop"))
    return references.orphans(team_references(spark, d), teams)


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    return _orphans(spark, d).select("src", "row_id", "kind")


def p3_report(spark: SparkSession, d: str) -> DataFrame:
    return references.orphan_report(_orphans(spark, d))


# ---------------------------------------------------------------- 4
def p4_found(spark: SparkSession, d: str) -> DataFrame:
    issues = profile.load_issues(table(spark, d, "summaries_input"), "load_no", DOWN_RANGES)
    return issues.select(F.col("load").alias("load_no"), "col", "issue")


def p4_profile(spark: SparkSession, d: str) -> DataFrame:
    """Every column of the table; text other than down and distance must not be blank."""
    rows = table(spark, d, "summaries_input")
    text = {c: r"\S" for c, kind in rows.dtypes if kind == "string" and c not in DOWN_RANGES}
    p = profile.column_profile(rows, "load_no", rows.columns, text)
    r = lambda c: F.when(F.abs(c) < 1e6, F.round(c, 6)).otherwise(F.round(c, 2)).alias(c)  # noqa: E731 (a DOUBLE has no more digits)
    return p.select(F.col("load").alias("load_no"), "col", F.col("rows").alias("n_rows"), F.col("nulls").alias("n_nulls"), "distinct_values", "violations", "low", "high", "decimals", "s1_units", "s2_units", r("mean"), r("sd"), r("std_diff"), r("null_rate_diff"))


# ---------------------------------------------------------------- 5
def latest_games(spark: SparkSession, d: str) -> DataFrame:
    """Each game's delivery loaded last."""
    s = table(spark, d, "schedules").where("game_id is not null")
    row = F.struct("season", "week", "kickoff", "home_id", "away_id", "home_score", "away_score", "neutral_site")
    return s.groupBy("game_id").agg(F.max_by(row, F.struct("loaded_at", "kickoff", "week", "home_id", "away_id")).alias("g")).select("game_id", "g.*")


def _known_snapshots(spark: SparkSession, d: str) -> DataFrame:
    """game_id, team_id, season, row_id: the snapshot each side was known by at kickoff.

    A game's two sides differ by team, so (game_id, key) identifies the event.
    """
    sides = latest_games(spark, d).select("game_id", "season", "week", "kickoff", F.explode(F.array_distinct(F.array("home_id", "away_id"))).alias("key")).where("key is not null")
    events = sides.select("key", "season", F.col("game_id").alias("ev_id"), F.col("week").alias("bound"), F.col("kickoff").alias("at"))
    snaps = table(spark, d, "cfb_higher_models").select(whole_number("team_id").alias("key"), "season", F.col("through_week").alias("valid"), F.col("published_at").alias("known"), F.col("row_id").alias("version_id"))
    got = known_at.known_at(events, snaps, ["key", "season"])
    return got.select(F.col("ev_id").alias("game_id"), F.col("key").alias("team_id"), "season", F.col("version_id").alias("row_id"))


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    return _known_snapshots(spark, d).select("game_id", "team_id", "row_id")


def p5_features(spark: SparkSession, d: str) -> DataFrame:
    """Each known side of a game with the snapshot's attributes."""
    cols = ["epaplay_off", "epaplay_def", "talent_composite", "blue_chip_ratio", "off_returning", "overall_returning"]
    snaps = table(spark, d, "cfb_higher_models").select("row_id", "through_week", *cols)
    return _known_snapshots(spark, d).join(snaps, "row_id").select("game_id", "team_id", "season", "row_id", "through_week", *cols)


# ---------------------------------------------------------------- 6
def _documents(spark: SparkSession, d: str) -> DataFrame:
    return nested.readable_documents(table(spark, d, "game_docs"))


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    return nested.found_rows(_documents(spark, d))


def _flat(name: str):
    def run(spark: SparkSession, d: str) -> DataFrame:
        return nested.flat_table(_documents(spark, d), name)

    return run


def p6_athlete_stats(spark: SparkSession, d: str) -> DataFrame:
    return nested.athlete_stats(_documents(spark, d))


# ---------------------------------------------------------------- 7
def p7_found(spark: SparkSession, d: str) -> DataFrame:
    return drift.changes(table(spark, d, "raw_records"))


def p7_plays(spark: SparkSession, d: str) -> DataFrame:
    return drift.unified_table(table(spark, d, "raw_records"), "summaries_input")


def p7_team_summaries(spark: SparkSession, d: str) -> DataFrame:
    return drift.unified_table(table(spark, d, "raw_records"), "team_summaries")


QUERIES = {
    "p1_found": p1_found, "p1_wide": p1_wide,
    "p3_found": p3_found, "p3_report": p3_report,
    "p4_found": p4_found, "p4_profile": p4_profile,
    "p5_found": p5_found, "p5_features": p5_features,
    "p6_found": p6_found, **{f"p6_{n}s": _flat(n) for n in nested.TABLES if n != "betting"}, "p6_betting_lines": _flat("betting"), "p6_athlete_stats": p6_athlete_stats,
    "p7_found": p7_found, "p7_plays": p7_plays, "p7_team_summaries": p7_team_summaries,
}

# ---------------------------------------------------------------- SQL
_KEY = r"nullif(lower(regexp_replace({0}, '[^\p{{L}}\p{{N}}]+', '', 'g')), '')"
_CELLS = rf"""
with named as (select *, {_KEY.format('stat_name')} nk, {_KEY.format('stat_label')} lk from reshapers_statistics),
spell as (select nk, stat_name, row_number() over (partition by nk order by count(*) desc, stat_name) r from named where nk is not null group by 1, 2),
meaning as (select lk, nk, row_number() over (partition by lk order by count(*) desc, nk) r from named where lk is not null and nk is not null group by 1, 2),
res as (select n.game_id, n.team_id, n.loaded_at, n.stat_row_id, coalesce(n.nk, m.nk) k, n.stat_value x, n.display_value d,
  trim(replace(regexp_replace(n.display_value, '[\s\x{{00A0}}\x{{2000}}-\x{{200B}}\x{{3000}}]+', ' ', 'g'), '−', '-')) s
  from named n left join meaning m on n.nk is null and m.lk = n.lk and m.r = 1 where n.game_id is not null and n.team_id is not null),
kinds as (select *, case when k in ('yardsperpass', 'yardsperrushattempt', 'successrate') then 'decimal' when k = 'possessiontime' then 'duration'
  when k in ('completionattempts', 'thirddowneff', 'fourthdowneff', 'totalpenaltiesyards', 'sacksyardslost') then 'pair' else 'whole' end kind from res where k is not null),
vals as (select *, case
  when d is null and kind = 'pair' then null
  when d is null and kind = 'decimal' then case when not isnan(x) then cast(round(x * 1000) as bigint) end
  when d is null then case when not isnan(x) and x = floor(x) then cast(x as bigint) end
  when kind = 'whole' then case
    when regexp_full_match(s, '\([0-9]+\)') then -cast(regexp_extract(s, '[0-9]+') as bigint)
    when regexp_full_match(s, '[+-]?([0-9]+|[0-9]{{1,3}}(,[0-9]{{3}})+)([.]0*)?') then cast(replace(regexp_replace(s, '[.]0*$', ''), ',', '') as bigint) end
  when kind = 'decimal' then case when regexp_full_match(replace(s, ',', '.'), '[+-]?([0-9]+([.][0-9]*)?|[.][0-9]+)') then cast(cast(replace(s, ',', '.') as decimal(18, 3)) * 1000 as bigint) end
  when kind = 'duration' then case
    when regexp_full_match(s, '([0-9]{{1,2}}:)?[0-9]{{1,3}}:[0-5][0-9]') then cast(coalesce(nullif(regexp_extract(s, '^([0-9]+):[0-9]+:', 1), ''), '0') as bigint) * 3600
      + cast(regexp_extract(s, '([0-9]+):[0-9]+$', 1) as bigint) * 60 + cast(regexp_extract(s, '([0-9]+)$', 1) as bigint)
    when regexp_full_match(s, '[0-9]+ ?m ?[0-9]+ ?s') then cast(regexp_extract(s, '^([0-9]+)', 1) as bigint) * 60 + cast(regexp_extract(s, '([0-9]+) ?s$', 1) as bigint) end
  when regexp_full_match(s, '[0-9]+ ?([-/–—]|of) ?[0-9]+( ?[(][0-9.]+ ?%[)])?') then cast(regexp_extract(s, '^([0-9]+)', 1) as bigint) * 1000 + cast(regexp_extract(s, '^[0-9]+ ?(?:[-/–—]|of) ?([0-9]+)', 1) as bigint)
  end val from kinds),
cells as (select game_id, team_id, k, kind, val from vals where val is not null qualify row_number() over (partition by game_id, team_id, k order by loaded_at desc, stat_row_id desc) = 1)
"""

_REFS = r"""
refs as (select * from (
  select 'cfb_higher_models' src, row_id, concat_ws('-', season, through_week) period, team_id t, published_at at_ from cfb_higher_models
  union all select 'cfb_ratings_2025', rating_id, strftime(rated_at, '%Y-%m'), cast(team_id as varchar), rated_at from cfb_ratings_2025) where regexp_matches(t, '[^\s]')),
keyed as (select *, case when regexp_full_match(trim(t), '[+-]?[0-9]+([.]0+)?') then try_cast(regexp_replace(trim(t), '[.]0+$', '') as bigint) end k from refs),
known as (select team_id k, min(added_at) begins from teams where team_id is not null group by 1),
kinds as (select r.*, case when n.k is null then 'missing' when r.at_ < n.begins then 'late'
  when not exists (select 1 from teams t where t.team_id = r.k and t.added_at <= r.at_ and (t.deleted_at is null or r.at_ < t.deleted_at)) then 'deleted' end kind
  from keyed r left join known n on n.k = r.k)
"""

_VALUES = r"""
vals as (select load_no, 'down' col, down v from summaries_input union all select load_no, 'distance', distance from summaries_input),
read as (select load_no, col, v, case when regexp_full_match(trim(v), '[+-]?[0-9]+([.]0+)?') then cast(regexp_replace(trim(v), '[.]0+$', '') as bigint) end x from vals)
"""

_KNOWN = r"""
games as (select * from schedules where game_id is not null qualify row_number() over (partition by game_id order by loaded_at desc) = 1),
sides as (select game_id, season, week, kickoff, home_id team_id from games where home_id is not null union select game_id, season, week, kickoff, away_id from games where away_id is not null),
snaps as (select *, case when regexp_full_match(trim(team_id), '[+-]?[0-9]+([.]0+)?') then try_cast(regexp_replace(trim(team_id), '[.]0+$', '') as bigint) end k from cfb_higher_models),
got as (select s.game_id, s.team_id, s.season, n.row_id from sides s join snaps n on n.k = s.team_id and n.season = s.season and n.through_week < s.week and n.published_at <= s.kickoff
  qualify row_number() over (partition by s.game_id, s.team_id order by n.through_week desc, n.published_at desc, n.row_id) = 1)
"""

SQL = {
    "p1_found": _CELLS + "select game_id, team_id, s.stat_name stat, val from cells c join spell s on s.nk = c.k and s.r = 1",
    "p3_found": "with " + _REFS + "select src, row_id, kind from kinds where kind is not null",
    "p3_report": "with " + _REFS + "select src, period, kind, count(*) n_orphans, count(distinct k) n_keys from kinds where kind is not null group by all",
    "p4_found": "with " + _VALUES + """,
stats as (select load_no, col, count(*) n, count(*) filter (v is null) nulls, count(*) filter (v is not null and x is null) bad,
  count(*) filter (x is not null and not (x between 1 and case col when 'down' then 4 else 99 end)) outside, count(distinct x) dx from read group by all),
num as (select load_no, col, x, count(*) n from read where x is not null group by all),
sides as (select load_no, col, x, n own, 0 prior from num union all select load_no + 1, col, x, 0, n from num),
m as (select load_no, col, x, sum(own) own, sum(prior) prior from sides group by all),
c as (select load_no, col, sum(own) over w a, sum(prior) over w b, sum(own) over p na, sum(prior) over p nb from m window w as (partition by load_no, col order by x), p as (partition by load_no, col)),
shifted as (select load_no, col from c group by all having max(abs(a * nb - b * na) * 4 > na * nb and na * nb > 0))
select load_no, col, 'nulls' issue from stats where nulls * 100 > n * 30
union all select load_no, col, 'pattern' from stats where bad * 100 > n * 3
union all select load_no, col, 'range' from stats where outside * 100 > n * 2
union all select load_no, col, 'constant' from stats where dx = 1
union all select load_no, col, 'shift' from shifted semi join stats using (load_no, col)""",
    "p4_profile": "with vals as ("
    + " union all ".join(
        [f"select load_no, '{c}' col, hash({c}) h, {c} is null z, true fits, cast(cast({c} as bigint) as hugeint) u, cast({c} as double) v, 0 decimals, true summed from summaries_input" for c in _WHOLE]
        + [f"select load_no, '{c}', hash({c}), {c} is null, not isnan({c}) and not isinf({c}), case when not isnan({c}) and not isinf({c}) then cast(round({c} * 1e9) as hugeint) end, case when not isnan({c}) and not isinf({c}) then {c} end, 9, true from summaries_input" for c in _DECIMAL]
        + ["select load_no, 'loaded_at', hash(loaded_at), loaded_at is null, true, null, cast(epoch_us(loaded_at) as double), 0, false from summaries_input"]
        + [f"select load_no, '{c}', hash({c}), {c} is null, x is not null, x, cast(x as double), 0, true from (select *, case when regexp_full_match(trim({c}), '[+-]?[0-9]+([.]0+)?') then cast(regexp_replace(trim({c}), '[.]0+$', '') as bigint) end x from summaries_input)" for c in _NUMBER_TEXT]
        + [f"select load_no, '{c}', hash({c}), {c} is null, regexp_matches({c}, '[^ ]'), null, null, 0, true from summaries_input" for c in _TEXT]
    )
    + """),
st as (select load_no, col, decimals, count(*) n_rows, count(*) filter (z) n_nulls, count(distinct h) filter (not z) distinct_values, count(*) filter (not z and not coalesce(fits, false)) violations, min(v) low, max(v) high,
  count(u) n, sum(u) a, sum(u * u) b from vals group by all),
m as (select *, (a::double / nullif(n, 0)) / power(10, decimals) mean, sqrt(greatest(n * b - a * a, 0)::double / nullif(n::double * n, 0)) / power(10, decimals) sd from st)
select x.load_no, x.col, x.n_rows, x.n_nulls, x.distinct_values, x.violations, x.low, x.high, cast(x.decimals as int) decimals, cast(x.a as varchar) s1_units, cast(x.b as varchar) s2_units, case when abs(x.mean) < 1e6 then round(x.mean, 6) else round(x.mean, 2) end mean, case when abs(x.sd) < 1e6 then round(x.sd, 6) else round(x.sd, 2) end sd,
  round((x.mean - y.mean) / nullif(sqrt((x.sd * x.sd + y.sd * y.sd) / 2), 0), 6) std_diff, round(x.n_nulls / x.n_rows::double - y.n_nulls / y.n_rows::double, 6) null_rate_diff
from m x left join m y on y.load_no = x.load_no - 1 and y.col = x.col""",
    "p5_found": "with " + _KNOWN + "select game_id, team_id, row_id from got",
    "p5_features": "with " + _KNOWN + "select g.game_id, g.team_id, g.season, g.row_id, n.through_week, n.epaplay_off, n.epaplay_def, n.talent_composite, n.blue_chip_ratio, n.off_returning, n.overall_returning from got g join cfb_higher_models n using (row_id)",
    "p6_found": problem_sql.NESTED, **problem_sql.FLAT,
    "p7_found": problem_sql.DRIFT,
}
