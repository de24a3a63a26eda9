"""The longer SQL texts: nested documents and drifting schemas, written for comparison only."""

from __future__ import annotations

# ---------------------------------------------------------------- 6
#: By block: the fields by which a lone object is told from an object keyed by its elements' keys.
_OWN = {
    "comp": ("competitors", "id", "date"), "sides": ("team", "homeAway"), "lines": ("displayValue", "value"), "teams": ("team", "statistics"), "players": ("team", "statistics"),
    "teams_stats": ("name", "label", "displayValue"), "players_stats": ("name", "athletes", "keys"), "athletes": ("athlete", "stats"), "betting": ("odds_source", "game_spread", "over_under"),
}
_LONE = " or ".join(f"(what = '{w}' and (" + " or ".join(f"coalesce(json_type(x, '$.{f}'), 'NULL') <> 'NULL'" for f in fs) + "))" for w, fs in _OWN.items())


def _entries(table: str) -> str:
    n = "unnest(range(json_array_length(x)::bigint))"
    return f"""select g, pk, what, k, i, v from (
  select g, pk, what, null k, {n} i, json_extract(x, '$[' || {n} || ']') v from {table} where json_type(x) = 'ARRAY'
  union all select g, pk, what, null, 0, x from {table} where json_type(x) = 'OBJECT' and ({_LONE})
  union all select g, pk, what, unnest(json_keys(x)), 0, json_extract(x, '$."' || unnest(json_keys(x)) || '"') from {table} where json_type(x) = 'OBJECT' and not ({_LONE})) where json_type(v) = 'OBJECT' and len(json_keys(v)) > 0"""


def _id(x: str) -> str:
    return rf"(try_cast(regexp_extract({x}, '^\s*([+-]?[0-9]+)([.]0+)?\s*$', 1) as bigint))::varchar"


def _txt(f: str) -> str:
    return f"case when trim(json_extract_string(v, '$.{f}')) <> '' then json_extract_string(v, '$.{f}') end"


_TEAM = f"coalesce({_id("json_extract_string(v, '$.team.id')")}, case when coalesce(json_type(v, '$.team'), 'NULL') = 'NULL' then {_id('k')} end)"
_UNWRAP = "select * replace (case when json_type(b) = 'VARCHAR' then json_extract_string(b, '$') when json_type(b) = 'ARRAY' and json_array_length(b) = 1 then json_extract(b, '$[0]')::varchar else b end as b)"
_ATHLETE = _id("json_extract_string(v, '$.athlete.id')")
_STAT = f"coalesce({_txt('name')}, {_txt('label')}, k)"

NESTED = f"""
with b0 as (select game_id, loaded_at, doc_row_id, trim(body) b from game_docs where body is not null and json_valid(body)),
b1 as ({_UNWRAP} from b0), b2 as ({_UNWRAP} from b1 where json_valid(b)),
docs as (select game_id g, b::json j from b2 where json_valid(b) and json_type(b) = 'OBJECT' qualify row_number() over (partition by game_id order by loaded_at desc, doc_row_id desc) = 1),
blocks as (select g, '' pk, 'comp' what, json_extract(j, '$.header.competitions') x from docs union all select g, '', 'teams', json_extract(j, '$.boxscore.teams') from docs
  union all select g, '', 'players', json_extract(j, '$.boxscore.players') from docs union all select g, '', 'betting', json_extract(j, '$.betting') from docs),
e1 as ({_entries('blocks')}),
comp as (select g, {_id("coalesce(json_extract_string(v, '$.id'), k)")} pk, 'sides' what, json_extract(v, '$.competitors') x from e1 where what = 'comp'),
e2 as ({_entries('comp')}),
sides as (select g, pk comp, {_TEAM} pk, 'lines' what, json_extract(v, '$.linescores') x from e2 where pk is not null),
e3 as ({_entries('sides')}),
tm as (select g, {_TEAM} pk, what || '_stats' what, json_extract(v, '$.statistics') x from e1 where what in ('teams', 'players')),
e4 as ({_entries('tm')}),
cats as (select g, pk || '/' || coalesce({_txt('name')}, k) pk, 'athletes' what, json_extract(v, '$.athletes') x from e4 where what = 'players_stats' and pk is not null and coalesce({_txt('name')}, k) is not null),
e5 as ({_entries('cats')}),
bets as (select g, coalesce({_txt('odds_source')}, k) ck from e1 where what = 'betting')
select distinct g game_id, child, pk parent_key, ck child_key from (
select g, 'competitor' child, comp pk, pk ck from sides where pk is not null union all select g, 'linescore', pk, (i + 1)::varchar from e3 where pk is not null
union all select g, 'team_stat', pk, {_STAT} from e4 where what = 'teams_stats' and pk is not null and {_STAT} is not null
union all select g, 'athlete_line', pk, {_ATHLETE} from e5 where {_ATHLETE} is not null
union all select g, 'betting', g::varchar, ck from bets where ck is not null)"""

# ---------------------------------------------------------------- 6, the flat tables
def _rows(table: str, carry: str) -> str:
    """The objects of a block with their key or place; keyed blocks in the order of their keys."""
    n = "unnest(range(json_array_length(x)::bigint))"
    key = "unnest(list_sort(json_keys(x)))"
    return f"""select g, {carry}, what, k, i, v from (
  select g, {carry}, what, null k, {n} i, json_extract(x, '$[' || {n} || ']') v from {table} where json_type(x) = 'ARRAY'
  union all select g, {carry}, what, null, 0, x from {table} where json_type(x) = 'OBJECT' and ({_LONE})
  union all select g, {carry}, what, {key}, unnest(range(len(json_keys(x)))), json_extract(x, '$."' || {key} || '"') from {table} where json_type(x) = 'OBJECT' and not ({_LONE})) where json_type(v) = 'OBJECT' and len(json_keys(v)) > 0"""


_SHOWN = "coalesce(" + ", ".join(f"case when json_type(v, '$.{f}') = 'DOUBLE' then regexp_replace(json_extract_string(v, '$.{f}'), '[.]0+$', '') else json_extract_string(v, '$.{f}') end" for f in ("displayValue", "value")) + ")"  # a number has no zero decimals
_FLAT = NESTED[: NESTED.index("e1 as (")] + f"""
f1 as ({_rows('blocks', 'pk')}),
comps as (select g, {_id("coalesce(json_extract_string(v, '$.id'), k)")} comp, 'sides' what, json_extract(v, '$.competitors') x from f1 where what = 'comp'),
f2 as ({_rows('comps', 'comp')}),
sd as (select g, comp, {_TEAM} team, i, 'lines' what, json_extract(v, '$.linescores') x from f2 where comp is not null and {_TEAM} is not null),
f3 as ({_rows('sd', 'comp, team')}),
tm as (select g, {_TEAM} team, json_extract_string(v, '$.homeAway') home_away, what || '_stats' what, json_extract(v, '$.statistics') x from f1 where what in ('teams', 'players') and {_TEAM} is not null),
f4 as ({_rows('tm', 'team, home_away')}),
cats as (select g, team, coalesce({_txt('name')}, k) category, json_extract(v, '$.keys') keys, 'athletes' what, json_extract(v, '$.athletes') x from f4 where what = 'players_stats' and coalesce({_txt('name')}, k) is not null),
f5 as ({_rows('cats', 'team, category, keys')}),
lines as (select g, team, category, i, coalesce({_ATHLETE}, case when coalesce(json_type(v, '$.athlete'), 'NULL') = 'NULL' then {_id('k')} end) athlete,
  case when json_type(keys) = 'ARRAY' then keys->>'$[*]' end ks, case when json_type(v, '$.stats') = 'ARRAY' then json_extract_string(v, '$.stats[*]') end st from f5),
zipped as (select g, team, category, athlete, i, unnest(range(1, len(st) + 1)) p, ks, st from lines where athlete is not null and st is not null),
named as (select g, team, category, athlete, i, case when len(ks) = len(st) then ks[p] else 'stat_' || (p - 1) end stat, st[p] val from zipped)
"""
FLAT = {
    "p6_competitors": _FLAT + "select g game_id, comp competition, team, cast(i as int) i from sd",
    "p6_linescores": _FLAT + f"select g game_id, comp competition, team, cast(coalesce(try_cast(k as int), i + 1) as int) period, {_SHOWN} score from f3",
    "p6_team_stats": _FLAT + f"select g game_id, team, home_away, {_STAT} stat, cast(i as int) i, {_SHOWN} as \"value\" from f4 where what = 'teams_stats' and {_STAT} is not null",
    "p6_betting_lines": _FLAT + f"select g game_id, coalesce({_txt('odds_source')}, k) odds_source, cast(i as int) i, try_cast(json_extract_string(v, '$.game_spread') as double) game_spread, try_cast(json_extract_string(v, '$.over_under') as double) over_under, try_cast(json_extract_string(v, '$.home_favorite') as boolean) home_favorite from f1 where what = 'betting' and coalesce({_txt('odds_source')}, k) is not null",
    "p6_athlete_stats": _FLAT + "select g game_id, team, category, athlete, cast(i as int) i, stat, val as \"value\" from named qualify row_number() over (partition by g, team, category, athlete, stat order by i) = 1",
}

# ---------------------------------------------------------------- 7
DRIFT = r"""
with recursive files as (select feed_id f, file_no n, row_number() over (partition by feed_id order by file_no) i from (select distinct feed_id, file_no from raw_records where feed_id is not null and file_no is not null)),
rec as (select fi.f, fi.i, r.body::json j from raw_records r join files fi on fi.f = r.feed_id and fi.n = r.file_no where json_valid(r.body) and json_type(r.body) = 'OBJECT'),
kv as (select f, i, json_extract_string(j, '$.id') id, unnest(json_keys(j)) k, j from rec),
ty as (select f, i, id, k, json_extract(j, '$."' || k || '"') v, json_type(json_extract(j, '$."' || k || '"')) t from kv),
kinds as (select *, case when t in ('BIGINT', 'UBIGINT') then 'whole' when t = 'DOUBLE' then 'decimal' when t = 'VARCHAR' then 'text' when t = 'BOOLEAN' then 'boolean' when t = 'ARRAY' then 'list' when t = 'OBJECT' then 'object' end c from ty),
cat0 as (select f, i, k, list_sort(list_distinct(list(c))) ts from kinds group by all),
cat as (select f, i, k, case when len(ts) = 0 then null when len(ts) = 1 then ts[1] when ts = ['decimal', 'whole'] then 'decimal' else 'text' end type from cat0),
came as (select c.* from cat c where c.i > 1 and not exists (select 1 from cat p where p.f = c.f and p.i = c.i - 1 and p.k = c.k)),
went as (select c.f, c.i + 1 i, c.k from cat c where exists (select 1 from files x where x.f = c.f and x.i = c.i + 1) and not exists (select 1 from cat p where p.f = c.f and p.i = c.i + 1 and p.k = c.k)),
text as (select f, i, id, k, lower(trim(regexp_extract(v::varchar, '(?s)^\s*(?:\[|\{\s*"[^"]*"\s*:)?\s*"?(.*?)"?\s*[\]}]?\s*$', 1))) s from kinds where c is not null and id is not null),
facts as (select f, i, id, k, min(coalesce(case when regexp_full_match(s, '[+-]?([0-9]+([.][0-9]*)?|[.][0-9]+)([eE][+-]?[0-9]+)?') then s::double when s = 'true' then 1.0 when s = 'false' then 0.0
  when regexp_full_match(s, '[0-9]{4}[-/][0-9]{2}') then left(s, 4)::double end::varchar, s)) fact from text group by all),
pairs as (select w.f, w.i, w.k old, c.k new, count(*) n, count(*) filter (a.fact = b.fact) same from went w join came c on c.f = w.f and c.i = w.i join facts a on a.f = w.f and a.i = w.i - 1 and a.k = w.k join facts b on b.f = c.f and b.i = c.i and b.k = c.k and b.id = a.id group by all),
ren as (select * from pairs where same >= 0.9 * n qualify row_number() over (partition by f, i, old order by same / n desc, same desc, new) = 1 and row_number() over (partition by f, i, new order by same / n desc, same desc, old) = 1),
linked as (select c.*, coalesce(r.old, case when c.i > 1 and p.k is not null then c.k end) parent from cat c left join ren r on r.f = c.f and r.i = c.i and r.new = c.k left join cat p on p.f = c.f and p.i = c.i - 1 and p.k = c.k),
st as (select f, i, k, type had from linked where parent is null union all select l.f, l.i, l.k, coalesce(l.type, s.had) from st s join linked l on l.f = s.f and l.i = s.i + 1 and l.parent = s.k),
ch as (select f, i, k field, 'added' change from came where (f, i, k) not in (select f, i, new from ren) union all select f, i, k, 'removed' from went where (f, i, k) not in (select f, i, old from ren) union all select f, i, new, 'renamed' from ren
  union all select l.f, l.i, l.k, 'retyped' from linked l join st s on s.f = l.f and s.i = l.i - 1 and s.k = l.parent where l.type <> s.had)
select ch.f feed_id, fi.n file_no, field, change from ch join files fi on fi.f = ch.f and fi.i = ch.i"""
