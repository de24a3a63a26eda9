"""Deeply nested game documents into flat, linked tables.

The documents are VARIANT values. Each target table is one SQL projection: nested ``transform``
calls attach the ancestors' keys and indices, ``flatten`` joins the arrays, one ``inline`` emits the
rows. Nothing leaves the JVM and no row multiplies before it is emitted.

A block that should be an array may also be a single object (taken as its only element) or an
object keyed by the element's key (taken as its elements); values that are no object are skipped.

Defined results
- a body counts if it is one JSON document: an object, bare, as text inside a JSON string, or as the only element of an array.
- NULL, empty, cut off or otherwise broken bodies, and repeated keys in an object: unreadable.
- of several readable documents of a game the one loaded last counts, then the larger row id.
- an element that is no object, is empty or lacks its own key is no row, and its children are none.
- ids are whole numbers however written; an id that is none is lacking.
- repeated objects of the same keys make one row in ``found_rows`` and stay apart (by index) in the tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


# ---------------------------------------------------------------- SQL fragments
def _get(v: str, path: str, kind: str) -> str:
    return f"try_variant_get({v}, '$.{path}', '{kind}')"


def _let(value: str, var: str, body: str) -> str:
    """``body`` with ``var`` standing for ``value``, which is evaluated once."""
    return f"element_at(transform(array({value}), {var} -> {body}), 1)"


def _is_object(v: str) -> str:
    return f"coalesce(cardinality(try_variant_get({v}, '$', 'map<string,variant>')) > 0, false)"


def _text(v: str, path: str) -> str:
    """Non-blank text of a scalar field, as written."""
    return f"nullif(regexp_extract({_get(v, path, 'string')}, r'(?s)^(.*\\S.*)$', 1), '')"


def _id(s: str) -> str:
    """Plain whole number of an id written as number or text."""
    return f"cast(try_cast(regexp_extract({s}, r'^\\s*([+-]?[0-9]+)([.]0+)?\\s*$', 1) as bigint) as string)"


def _has(v: str, *paths: str) -> str:
    return f"coalesce({', '.join(_get(v, p, 'variant') for p in paths)}) is not null"


def _entries(v: str, *own: str) -> str:
    """array<struct<k, i, v>> of a block's objects; a lone element is told from a keyed object by its ``own`` fields."""
    arr = "transform(try_variant_get(z, '$', 'array<variant>'), (e, i) -> struct(cast(null as string) as k, i as i, e as v))"
    lone = f"case when {_has('z', *own)} then array(struct(cast(null as string) as k, 0 as i, z as v)) end"
    keyed = "transform(map_entries(try_variant_get(z, '$', 'map<string,variant>')), (e, i) -> struct(e.key as k, i as i, e.value as v))"
    return f"filter({_let(v, 'z', f'coalesce({arr}, {lone}, {keyed}, array())')}, x -> {_is_object('x.v')})"


def _children(parents: str, p: str, block: str, own: tuple[str, ...], child: str, fields: str) -> str:
    """One row per object in each parent's block; ``fields`` may use both row variables."""
    return f"flatten(transform({parents}, {p} -> transform({_entries(_get(f'{p}.v', block, 'variant'), *own)}, {child} -> struct({fields}))))"


#: A team's id, or in an object keyed by team the key.
_TEAM = f"coalesce({_id(_get('t.v', 'team.id', 'string'))}, case when {_get('t.v', 'team', 'variant')} is null then {_id('t.k')} end)"


def _teams(block: str) -> str:
    rows = f"transform({_entries(_get('doc', block, 'variant'), 'team', 'statistics')}, t -> struct({_TEAM} as team, t.i as i, t.v as v))"
    return f"filter({rows}, t -> t.team is not null)"


def _value(v: str) -> str:
    return f"coalesce({_get(v, 'displayValue', 'string')}, {_get(v, 'value', 'string')})"


COMPETITIONS = (
    f"filter(transform({_entries(_get('doc', 'header.competitions', 'variant'), 'competitors', 'id', 'date')}, "
    f"c -> struct(coalesce({_id(_get('c.v', 'id', 'string'))}, {_id('c.k')}) as competition, c.v as v)), c -> c.competition is not null)"
)
COMPETITORS = "filter(" + _children(COMPETITIONS, "c", "competitors", ("team", "homeAway"), "t", f"c.competition as competition, {_TEAM} as team, t.i as i, t.v as v") + ", t -> t.team is not null)"
LINESCORES = _children(
    COMPETITORS, "t", "linescores", ("displayValue", "value"), "l", f"t.competition as competition, t.team as team, coalesce(try_cast(l.k as int), l.i + 1) as period, {_value('l.v')} as score"
)
TEAM_STATS = (
    "filter("
    + _children(
        _teams("boxscore.teams"), "t", "statistics", ("name", "label", "displayValue"), "s",
        f"t.team as team, {_get('t.v', 'homeAway', 'string')} as home_away, coalesce({_text('s.v', 'name')}, {_text('s.v', 'label')}, s.k) as stat, s.i as i, {_value('s.v')} as value",
    )
    + ", s -> s.stat is not null)"
)
CATEGORIES = (
    "filter("
    + _children(_teams("boxscore.players"), "t", "statistics", ("name", "athletes", "keys"), "c", f"t.team as team, coalesce({_text('c.v', 'name')}, c.k) as category, c.v as v")
    + ", c -> c.category is not null)"
)
ATHLETE_LINES = (
    "filter("
    + _children(
        CATEGORIES, "c", "athletes", ("athlete", "stats"), "a",
        f"c.team as team, c.category as category, coalesce({_id(_get('a.v', 'athlete.id', 'string'))}, case when {_get('a.v', 'athlete', 'variant')} is null then {_id('a.k')} end) as athlete, a.i as i, "
        f"{_get('c.v', 'keys', 'array<string>')} as keys, {_get('a.v', 'stats', 'array<string>')} as stats",
    )
    + ", a -> a.athlete is not null)"
)
BETTING = (
    f"filter(transform({_entries(_get('doc', 'betting', 'variant'), 'odds_source', 'game_spread', 'over_under')}, "
    f"b -> struct(coalesce({_text('b.v', 'odds_source')}, b.k) as odds_source, b.i as i, {_get('b.v', 'game_spread', 'double')} as game_spread, "
    f"{_get('b.v', 'over_under', 'double')} as over_under, {_get('b.v', 'home_favorite', 'boolean')} as home_favorite)), b -> b.odds_source is not null)"
)
TABLES = {"competitor": COMPETITORS, "linescore": LINESCORES, "team_stat": TEAM_STATS, "athlete_line": ATHLETE_LINES, "betting": BETTING}
KEYS = {
    "competitor": "r.competition as parent_key, r.team as child_key",
    "linescore": "r.team as parent_key, cast(r.period as string) as child_key",
    "team_stat": "r.team as parent_key, r.stat as child_key",
    "athlete_line": "concat(r.team, '/', r.category) as parent_key, r.athlete as child_key",
    "betting": "cast(game_id as string) as parent_key, r.odds_source as child_key",
}

#: The JSON parser stops after a first document. Read inside brackets and followed by a mark of its own, a body is one
#: document and nothing else if that makes two elements and the second is the mark. A body that holds the mark itself is
#: read inside brackets and inside braces instead: only one whole document parses in both.
_MARK = "fieldspark-mark-7b1f4c9e"
_WHOLE = (
    f"case when contains(b, '{_MARK}') then "
    + _let("try_parse_json(concat('[', b, ']'))", "z", """case when cardinality(try_variant_get(z, '$', 'array<variant>')) = 1 and try_parse_json(concat('{"d":', b, '}')) is not null then try_variant_get(z, '$[0]', 'variant') end""")
    + " else "
    + _let(f"""try_parse_json(concat('[', b, ',"{_MARK}"]'))""", "z", f"case when cardinality(try_variant_get(z, '$', 'array<variant>')) = 2 and try_variant_get(z, '$[1]', 'string') = '{_MARK}' then try_variant_get(z, '$[0]', 'variant') end")
    + " end"
)

#: The text of the one object in a body, whatever it is wrapped in. Each layer has a character before the object's brace, whether
#: written plainly or escaped, so there are no more layers than characters before the first plain brace.
UNWRAPPED = "aggregate(sequence(1, greatest(1, length(substring_index(body, '{', 1)))), ltrim('\\ufeff', body), (b, n) -> case when b rlike '^\\\\s*[{]' then b else " + _let(
    _WHOLE, "y",
    "case when schema_of_variant(y) = 'STRING' then try_variant_get(y, '$', 'string') "
    "when cardinality(try_variant_get(y, '$', 'array<variant>')) = 1 then to_json(try_variant_get(y, '$[0]', 'variant')) end",
) + " end)"


# ---------------------------------------------------------------- documents
def readable_documents(docs: DataFrame, key: str = "game_id", loaded: str = "loaded_at", row: str = "doc_row_id", body: str = "body") -> DataFrame:
    """game_id, doc (VARIANT): each key's readable document loaded last.

    A body is parsed once; a task keeps one document per key before they are shuffled, so deliveries of a hot key meet
    as one document per task.
    """
    d = docs.select(F.col(key).alias("game_id"), F.col(loaded).alias("loaded"), F.col(row).alias("row"), F.col(body).alias("body")).where("body is not null")
    as_id = f"try_cast({_id(_get('z', 'id', 'string'))} as bigint)"
    parsed = _let(_let(UNWRAPPED, "b", _WHOLE), "z", f"case when try_variant_get(z, '$', 'map<string,variant>') is not null then struct(coalesce(game_id, {as_id}) as game_id, z as doc) end")
    # the generator keeps the parse from being copied into the filter
    read = d.select("loaded", "row", F.expr(f"inline(filter(array({parsed}), p -> p.game_id is not null))"))
    return read.groupBy("game_id").agg(F.max_by("doc", F.struct("loaded", "row")).alias("doc"))


def flat_table(documents: DataFrame, name: str) -> DataFrame:
    """One of the flat tables: competitor, linescore, team_stat, athlete_line, betting."""
    rows = documents.select("game_id", F.expr(f"inline({TABLES[name]})"))
    return rows.drop("v")


def power_index(documents: DataFrame) -> DataFrame:
    """game_id, i, fields: the items of a document's power index (a list, or an object that holds one); none: no rows."""
    block = f"coalesce({_get('doc', 'power_index.items', 'array<variant>')}, {_get('doc', 'power_index', 'array<variant>')}, array())"
    items = f"filter(transform({block}, (e, i) -> struct(i as i, try_variant_get(e, '$', 'map<string,string>') as fields)), x -> cardinality(x.fields) > 0)"
    return documents.select("game_id", F.expr(f"inline({items})"))


def found_rows(documents: DataFrame) -> DataFrame:
    """game_id, child, parent_key, child_key: one row per object of any of the tables (repeats are next to each other once sorted)."""
    parts = [f"transform({rows}, r -> struct('{name}' as child, {KEYS[name]}))" for name, rows in TABLES.items()]
    once = _let(f"sort_array(concat({', '.join(parts)}))", "s", "filter(s, (r, i) -> i = 0 or not (r <=> s[i - 1]))")
    return documents.select("game_id", F.expr(f"inline({once})"))


def athlete_stats(documents: DataFrame) -> DataFrame:
    """Athlete lines with keys and values zipped; unequal lengths fall back to positional names."""
    lines = flat_table(documents, "athlete_line")
    zipped = F.when(F.size("keys") == F.size("stats"), F.col("keys")).otherwise(F.transform("stats", lambda x, i: F.concat(F.lit("stat_"), i.cast("string"))))
    w = Window.partitionBy("game_id", "team", "category", "athlete", "stat").orderBy("i")
    long = lines.where("stats is not null").select("game_id", "team", "category", "athlete", "i", F.explode(F.arrays_zip(zipped.alias("k"), F.col("stats").alias("s"))).alias("z"))
    long = long.select("game_id", "team", "category", "athlete", "i", F.col("z.k").alias("stat"), F.col("z.s").alias("value"))
    return long.withColumn("r", F.row_number().over(w)).where("r = 1").drop("r")
