"""Schemas that drift between files: a column lifespan catalogue.

Each file's footer (which fields occur, with which types, and if asked how many values of each form) is one small
aggregate over the records. Everything else works on these footers: islands of consecutive
files per (feed, field) are lifespans, their starts and endings are the added and removed fields,
``lag``-style windows over the types are the retypings, and records that a file repeats from the
file before decide which ending and which start are the same field (an alias). The alias table is data: joined to the
records by file it says which field fills which column, so the plan of the consistent table grows with its columns only;
their casts are generated from the forms of the values.

Defined results
- a body that is no JSON object (or NULL) has no fields; NULL feed or file numbers belong to no file.
- the first file of a feed has no changes. Names are case-sensitive.
- type of a field: over its non-NULL values; whole and decimal numbers make decimal, any other mix text;
  without values it keeps the type it had (also across a renaming).
- renamed: at least ``MIN_SHARE`` of the facts that repeated records carry under both names agree;
  the best agreement wins on both sides, ties by the closer spelling, then by name.
- repeated rows change nothing but counts; ids repeated in a file count once; an empty table has no changes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fieldspark.session import broadcast_if_small, cut

MIN_SHARE = 0.9
#: More columns than this is an error, as each is a column of the plan.
MAX_COLUMNS = 5_000
_NUMBER = r"^[+-]?([0-9]+(\.[0-9]*)?|\.[0-9]+)([eE][+-]?[0-9]+)?$"


def records(rows: DataFrame) -> DataFrame:
    """feed, file, row, doc (VARIANT) of every record in a file.

    The parser stops after a first document, so the body is read inside brackets: one object, nothing behind it.
    """
    one = """transform(array(try_parse_json(concat('[', body, ']'))), z -> case when body rlike '(?s)^\\\\s*[{].*[}]\\\\s*$' and cardinality(try_variant_get(z, '$', 'array<variant>')) = 1 then try_variant_get(z, '$[0]', 'variant') end)[0]"""
    return rows.where("feed_id is not null and file_no is not null").select(
        F.col("feed_id").alias("feed"), F.col("file_no").alias("file"), F.col("record_row_id").alias("row"), "dataset", F.expr(one).alias("doc")
    )


_PLAIN = r'(?s)^\s*(?:\[|\{\s*"[^"]*"\s*:)?\s*"?(.*?)"?\s*[\]}]?\s*$'


def _plain(text: Column) -> Column:
    """A value's text without a single wrapping."""
    return F.when(text.rlike(r'^[^\[\]{}"\s]([^\[\]{}"]*[^\[\]{}"\s])?$'), text).otherwise(F.regexp_extract(text, _PLAIN, 1))


def _fields(recs: DataFrame, *keep: str) -> DataFrame:
    """One row per record and key: the kept columns, field, value (VARIANT); what is no object has none."""
    pairs = F.expr("map_entries(try_variant_get(doc, '$', 'map<string,variant>'))")
    return recs.select(*keep, F.inline(pairs).alias("field", "value"))


def _type(kind: Column) -> Column:
    return (
        F.when(kind.isNull() | (kind == "VOID"), F.lit(None).cast("string"))
        .when(kind == "BOOLEAN", "boolean")
        .when(kind == "STRING", "text")
        .when(kind.startswith("ARRAY"), "list")
        .when(kind.startswith("OBJECT"), "object")
        .when(kind.rlike(r"^(BIGINT|INT|SMALLINT|TINYINT)$") | kind.rlike(r"^DECIMAL\((19|[23][0-9]),0\)$"), "whole")
        .otherwise("decimal")
    )


def _mixed(types: Column) -> Column:
    """One type for a set of types; NULL for none."""
    t = F.array_sort(types)
    return F.when(F.size(t) == 0, F.lit(None).cast("string")).when(F.size(t) == 1, F.get(t, 0)).when(t == F.array(F.lit("decimal"), F.lit("whole")), "decimal").otherwise("text")


def files(recs: DataFrame) -> DataFrame:
    """feed, file, idx: the files of each feed in order."""
    w = Window.partitionBy("feed").orderBy("file")
    return recs.select("feed", "file").distinct().withColumn("idx", F.row_number().over(w))


def footers(recs: DataFrame, forms: bool = False) -> DataFrame:
    """feed, dataset, file, field, type (NULL: no values); with ``forms`` also counts of the values' forms.

    Values are counted by their kind first (a partial aggregate with few groups per file), types are told from the kinds.
    """
    f = _fields(recs, "feed", "dataset", "file").withColumn("kind", F.expr("schema_of_variant(value)"))
    keys = ["feed", "dataset", "file", "field"]
    if forms:
        # only text and single wrappings need a look at the value
        text = F.expr("try_variant_get(value, '$', 'string')")
        look = F.when((F.col("kind") == "STRING") | F.col("kind").startswith("ARRAY") | F.col("kind").startswith("OBJECT"), _plain(text))
        f = f.withColumn("plain", look)
        form = F.when(F.col("plain").rlike("^[+-]?[0-9]{1,18}$"), "whole").when(F.col("plain").rlike(_NUMBER), "number").when(F.col("plain").isin("true", "false"), "boolean").when(F.col("plain").isNotNull(), "other")
        f = f.withColumn("form", form)
    counted = f.groupBy(*keys, "kind", *(["form"] if forms else [])).agg(F.count(F.lit(1)).alias("n")).withColumn("type", _type(F.col("kind")))
    out = [_mixed(F.collect_set("type")).alias("type")]
    if forms:
        t, form = F.col("type"), F.col("form")
        seen = lambda cond: F.sum(F.when(t.isNotNull() & F.coalesce(cond, F.lit(False)), F.col("n")).otherwise(0))
        whole = (form == "whole") | (form.isNull() & (t == "whole") & (F.col("kind") == "BIGINT"))
        number = form.isin("whole", "number") | (form.isNull() & t.isin("whole", "decimal"))
        out += [seen(F.lit(True)).alias("n_values"), seen(whole).alias("n_whole"), seen(number).alias("n_number"), seen((form == "boolean") | (form.isNull() & (t == "boolean"))).alias("n_boolean")]
    return counted.groupBy(*keys).agg(*out)


def lifespans(foot: DataFrame, order: DataFrame) -> DataFrame:
    """Footers with idx and the island they belong to: born, died, last (the feed's last file)."""
    per = foot.join(order, ["feed", "file"])
    w = Window.partitionBy("feed", "field").orderBy("idx")
    island = per.withColumn("g", F.col("idx") - F.row_number().over(w))
    whole = Window.partitionBy("feed", "field", "g")
    spans = island.withColumn("born", F.min("idx").over(whole)).withColumn("died", F.max("idx").over(whole)).drop("g")
    last = order.groupBy("feed").agg(F.max("idx").alias("last"))
    return spans.join(last, "feed")


def _fact(plain: Column) -> Column:
    """A value's meaning without its notation: numbers by value, seasons by first year, booleans as 0 and 1."""
    s = F.lower(F.trim(plain))
    year = F.regexp_extract(s, r"^([0-9]{4})[-/][0-9]{2}$", 1)
    num = F.when(s.rlike(_NUMBER), s.try_cast("double")).when(year != "", year.try_cast("double")).when(s == "true", 1.0).when(s == "false", 0.0)
    return F.coalesce(num.cast("string"), s)


def renames(recs: DataFrame, spans: DataFrame, order: DataFrame, id_field: str = "id") -> DataFrame:
    """feed, idx, old, new: a lifespan that ended before file idx and one that began there carry the same facts."""
    ended = spans.where("idx = died and died < last").select("feed", "file", (F.col("idx") + 1).alias("at"), "field", F.lit("old").alias("side"))
    begun = spans.where("idx = born and born > 1").select("feed", "file", F.col("idx").alias("at"), "field", F.lit("new").alias("side"))
    both = ended.unionByName(begun)
    # only files where something ended and something began can hold a renaming
    open_at = both.groupBy("feed", "at").agg(F.count_distinct("side").alias("sides")).where("sides = 2").select("feed", "at")
    asked = both.join(open_at, ["feed", "at"], "left_semi")
    by_file = broadcast_if_small(asked.groupBy("feed", "file").agg(F.collect_list(F.struct("at", "side", "field")).alias("asked")), 50_000)
    # of a record only the fields in question are read; facts are compared by their hashes
    near = recs.join(by_file, ["feed", "file"]).select("feed", "asked", F.expr(f"try_variant_get(doc, '$.{id_field}', 'string')").alias("rec"), F.expr("try_variant_get(doc, '$', 'map<string,variant>')").alias("m"))
    told = near.where("rec is not null and m is not null").select("feed", "rec", "m", F.inline("asked"))
    value = F.try_element_at("m", F.col("field"))
    told = told.select("feed", "rec", "at", "side", "field", value.alias("value")).where("value is not null and schema_of_variant(value) <> 'VOID'")
    told = told.withColumn("fact", F.xxhash64(_fact(_plain(F.expr("try_variant_get(value, '$', 'string')")))))
    facts = told.groupBy("feed", "at", "rec", "side", "field").agg(F.min("fact").alias("fact"))
    # a record holds at most its files' fields
    sides = facts.groupBy("feed", "at", "rec").agg(F.collect_list(F.struct("side", "field", "fact")).alias("f")).where("exists(f, x -> x.side = 'old') and exists(f, x -> x.side = 'new')")
    each = "flatten(transform(filter(f, o -> o.side = 'old'), o -> transform(filter(f, n -> n.side = 'new'), n -> struct(o.field as old, n.field as new, int(o.fact = n.fact) as same))))"
    pairs = sides.select("feed", "at", F.expr(f"inline({each})")).groupBy("feed", "at", "old", "new").agg(F.count(F.lit(1)).alias("n"), F.sum("same").alias("same"))
    good = pairs.where(F.col("same") >= F.col("n") * MIN_SHARE)
    key = lambda c: F.lower(F.regexp_replace(c, "[^A-Za-z0-9]", ""))
    # best pair first, then the best of the fields still unmatched, and so on: the same as repeated mutual-best rounds, as the order is total
    best = F.struct((-F.col("same") / F.col("n")).alias("a"), (-F.col("same")).alias("b"), F.levenshtein(key("old"), key("new")).alias("c"), "old", "new")
    taken = (
        "aggregate(p, cast(array() as array<struct<old: string, new: string>>), "
        "(got, x) -> if(exists(got, g -> g.old = x.old or g.new = x.new), got, array_append(got, named_struct('old', x.old, 'new', x.new))))"
    )
    ranked = good.groupBy("feed", "at").agg(F.sort_array(F.collect_list(best)).alias("p"))
    return ranked.select("feed", F.col("at").alias("idx"), F.expr(f"inline({taken})"))


def _islands(spans: DataFrame, alias: DataFrame) -> DataFrame:
    """feed, field, born, own (last type in it), and the island it continues (prev_field, prev_born, or NULL)."""
    own = F.max(F.when(F.col("type").isNotNull(), F.struct("idx", "type")))["type"].alias("own")
    isl = spans.groupBy("feed", "field", "born", "died").agg(own)
    came = alias.select("feed", F.col("idx").alias("born"), F.col("new").alias("field"), F.col("old").alias("prev_field"))
    linked = isl.join(came, ["feed", "born", "field"], "left")
    prev = isl.select("feed", F.col("field").alias("prev_field"), (F.col("died") + 1).alias("born"), F.col("born").alias("prev_born"), F.col("own").alias("inherited"))
    return linked.join(prev, ["feed", "prev_field", "born"], "left")


def _follow(isl: DataFrame, to_root: bool) -> DataFrame:
    """Follow the chain of renamings by pointer doubling: ``inherited`` type, and with ``to_root`` the first name.

    Each round doubles the length of the followed chain, so rounds grow with the logarithm of the
    longest chain; an island needs no round once its type is known (or its root reached).
    """
    cur = isl.withColumn("root", F.coalesce("prev_field", "field"))
    pending = F.col("prev_field").isNotNull() & (F.lit(True) if to_root else F.col("inherited").isNull())
    while True:
        cur = cut(cur)
        if cur.where(pending).isEmpty():
            return cur
        ahead = cur.select(
            "feed", F.col("field").alias("prev_field"), F.col("born").alias("prev_born"), F.col("inherited").alias("i2"), F.col("root").alias("r2"), F.col("prev_field").alias("pf2"), F.col("prev_born").alias("pb2")
        )
        step = cur.join(ahead, ["feed", "prev_field", "prev_born"], "left")
        cur = step.select("feed", "field", "born", "died", "own", F.coalesce("inherited", "i2").alias("inherited"), F.coalesce("r2", "root").alias("root"), F.col("pf2").alias("prev_field"), F.col("pb2").alias("prev_born"))


def changes(rows: DataFrame) -> DataFrame:
    """feed_id, file_no, field, change: added, removed, renamed (field is the new name), retyped."""
    recs = records(rows)
    order = files(recs)
    spans = cut(lifespans(footers(recs), order))
    alias = cut(renames(recs, spans, order))

    began = spans.where("idx = born and born > 1").select("feed", "idx", "field")
    ended = spans.where("idx = died and died < last").select("feed", (F.col("idx") + 1).alias("idx"), "field")
    came, went = alias.select("feed", "idx", F.col("new").alias("field")), alias.select("feed", "idx", F.col("old").alias("field"))
    added = began.join(came, ["feed", "idx", "field"], "left_anti").withColumn("change", F.lit("added"))
    removed = ended.join(went, ["feed", "idx", "field"], "left_anti").withColumn("change", F.lit("removed"))
    renamed = came.withColumn("change", F.lit("renamed"))

    isl = _follow(_islands(spans, alias), to_root=False).select("feed", "field", "born", "inherited")
    before = Window.partitionBy("feed", "field", "born").orderBy("idx").rowsBetween(Window.unboundedPreceding, -1)
    typed = spans.withColumn("had", F.last("type", ignorenulls=True).over(before)).join(isl, ["feed", "field", "born"])
    retyped = typed.where("type <> coalesce(had, inherited)").select("feed", "idx", "field", F.lit("retyped").alias("change"))

    every = added.unionByName(removed).unionByName(renamed).unionByName(retyped)
    return every.join(order, ["feed", "idx"]).select(F.col("feed").alias("feed_id"), F.col("file").alias("file_no"), "field", "change")


def alias_table(recs: DataFrame) -> DataFrame:
    """feed, dataset, file, field, root (the name its chain of renamings began with), and the counts of its values' forms; written down."""
    order = files(recs)
    spans = cut(lifespans(footers(recs, forms=True), order))
    roots = _follow(_islands(spans, renames(recs, spans, order)), to_root=True).select("feed", "field", "born", "root")
    return cut(spans.join(roots, ["feed", "field", "born"]).select("feed", "dataset", "file", "field", "root", "n_values", "n_whole", "n_number", "n_boolean"))


def _column_names(roots: dict[str, int], meeting: set[tuple[str, str]]) -> dict[str, str]:
    """Root -> column. Roots (with their numbers of values) that differ in letter case only are one column, under the most
    used spelling; where two of them meet in a file they stay apart, the rarer one numbered."""
    groups: dict[str, list[str]] = {}
    for root in roots:
        groups.setdefault(root.lower(), []).append(root)
    out: dict[str, str] = {}
    taken = set(groups)
    for spellings in groups.values():
        columns: list[list[str]] = []
        for root in sorted(spellings, key=lambda r: (-roots[r], r)):
            home = next((c for c in columns if not any((root, o) in meeting for o in c)), None)
            if home is None:
                columns.append([root])
            else:
                home.append(root)
        for k, c in enumerate(columns):
            name, number = c[0], k + 1
            while k and name.lower() in taken:
                name, number = f"{c[0]}_{number}", number + 1
            taken.add(name.lower())
            out.update(dict.fromkeys(c, name))
    return out


def unified_table(rows: DataFrame, dataset: str) -> DataFrame:
    """All records of a dataset with one set of typed columns, whatever their files called the fields.

    A column is BIGINT, DOUBLE or BOOLEAN if all its values read so once single wrappings are taken
    off, else STRING. Column names differ in more than letter case. Records meet the alias table by their file; only the
    columns (at most MAX_COLUMNS) visit the driver.
    """
    recs = records(rows).where(F.col("dataset") == dataset)
    al = alias_table(recs)
    counts = ("n_values", "n_whole", "n_number", "n_boolean")
    found = al.groupBy("root").agg(*[F.sum(c).alias(c) for c in counts]).limit(MAX_COLUMNS + 1).collect()
    if len(found) > MAX_COLUMNS:
        raise ValueError(f"more than {MAX_COLUMNS} columns")
    alike = al.groupBy("feed", "file", F.lower("root").alias("low")).agg(F.collect_set("root").alias("r")).where("size(r) > 1").select("r").distinct().collect()
    names = _column_names({r["root"]: r["n_values"] for r in found}, {(a, b) for x in alike for a in x["r"] for b in x["r"]})
    columns = sorted(set(names.values()))
    place = {c: i for i, c in enumerate(columns)}
    sums = {c: dict.fromkeys(counts, 0) for c in columns}
    for r in found:
        for c in counts:
            sums[names[r["root"]]][c] += r[c]
    to_place = rows.sparkSession.createDataFrame([(root, place[c]) for root, c in names.items()], "root string, place int")
    placed = al.join(F.broadcast(to_place), "root")
    shared = not placed.groupBy("feed", "file", "place").agg(F.count(F.lit(1)).alias("n")).where("n > 1").isEmpty()
    mapped = placed.groupBy("feed", "file").agg(F.map_from_entries(F.collect_list(F.struct("field", "place"))).alias("places"))
    by_file = broadcast_if_small(mapped, 50_000)
    texts = recs.join(by_file, ["feed", "file"], "left").select("feed", "file", "row", "places", F.expr("try_variant_get(doc, '$', 'map<string,string>')").alias("t")).where("t is not null")
    if shared:  # two fields of a file fill one column: the first by name that has a value counts
        values = "sort_array(transform(filter(map_entries(t), e -> e.value is not null), e -> struct(e.key as key, places[e.key] as place, e.value as value)))"
        first = "map_from_entries(filter(transform(v, (x, i) -> if(exists(slice(v, 1, i), y -> y.place = x.place), null, struct(x.place, x.value))), z -> z is not null))"
        flat = texts.withColumn("v", F.expr(values)).select("feed", "file", "row", F.expr(first).alias("m"))
    else:
        flat = texts.select("feed", "file", "row", F.expr("map_from_entries(transform(map_entries(t), e -> struct(places[e.key], e.value)))").alias("m"))
    flat = flat.withColumn("m", F.transform_values("m", lambda k, v: _plain(v)))
    out = []
    for c in columns:
        n = sums[c]
        kind = "string" if not n["n_values"] else "bigint" if n["n_whole"] == n["n_values"] else "double" if n["n_number"] == n["n_values"] else "boolean" if n["n_boolean"] == n["n_values"] else "string"
        out.append(F.try_element_at(F.col("m"), F.lit(place[c])).try_cast(kind).alias(c))
    return flat.select(F.col("feed").alias("feed_id"), F.col("file").alias("file_no"), F.col("row").alias("record_row_id"), *out)
