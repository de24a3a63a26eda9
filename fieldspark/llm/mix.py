"""Mixing sources to target shares of a total size.

Each source's documents are shuffled by a hash and read round after round up to the source's *quota*, its share of the
total. The last round ends with the last document that fits whole; what is then missing is filled by further documents of
the round: the next ones in turn that fit into the gap, and last the one whose size comes nearest to it. The mix is a schedule of slots: van der Corput points
(bit-reversed slot numbers) are mapped through the cumulative shares, so every stretch of the schedule already holds the
shares. The quota of a source with s slots is cut into s blocks of equal tokens; a use of a document belongs to the
block in which its middle token lies, and slots and uses meet in one equi-join on (source, block). The number of slots
goes with the mix's total only. Positions in a source and ranks in the schedule are running totals over buckets, so a
source that holds most rows is still spread over all tasks.

Defined results
- shares need not sum to 1: they are scaled over the sources that are present (have tokens). A source that is
  absent, or whose share is NULL or not positive, gets nothing and is reported with 0.
- total size: the largest at which no capped source runs out; if no source has a cap, the smallest at which
  every source is used once. ``total_tokens`` may ask for less, never for more than the caps allow.
- max_repeats NULL: no cap; 0 or less: the source gives nothing. No document is used more often than its cap.
- spellings of a source (case, blanks, punctuation) are one source; listed twice in a mix, shares add up and the smaller cap holds.
- documents with NULL source, NULL or empty text are never drawn. Equal ids are equal documents (the first by text counts).
- a source whose share is too small for the schedule's points has one slot of its own behind the last.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fieldspark.functions.exprs import squash_key
from fieldspark.operators.prefix import running_sum
from fieldspark.session import broadcast_if_small, cut

#: Tokens of a slot, and the fewest slots of a mix.
SLOT_TOKENS = 8192
LEAST_SLOTS = 256
#: Passes that fill the gap to a source's quota, and the documents that each of them considers per mix and source.
FILL_PASSES, FILL_DOCS = 2, 64
BUCKET_ROWS = 50_000
SLOT_CHUNK = 20_000


def stock(sized: DataFrame, seed: int = 42) -> DataFrame:
    """doc_id, source, tokens, order of every document that can be drawn; sized: doc_id, source, tokens."""
    d = sized.select("doc_id", squash_key("source").alias("source"), "tokens").where("source is not null and tokens > 0")
    return d.groupBy("doc_id", "source").agg(F.max("tokens").alias("tokens")).withColumn("order", F.xxhash64("doc_id", F.lit(seed)))


def plan(mixes: DataFrame, totals: DataFrame, slot_tokens: int = SLOT_TOKENS, total_tokens: int | None = None) -> DataFrame:
    """mix_id, source, target_share, max_repeats, stock, largest_doc, weight, quota (tokens), slots (of the whole mix); absent sources have weight NULL."""
    m = mixes.where("mix_id is not null").select("mix_id", squash_key("source").alias("source"), "target_share", "max_repeats")
    m = m.groupBy("mix_id", "source").agg(F.sum("target_share").alias("target_share"), F.min("max_repeats").alias("max_repeats"))
    p = m.join(totals, "source", "left")
    usable = (F.col("stock") > 0) & (F.col("target_share") > 0) & (F.col("max_repeats").isNull() | (F.col("max_repeats") > 0))
    of_mix = Window.partitionBy("mix_id")
    p = p.withColumn("share", F.when(usable, F.col("target_share")))
    p = p.withColumn("weight", F.col("share") / F.sum("share").over(of_mix))
    capped = F.min(F.col("stock") * F.col("max_repeats") / F.col("weight")).over(of_mix)
    free = F.max(F.when(F.col("weight").isNotNull(), F.col("stock") / F.col("weight"))).over(of_mix)
    size = F.coalesce(capped, free)
    if total_tokens is not None:
        size = F.least(F.coalesce(capped, F.lit(float(total_tokens))), F.lit(float(total_tokens)))
    slots = F.greatest(F.lit(LEAST_SLOTS), F.ceil(size / slot_tokens)).cast("bigint")
    return p.select("mix_id", "source", "target_share", "max_repeats", "stock", "largest_doc", "weight", (size * F.col("weight")).alias("quota"), F.when(size > 0, slots).alias("slots"))


def schedule(planned: DataFrame) -> DataFrame:
    """mix_id, slot, source, nth (from 0) of every slot."""
    present = planned.where("weight is not null and slots > 0")
    upto = F.sum("weight").over(Window.partitionBy("mix_id").orderBy("source").rowsBetween(Window.unboundedPreceding, 0))
    rows = present.withColumn("upto", upto)
    mixes = rows.groupBy("mix_id").agg(F.max("slots").alias("slots"), F.array_sort(F.collect_list(F.struct("upto", "source"))).alias("line"))
    chunks = mixes.withColumn("chunk", F.explode(F.expr(f"sequence(0, (slots - 1) div {SLOT_CHUNK})"))).repartition("mix_id", "chunk")
    slots = chunks.withColumn("slot", F.explode(F.expr(f"sequence(chunk * {SLOT_CHUNK}, least(slots, (chunk + 1) * {SLOT_CHUNK}) - 1)")))
    point = F.conv(F.rpad(F.reverse(F.bin("slot")), 53, "0"), 2, 10).cast("double") / F.lit(2.0**53)
    line = F.col("line")
    index = F.least(F.size(F.filter(line, lambda s: s["upto"] <= F.col("point"))), F.size(line) - 1)
    placed = slots.withColumn("point", point).select("mix_id", "slot", "chunk", F.get(line, index)["source"].alias("source"), F.lit(1).alias("one"))
    ranked = running_sum(placed, ["mix_id", "source"], "chunk", [F.col("slot")], "one", "nth").select("mix_id", "slot", "source", (F.col("nth") - 1).alias("nth"))
    left_out = present.select("mix_id", "source", "slots").join(placed.select("mix_id", "source").distinct(), ["mix_id", "source"], "left_anti")
    behind = F.row_number().over(Window.partitionBy("mix_id").orderBy("source")) - 1
    return ranked.unionByName(left_out.select("mix_id", (F.col("slots") + behind).alias("slot"), "source", F.lit(0).cast("bigint").alias("nth")))


def mix(sized: DataFrame, mixes: DataFrame, slot_tokens: int = SLOT_TOKENS, total_tokens: int | None = None, seed: int = 42) -> tuple[DataFrame, DataFrame]:
    """(draws, plan): draws has one row per mix, slot and use of a document, with the round and the tokens."""
    docs = cut(stock(sized, seed))
    per_source = docs.groupBy("source").agg(F.sum("tokens").alias("stock"), F.count(F.lit(1)).alias("docs"), F.max("tokens").alias("largest_doc"))
    wanted = per_source.join(mixes.select(squash_key("source").alias("source")).distinct(), "source", "left_semi")
    largest = wanted.agg(F.max("docs")).first()[0]
    bits = max(0, (-(-int(largest or 1) // BUCKET_ROWS) - 1).bit_length())
    planned = cut(plan(mixes, per_source.select("source", "stock", "largest_doc"), slot_tokens, total_tokens))
    slots = schedule(planned)
    counted = slots.groupBy("mix_id", "source").agg(F.count(F.lit(1)).alias("own_slots"))
    quotas = broadcast_if_small(planned.where("weight is not null and slots > 0").select("mix_id", "source", "stock", "quota").join(counted, ["mix_id", "source"]))
    used = docs.join(quotas.select("source").distinct(), "source", "left_semi")
    placed = running_sum(used.withColumn("bucket", F.shiftright("order", 64 - bits) if bits else F.lit(0)), ["source"], "bucket", [F.col("order"), F.col("doc_id")], "tokens", "upto")
    placed = cut(placed.drop("bucket"))
    quotas = quotas.withColumn("rounds", F.floor(F.col("quota") / F.col("stock"))).withColumn("rest", F.col("quota") - F.col("rounds") * F.col("stock"))
    at = placed.join(quotas, "source")
    uses = F.col("rounds") + (F.col("upto") <= F.col("rest")).cast("bigint")
    each = at.where(uses > 0).withColumn("round", F.explode(F.sequence(F.lit(0).cast("bigint"), uses - 1)))
    middle = F.col("round") * F.col("stock") + F.col("upto") - F.col("tokens") / 2
    block = F.least(F.floor(middle * F.col("own_slots") / F.col("quota")), F.col("own_slots") - 1)
    columns = ["mix_id", "source", "round", "doc_id", "tokens", "nth"]
    turns = each.withColumn("nth", block).select(columns)
    extra = fill(at).withColumn("nth", F.pmod("order", F.col("own_slots"))).withColumn("round", F.col("rounds"))
    draws = turns.unionByName(extra.select(columns)).join(slots, ["mix_id", "source", "nth"])
    return draws.select("mix_id", "slot", "source", "round", "doc_id", "tokens"), planned


def fill(at: DataFrame) -> DataFrame:
    """Documents behind the end of the last round that close the gap to the quota: mix_id, source, doc_id, tokens, order, rounds, own_slots.

    at: the placed documents with their mixes' quotas. A pass takes, of the first FILL_DOCS documents that fit (a top-N
    that is reduced before it is shuffled), one after the other as long as it fits; the last pass takes the nearest size.
    """
    of, doc = ["mix_id", "source"], ["doc_id", "tokens", "order", "rounds", "own_slots"]
    missing = F.max("rest") - F.coalesce(F.max(F.when(F.col("upto") <= F.col("rest"), F.col("upto"))), F.lit(0))
    gap = cut(at.groupBy(*of).agg(missing.cast("double").alias("gap")).where("gap > 0"))
    behind = at.where(F.col("upto") > F.col("rest"))
    picked = None
    for last in [False] * FILL_PASSES + [True]:
        free = behind.join(broadcast_if_small(gap), of)
        if picked is not None:
            free = free.join(broadcast_if_small(picked.select(*of, "doc_id")), [*of, "doc_id"], "left_anti")
        if last:
            off = F.abs(F.col("gap") - F.col("tokens"))
            best = F.min_by(F.struct(*doc), F.struct(off, "order", "doc_id"))
            found = free.where(off < F.col("gap")).groupBy(*of).agg(best.alias("d")).select(*of, "d.*")
        else:
            turn = F.row_number().over(Window.partitionBy(*of).orderBy("order", "doc_id"))
            few = free.where(F.col("tokens") <= F.col("gap")).withColumn("turn", turn).where(F.col("turn") <= FILL_DOCS)
            lists = few.groupBy(*of).agg(F.max("gap").alias("gap"), F.sort_array(F.collect_list(F.struct("turn", *doc))).alias("docs"))
            greedy = "aggregate(docs, named_struct('g', gap, 'd', filter(docs, x -> false)), (a, x) -> if(x.tokens <= a.g, named_struct('g', a.g - x.tokens, 'd', array_append(a.d, x)), a)).d"
            found = lists.select(*of, F.expr(f"inline({greedy})")).drop("turn")
        found = cut(found)
        picked = found if picked is None else picked.unionByName(found)
        taken = found.groupBy(*of).agg(F.sum("tokens").alias("taken"))
        gap = cut(gap.join(taken, of, "left").select(*of, (F.col("gap") - F.coalesce("taken", F.lit(0))).alias("gap")).where("gap > 0"))
    return picked


def drawn_documents(draws: DataFrame) -> DataFrame:
    """mix_id, source, doc_id, tokens, n_used: one row per document of a mix."""
    return draws.groupBy("mix_id", "source", "doc_id", "tokens").agg(F.count(F.lit(1)).alias("n_used"))


def share_report(drawn: DataFrame, planned: DataFrame) -> DataFrame:
    """Target and reached shares per mix and source."""
    got = drawn.groupBy("mix_id", "source").agg(F.sum(F.col("tokens") * F.col("n_used")).alias("drawn_tokens"), F.count(F.lit(1)).alias("n_docs"), F.max("n_used").alias("most_used"))
    whole = F.sum("drawn_tokens").over(Window.partitionBy("mix_id"))
    joined = planned.join(got, ["mix_id", "source"], "left").fillna(0, ["drawn_tokens", "n_docs", "most_used", "largest_doc"])
    return joined.select(
        "mix_id", "source", "target_share", F.col("weight").alias("scaled_share"), "max_repeats", F.coalesce("stock", F.lit(0)).alias("stock_tokens"), F.coalesce(F.round("quota"), F.lit(0)).cast("bigint").alias("quota_tokens"),
        "drawn_tokens", "n_docs", "most_used", "largest_doc", F.try_divide(F.col("drawn_tokens"), whole).alias("reached_share"),
    )
