"""Attributes as known at event time.

Events and versions are co-grouped by entity (entities are packed into hashed groups of bounded
size, so Python is entered per group and not per entity). Inside a group a vectorised binary
search finds, per event, the latest version valid and recorded by the event's time. An entity that
alone exceeds a group is cut into ranges of time that hold about a group's rows, events and versions
counted together, however many ranges that takes; what earlier ranges know is carried in as one best
version per validity, and events of one instant too many for a group are salted. Packs of small
entities hold a group's rows on average.

Defined results
- event with NULL entity, validity bound or time: no version (dropped). Versions with NULL entity, validity or recording time are never known.
- among the known versions: highest validity, then latest recording, then smallest id. Repeated rows give the same answer.
- either side empty: no rows. Clashing column names cannot matter: only the named columns are used.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fieldspark.operators.prefix import ordered_buckets
from fieldspark.session import broadcast_if_small, cut

GROUP_ROWS = 200_000
_EV, _VE = "ev_id bigint, bound bigint, at timestamp_ntz", "valid bigint, known timestamp_ntz, version_id bigint"


def _codes(left: pd.DataFrame, right: pd.DataFrame, keys: list[str]) -> tuple[np.ndarray, np.ndarray]:
    code = np.zeros(len(left) + len(right), dtype=np.int64)
    for k in keys:
        _, inv = np.unique(np.concatenate([left[k].to_numpy(), right[k].to_numpy()]), return_inverse=True)
        _, code = np.unique(code * (inv.max() + 1 if len(inv) else 1) + inv, return_inverse=True)
    return code[: len(left)], code[len(left) :]


def search(ev_ent, ev_bound, ev_at, v_ent, v_valid, v_known, v_id) -> np.ndarray:
    """Index into the versions' arrays per event, -1 if none is known. All arrays are integers.

    A version counts if its validity is below the event's bound and it was recorded at or before
    the event's time.
    """
    none = np.full(len(ev_ent), -1, dtype=np.int64)
    if not len(v_ent) or not len(ev_ent):
        return none
    order = np.lexsort((-v_id, v_known, v_valid, v_ent))
    ent, valid, known = v_ent[order], v_valid[order], v_known[order]
    valids, knowns = np.unique(valid), np.unique(known)
    width = len(valids) + 1
    level_of = ent * width + np.searchsorted(valids, valid)
    levels, start = np.unique(level_of, return_index=True)
    first_known = known[start]  # each level's earliest recording
    top = np.searchsorted(levels, ev_ent * width + np.searchsorted(valids, ev_bound, "left"), "left") - 1
    floor = np.searchsorted(levels, ev_ent * width, "left")

    # largest level at or below `top` whose earliest recording is not after the event: descend over block minima
    big = np.iinfo(np.int64).max
    table = [first_known]
    step = 1
    while step < len(levels):
        low = np.full(len(levels), big)
        low[step:] = table[-1][:-step]
        table.append(np.minimum(table[-1], low))
        step *= 2
    cur = top.copy()
    for j in range(len(table) - 1, -1, -1):
        live = cur >= 0
        skip = np.zeros(len(cur), dtype=bool)
        skip[live] = table[j][cur[live]] > ev_at[live]
        cur[skip] -= 1 << j
    ok = (cur >= floor) & (cur >= 0)
    if not ok.any():
        return none
    # latest recording inside the level
    span = len(knowns) + 1
    level_idx = np.repeat(np.arange(len(levels)), np.diff(np.append(start, len(ent))))
    keys = level_idx * span + np.searchsorted(knowns, known) + 1
    want = cur[ok] * span + np.searchsorted(knowns, ev_at[ok], "right")
    pos = np.searchsorted(keys, want, "right") - 1
    out = none
    out[ok] = order[pos]
    return out


def _match(keys: list[str]):
    def run(events: pd.DataFrame, versions: pd.DataFrame) -> pd.DataFrame:
        e, v = _codes(events, versions, keys)
        us = lambda s: s.to_numpy(dtype="datetime64[us]").astype(np.int64)
        idx = search(e, events["bound"].to_numpy(np.int64), us(events["at"]), v, versions["valid"].to_numpy(np.int64), us(versions["known"]), versions["version_id"].to_numpy(np.int64))
        hit = idx >= 0
        out = events.loc[hit, [*keys, "ev_id"]].copy()
        out["version_id"] = versions["version_id"].to_numpy()[idx[hit]]
        return out

    return run


def known_at(events: DataFrame, versions: DataFrame, keys: list[str], group_rows: int = GROUP_ROWS) -> DataFrame:
    """keys..., ev_id, version_id for every event that knows a version.

    events: keys..., ev_id, bound (validity must be below it), at. versions: keys..., valid, known, version_id.
    """
    ev = events.select(*keys, F.col("ev_id").cast("bigint"), F.col("bound").cast("bigint"), F.col("at").cast("timestamp_ntz")).dropna()
    # of versions that differ in the id only, the smallest answers for all
    ve = versions.select(*keys, F.col("valid").cast("bigint"), F.col("known").cast("timestamp_ntz"), "version_id").dropna()
    ve = ve.groupBy(*keys, "valid", "known").agg(F.min("version_id").cast("bigint").alias("version_id"))

    sizes = ev.groupBy(*keys).agg(F.count(F.lit(1)).alias("e"), F.lit(0).cast("bigint").alias("v")).unionByName(
        ve.groupBy(*keys).agg(F.lit(0).cast("bigint").alias("e"), F.count(F.lit(1)).alias("v"))
    )
    sizes = sizes.groupBy(*keys).agg(F.sum("e").alias("e"), F.sum("v").alias("v"))
    total = sizes.agg(F.sum(F.col("e") + F.col("v")), F.max(F.col("e") + F.col("v"))).first()
    packs = max(1, -(-int(total[0] or 0) // group_rows))
    cold = F.concat(F.lit("c"), F.pmod(F.xxhash64(*keys), F.lit(packs)).cast("string"))
    if (total[1] or 0) <= group_rows:
        ev, ve = ev.withColumn("g", cold), ve.withColumn("g", cold)
    else:
        ev, ve = _split_hot(ev, ve, sizes, keys, group_rows, cold)
    types = dict(ev.dtypes)
    schema = ", ".join([*(f"`{k}` {types[k]}" for k in keys), "ev_id bigint", "version_id bigint"])
    return ev.groupBy("g").cogroup(ve.groupBy("g")).applyInPandas(_match(keys), schema)


def _split_hot(ev: DataFrame, ve: DataFrame, sizes: DataFrame, keys: list[str], group_rows: int, cold) -> tuple[DataFrame, DataFrame]:
    hot = broadcast_if_small(sizes.where(F.col("e") + F.col("v") > group_rows).select(*keys))
    e_cold, v_cold = (d.join(hot, keys, "left_anti").withColumn("g", cold) for d in (ev, ve))
    blank = lambda d, c: F.lit(None).cast(dict(d.dtypes)[c]).alias(c)
    own_e, own_v = ["ev_id", "bound", "at"], ["valid", "known", "version_id"]
    both = ev.join(hot, keys, "left_semi").select(*keys, F.col("at").alias("time"), F.lit(1).alias("is_ev"), *own_e, *[blank(ve, c) for c in own_v]).unionByName(
        ve.join(hot, keys, "left_semi").select(*keys, F.col("known").alias("time"), F.lit(0).alias("is_ev"), *[blank(ev, c) for c in own_e], *own_v)
    )
    ranged, _ = ordered_buckets(cut(both), keys, ["time"], group_rows)
    per = ranged.groupBy(*keys, "bucket").agg(F.sum("is_ev").alias("n_ev")).withColumn("salts", F.greatest(F.lit(1), F.ceil(F.col("n_ev") / group_rows)).cast("int")).drop("n_ev")
    per = cut(per)
    name = lambda salt: F.concat_ws(":", F.lit("h"), F.xxhash64(*keys).cast("string"), F.col("bucket").cast("string"), salt.cast("string"))
    e_hot = ranged.where("is_ev = 1").join(per, [*keys, "bucket"]).withColumn("g", name(F.pmod(F.xxhash64("ev_id"), F.col("salts"))))
    v_hot = ranged.where("is_ev = 0").select(*keys, "bucket", *own_v)
    # what earlier ranges know: one best version per validity, kept until a later range has a newer one
    best = v_hot.groupBy(*keys, "valid", "bucket").agg(F.max(F.struct("known", (-F.col("version_id")).alias("neg"))).alias("m"))
    last = per.groupBy(*keys).agg(F.max("bucket").alias("last"))
    after = Window.partitionBy(*keys, "valid").orderBy("bucket")
    carried = best.join(last, keys).withColumn("until", F.coalesce(F.lead("bucket").over(after), F.col("last"))).where("until > bucket").withColumn("bucket", F.explode(F.expr("sequence(bucket + 1, until)")))
    carried = carried.select(*keys, "bucket", "valid", F.col("m.known").alias("known"), (-F.col("m.neg")).alias("version_id"))
    every = v_hot.unionByName(carried).join(per, [*keys, "bucket"])
    every = every.withColumn("salt", F.explode(F.expr("sequence(0, salts - 1)"))).withColumn("g", name(F.col("salt")))
    ec, vc = [*ev.columns, "g"], [*ve.columns, "g"]
    return e_cold.select(*ec).unionByName(e_hot.select(*ec)), v_cold.select(*vc).unionByName(every.select(*vc))
