"""Queries of the training-data operators, each over its whole tables, with SQL where SQL can say it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldspark.llm import leak, mix, split, topn
from fieldspark.llm.tokens import count_column
from fieldspark.session import table


# ---------------------------------------------------------------- 2
def p2_found(spark: SparkSession, d: str) -> DataFrame:
    best = topn.top_items(table(spark, d, "cfb_ratings_2025"), "run_id", "draw_no", "rating_id", "adj_net", "net_rank", 5)
    return best.select(F.col("g").alias("run_id"), "pos", F.col("id").alias("rating_id"))


# ---------------------------------------------------------------- 8
def _windows(spark: SparkSession, d: str) -> DataFrame:
    return leak.leaked_windows(table(spark, d, "documents").select("doc_id", "text"), table(spark, d, "eval_items").select("item_id", "text"))


def p8_found(spark: SparkSession, d: str) -> DataFrame:
    return _windows(spark, d).where("exact").select("doc_id", "item_id").distinct()


def p8_leaks(spark: SparkSession, d: str) -> DataFrame:
    return leak.leaks(_windows(spark, d))


# ---------------------------------------------------------------- 9
def _sized(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents").where("source is not null and text is not null")
    return docs.select("doc_id", "source", count_column(F.col("text")).alias("tokens"))


def p9_mixture(spark: SparkSession, d: str) -> DataFrame:
    draws, _ = mix.mix(_sized(spark, d), table(spark, d, "source_mix"))
    return mix.drawn_documents(draws)


def p9_shares(spark: SparkSession, d: str) -> DataFrame:
    draws, planned = mix.mix(_sized(spark, d), table(spark, d, "source_mix"))
    return mix.share_report(mix.drawn_documents(draws), planned)


# ---------------------------------------------------------------- 10
def p10_found(spark: SparkSession, d: str) -> DataFrame:
    pieces = split.split_documents(table(spark, d, "documents"), with_text=False, sized=False)
    return pieces.where("n_pieces > 1 and piece_no = 0").select("doc_id").distinct()


def p10_pieces(spark: SparkSession, d: str) -> DataFrame:
    return split.split_documents(table(spark, d, "documents"))


QUERIES = {
    "p2_found": p2_found,
    "p8_found": p8_found, "p8_leaks": p8_leaks,
    "p9_mixture": p9_mixture, "p9_shares": p9_shares,
    "p10_found": p10_found, "p10_pieces": p10_pieces,
}

#: Words of a text for SQL: enough for the spellings that occur in the tables (the operator knows more).
_WORDS = r"""regexp_extract_all(lower(translate(nfc_normalize(regexp_replace(regexp_replace(regexp_replace(text, '&[a-z]+;', ' ', 'g'), '</?[A-Za-z][^<>]*>', ' ', 'g'), '[\x{00AD}\x{200B}-\x{200D}\x{2060}\x{FEFF}]', '', 'g')), '０１２３４５６７８９', '0123456789')), '[\p{L}\p{N}\p{M}]+')"""

SQL = {
    "p8_found": f"""
with d as (select doc_id, {_WORDS} w from documents where text is not null), i as (select item_id, {_WORDS} w from eval_items where text is not null),
dg as (select doc_id, array_to_string(w[p:p + 11], ' ') g from (select doc_id, w, unnest(range(1, len(w) - 10)) p from d)), ig as (select distinct item_id, array_to_string(w[p:p + 11], ' ') g from (select item_id, w, unnest(range(1, len(w) - 10)) p from i))
select distinct doc_id, item_id from dg join ig using (g)""",
    "p2_found": """
with one as (select run_id, min(rating_id) rating_id, arg_min(struct_pack(a := adj_net, r := net_rank), rating_id) filter (adj_net is not null and not isnan(adj_net)) b
  from cfb_ratings_2025 where run_id is not null group by run_id, draw_no, case when draw_no is null then rating_id end)
select run_id, row_number() over (partition by run_id order by b.a desc, b.r asc nulls last, rating_id) pos, rating_id from one where b is not null qualify pos <= 5""",
}
