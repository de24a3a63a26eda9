"""Command line: ``python -m fieldspark {list,run,summaries,backtest} ...``"""

from __future__ import annotations

import argparse

from pyspark.sql import functions as F

from fieldspark.operators import models, plays, summaries
from fieldspark.plans import problems, reference
from fieldspark.session import build_session, ship, table
from fieldspark.sources import sinks


def _queries() -> dict:
    return {**problems.QUERIES, **reference.QUERIES}


def _list(_: argparse.Namespace) -> None:
    print("\n".join(sorted(_queries())))


def _run(a: argparse.Namespace) -> None:
    spark = build_session("fieldspark", a.master)
    ship(spark)
    df = _queries()[a.name](spark, a.data)
    if a.out:
        df.write.mode("overwrite").parquet(a.out)
    else:
        df.show(a.limit, False)


def _summaries(a: argparse.Namespace) -> None:
    """Season summaries of the given seasons, or a snapshot through a week (kept apart, never published)."""
    spark = build_session("fieldspark", a.master)
    ship(spark)
    p = plays.with_measures(plays.scrimmage(plays.latest_delivery(table(spark, a.data, "summaries_input"))))
    for season in range(a.start, a.end + 1):
        part = p.where(F.col("season") == season)
        if a.through_week:
            part = part.where(F.col("week") <= a.through_week)
        s = summaries.side_summaries(part).drop("season")
        if a.dry_run:
            print(season, s.count(), "rows")
        elif a.through_week:
            sinks.write_snapshot(s.withColumn("season", F.lit(season)), a.out, f"team_summaries_{season}", a.through_week)
        else:
            print(season, sinks.write_season(s, a.out, "team_summaries", season, csv=a.csv), "rows")


def _backtest(a: argparse.Namespace) -> None:
    """Out-of-fold error of a model head over the games, season by season."""
    spark = build_session("fieldspark", a.master)
    ship(spark)
    g = reference.game_margins(spark, a.data).where("margin is not null")
    g = g.select("game_id", "season", F.col("week").cast("double").alias("week"), F.coalesce("neutral_site", F.lit(False)).cast("double").alias("neutral"), F.col("margin").cast("double").alias("margin"))
    out = models.folds(g, "season", models.HEADS[a.head], ["week", "neutral"], "margin", walk_forward=not a.leave_one_out)
    out.groupBy("season").agg(F.count(F.lit(1)).alias("games"), F.avg(F.abs(F.col("margin") - F.col("pred"))).alias("mae")).orderBy("season").show()


def main(args: list[str] | None = None) -> None:
    top = argparse.ArgumentParser(prog="fieldspark", description=__doc__)
    top.add_argument("--master", help="Spark master (default: the cluster's, or the environment's)")
    sub = top.add_subparsers(required=True)
    sub.add_parser("list", help="names of the queries").set_defaults(do=_list)
    run = sub.add_parser("run", help="one query over a folder of tables")
    run.add_argument("name", choices=sorted(_queries()))
    run.add_argument("--data", required=True)
    run.add_argument("--out", help="write Parquet there instead of showing rows")
    run.add_argument("--limit", type=int, default=20, help="rows to show")
    run.set_defaults(do=_run)
    s = sub.add_parser("summaries", help="two-sided season summaries")
    s.add_argument("-s", "--start", type=int, required=True)
    s.add_argument("-e", "--end", type=int, required=True)
    s.add_argument("--data", required=True)
    s.add_argument("--out", default="tables")
    s.add_argument("--through-week", type=int)
    s.add_argument("--csv", action="store_true")
    s.add_argument("--dry-run", action="store_true")
    s.set_defaults(do=_summaries)
    b = sub.add_parser("backtest", help="walk-forward error of a model head")
    b.add_argument("--data", required=True)
    b.add_argument("--head", choices=["ridge", "gbt"], default="ridge")
    b.add_argument("--leave-one-out", action="store_true")
    b.set_defaults(do=_backtest)
    a = top.parse_args(args)
    a.do(a)


if __name__ == "__main__":
    main()
