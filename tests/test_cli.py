from fieldspark.__main__ import main


def test_commands(spark, data, tmp_path, capsys):
    main(["list"])
    assert "p1_found" in capsys.readouterr().out
    main(["run", "week_cutoffs", "--data", data, "--out", f"{tmp_path}/q"])
    assert spark.read.parquet(f"{tmp_path}/q").columns == ["season", "week", "cutoff"]
    season = spark.read.parquet(f"{data}/summaries_input.parquet").where("epa is not null").agg({"season": "max"}).first()[0]
    years = ["-s", str(season), "-e", str(season), "--data", data, "--out", f"{tmp_path}/t"]
    main(["summaries", *years])
    assert spark.read.parquet(f"{tmp_path}/t/team_summaries/parquet").where(f"season = {season}").count() > 0
    # without a week asked for, plays of unknown weeks count too
    from fieldspark.operators import plays as P
    from fieldspark.plans import reference

    played = P.scrimmage(reference.all_plays(spark, data)).where(f"season = {season} and pos_team_id is not null").count()
    assert spark.read.parquet(f"{tmp_path}/t/team_summaries/parquet").where(f"season = {season} and side = 'off' and phase = 'all'").agg({"plays": "sum"}).first()[0] == played
    main(["summaries", *years, "--through-week", "3"])
    main(["backtest", "--data", data])
    assert "mae" in capsys.readouterr().out
