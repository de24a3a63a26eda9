import pytest

import oracle
from fieldspark.plans import problems, reference

CASES = {k: (m.QUERIES[k], s) for m in (problems, reference) for k, s in m.SQL.items()}


@pytest.fixture(scope="module")
def con(data):
    return oracle.connect(data)


@pytest.mark.parametrize("name", sorted(CASES))
def test_same_as_sql(spark, data, con, name):
    q, sql = CASES[name]
    oracle.assert_same(q(spark, data), con, sql)


@pytest.mark.parametrize("name", sorted(set(problems.QUERIES) | set(reference.QUERIES) - set(CASES)))
def test_runs_with_stable_schema(spark, data, name):
    q = {**problems.QUERIES, **reference.QUERIES}[name]
    df = q(spark, data)
    assert df.schema == q(spark, data).schema
    assert df.count() >= 0


@pytest.mark.parametrize("name", ["p1_found", "p3_found", "p5_found", "side_summary", "season_simulation", "bootstrap_margin"])
def test_partitioning_makes_no_difference(spark, data, name):
    q = {**problems.QUERIES, **reference.QUERIES}[name]
    one = sorted(map(str, q(spark, data).collect()))
    spark.conf.set("spark.sql.shuffle.partitions", "7")
    try:
        assert sorted(map(str, q(spark, data).collect())) == one
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
