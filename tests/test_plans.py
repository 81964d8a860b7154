"""Plans: filters and columns reach the scan, features of a call share one shuffle, no Python runs in batch queries."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from tallgrass.operators import windows
from tallgrass.plans import registry
from tallgrass.sources.tables import table, txn

SF = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_pushdown_and_pruning(spark):
    p = plan(table(spark, SF, "lineitem").where("l_quantity > 40").select("l_orderkey"))
    assert "PushedFilters: [IsNotNull(l_quantity), GreaterThan(l_quantity,40.0)]" in p
    assert "l_extendedprice" not in p


def test_rolling_features_share_a_shuffle(spark):
    p = plan(windows.rolling(txn(spark, SF), "entity_id", "amount"))
    assert p.count("Exchange hashpartitioning") == 1


def test_no_python_in_batch_queries(spark):
    for name in ("W1_rolling_window", "J1_asof_join", "P10_constraint_engine", "G43_distribution_report", "V10_calibration_tests", "T1_rank_actions"):
        p = plan(registry.queries()[name](spark, SF))
        assert "Python" not in p and "Pandas" not in p and "Arrow" not in p, name


def test_entry_without_text_operators(spark):
    import __spark_entry__

    assert len(__spark_entry__.queries()) >= 150
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())


def test_global_rank_numbers_rows_where_the_ranges_lie(spark):
    """Ranks as by one window, with only the wanted columns, and no second shuffle of the rows behind the ranges."""
    rows = spark.range(5000).withColumns({"x": F.pmod(F.xxhash64("id"), F.lit(700)), "y": F.lit("y")})
    found = windows.global_rank(rows, ["x", "id"], 7, keep=["id"])
    assert found.columns == ["id", "rank"]
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(__range" not in plan.split("BroadcastExchange")[0] and "SortMergeJoin" not in plan
    expected = rows.select("id", F.row_number().over(Window.orderBy("x", "id")).alias("rank"))
    assert found.exceptAll(expected).count() == 0 and found.count() == 5000
