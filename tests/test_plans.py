"""Plan shape: pushdown, size-checked broadcast with a fallback."""

from tests.conftest import SF001
from tillcast.plans.star import denorm_ml


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_small_dims_broadcast_and_range_pushdown(spark):
    df = denorm_ml(spark, SF001, min_date="1996-01-01", max_date="1996-12-31")
    text = df._jdf.queryExecution().explainString(
        spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    assert "BroadcastHashJoin" in text and "SortMergeJoin" not in text
    assert "GreaterThanOrEqual(l_shipdate,1996-01-01T00:00)" in text
    assert "LessThan(l_shipdate,1997-01-01T00:00)" in text


def test_large_dims_fall_back_to_sort_merge(spark):
    spark.conf.set("tillcast.broadcast.maxBytes", "1024")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        df = denorm_ml(spark, SF001)
        text = df._jdf.queryExecution().explainString(
            spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("simple"))
        assert "SortMergeJoin" in text
        assert df.count() == spark.read.parquet(f"{SF001}/lineitem.parquet").count()
    finally:
        spark.conf.unset("tillcast.broadcast.maxBytes")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_series_groups_are_preaggregated(spark):
    import datetime as dt
    from tillcast.operators import forecast as fc
    base = dt.date(2000, 1, 1)
    rows = [(base + dt.timedelta(days=i % 100), float(i % 7)) for i in range(3000)]
    df = spark.createDataFrame(rows, "DateKey date, SalesAmount double")
    out = fc.ar_forecast(df.selectExpr("*", "'a' AS k"), keys=["k"], order=fc.ArOrder(p=1), horizon=3).collect()
    assert len(out) == 3  # 100 daily points fitted, not 3000 rows


def _tables(df) -> set:
    import re
    return set(re.findall(r"/(\w+)\.parquet", _explained(df)))


def _explained(df) -> str:
    return df._jdf.queryExecution().explainString(
        df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))


def test_only_the_hops_that_the_columns_need(spark):
    import __spark_entry__ as E
    q = E.queries()
    for name in ("promo_flag", "daily", "cyclic_month", "date_range", "seasonalize_y_daily"):
        df = q[name](spark, SF001) if name in q else __import__("tillcast.plans.catalog", fromlist=["x"]).daily_series(spark, SF001)
        assert _tables(df) == {"lineitem"}, name
    assert _tables(q["stock_swap"](spark, SF001)) == {"lineitem", "part"}
    assert _tables(q["value_counts"](spark, SF001)) == {"lineitem", "orders", "customer"}


def test_small_dimensions_of_large_tables_are_broadcast(spark, monkeypatch):
    """With the row counts of a much larger scale, dimensions of a few distinct
    values are still joined without a shuffle of the fact on their keys."""
    from tillcast.plans.star import denorm_dashboard
    from tillcast.sources import standin as st
    real = st.counted_rows
    monkeypatch.setattr(st, "counted_rows", lambda s, d, name, what="", frame=None:
                        real(s, d, name, what, frame) if what else real(s, d, name) * 100_000)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        text = _explained(denorm_dashboard(spark, SF001))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    import re
    merged = set(re.findall(r"SortMergeJoin[^\n]*\nLeft keys \[1\]: \[(\w+)#", text))
    assert not merged & {"channelKey", "ChannelKey", "ProductSubcategoryKey", "ProductCategoryKey", "p_type"}, merged
    assert "l_orderkey" in merged   # the large hops are


def test_star_over_given_tables(spark):
    from tillcast.operators.joins import DimSpec, build_star
    fact = spark.createDataFrame([(1, 10, 2.0), (2, 11, 3.0), (3, None, 4.0)], "id int, shop int, amount double")
    shop = spark.createDataFrame([(10, 7, "x"), (11, 8, "y")], "shop_id int, town int, label string")
    town = spark.createDataFrame([(7, "T7"), (8, "T8")], "town int, name string")
    dims = [DimSpec("shop", shop, "shop", ["town", "label"], dim_key="shop_id"), DimSpec("town", town, "town", ["name"])]
    out = build_star(fact, dims, ["id", "name"])
    assert sorted(map(tuple, out.collect())) == [(1, "T7"), (2, "T8"), (3, None)]
    assert build_star(fact, dims).columns == ["id", "shop", "amount", "town", "label", "name"]
    assert "Join" not in _plan(build_star(fact, dims, ["id", "amount"]))


def test_grains_are_rolled_up_from_days(spark):
    """The rows are aggregated once; grouping sets expand days only."""
    from tillcast.operators import seasonal as sea
    rows = [(f"2000-01-{1 + i % 28:02d}", 2000, f"Week {i % 4}", 1, "Q1", float(i), 1 + i % 3) for i in range(90)]
    df = spark.createDataFrame(rows, "d string, CalendarYear int, CalendarWeekLabel string, MonthNumber int, CalendarQuarterLabel string, SalesAmount double, SalesQuantity long")
    df = df.selectExpr("to_date(d) AS DateKey", "*").drop("d")
    out = sea.multi_grain(df, {"SalesAmount": "mean", "SalesQuantity": "sum"})
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Aggregate [") == 2 and plan.index("Expand") < plan.rindex("Aggregate [")
    year = [r for r in out.collect() if r.grain == "yearly"]
    assert len(year) == 1 and year[0].SalesAmount == sum(range(90)) / 90 and year[0].SalesQuantity == 180


def test_broadcast_counts_a_frame_without_a_bound(spark):
    from tillcast.operators.joins import checked_broadcast, row_width
    df = spark.range(1000).selectExpr("id % 10 AS k")
    hinted = lambda d: "ResolvedHint" in d._jdf.queryExecution().analyzed().toString()
    assert hinted(checked_broadcast(df, max_bytes=1000 * row_width(df)))
    assert not hinted(checked_broadcast(df, max_bytes=999 * row_width(df)))
