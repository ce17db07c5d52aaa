"""Golden tests of the row-level transforms (tiny_product, tiny_calendar)."""

import datetime as dt

from pyspark.sql import functions as F

from tillcast.functions import scalars as sc


def test_weight_to_grams_units_and_nulls(spark):
    df = spark.createDataFrame(
        [(1, 2.0, "pounds"), (2, 3.0, "ounces"), (3, 5.0, "grams"), (4, 1.0, None),
         (5, 1.0, "stone"), (6, None, "grams")],
        "ProductKey long, Weight double, WeightUnitMeasureID string")
    out = dict(df.select("ProductKey", sc.weight_to_grams(
        F.col("Weight"), F.col("WeightUnitMeasureID")).alias("g")).collect())
    assert out[1] == 2.0 * 453.592 and out[2] == 3.0 * 28.3495 and out[3] == 5.0
    assert out[4] is None and out[5] is None and out[6] is None


def test_stock_swap_and_promo_flag(spark):
    df = spark.createDataFrame([(1,), (2,), (3,), (None,)], "k long")
    got = [r[0] for r in df.select(sc.stock_swap(F.col("k"))).collect()]
    assert got == [3, 2, 1, None]
    flags = [r[0] for r in df.select(sc.promo_flag(F.col("k"))).collect()]
    assert flags == [1, 0, 0, 0]


def test_strip_and_fill(spark):
    df = spark.createDataFrame([(" a\t", "x"), ("\tb  \n", None), (None, "y")],
                               "BrandName string, DateKey string")
    out = sc.fill_na_label(sc.strip_strings(df, exclude=("DateKey",)), "BrandName")
    assert [r.BrandName for r in out.collect()] == ["a", "b", "N/A"]


def test_quarter_number_without_digit_is_null(spark):
    df = spark.createDataFrame([("Q1",), ("Q4",), ("none",), (None,)], "q string")
    assert [r[0] for r in df.select(sc.quarter_number(F.col("q"))).collect()] == [1, 4, None, None]


def test_impute_and_sanitize(spark):
    df = spark.createDataFrame([(None, None), (2, 1.5)], "ClassID long, Weight double")
    out = sc.impute_const(df, ["ClassID", "Weight"])
    assert out.collect()[0] == (0, 0.0)
    assert sc.sanitize_name("BrandName_N/A") == "BrandName_NA"
    assert sc.sanitize_name("A. Datum") == "A_Datum"


def test_calendar_parts(spark):
    from tillcast.functions.calendar import calendar_parts
    days = [dt.date(2001, 12, 31), dt.date(2000, 2, 29), dt.date(1999, 1, 3), dt.date(1998, 1, 1)]
    df = spark.createDataFrame([(d,) for d in days], "DateKey date")
    parts = calendar_parts("DateKey")
    rows = df.select(*[v.alias(k) for k, v in parts.items()]).collect()
    assert rows[0].CalendarDayOfWeekNumber == 1 and rows[0].CalendarWeekLabel == "Week 53"
    assert rows[0].CalendarYear == 2001 and rows[0].IsWorkDay == "WorkDay"
    assert rows[1].MonthNumber == 2 and rows[1].CalendarQuarterLabel == "Q1"
    assert rows[2].CalendarDayOfWeekNumber == 7 and rows[2].IsWorkDay == "WeekEnd"
    assert rows[2].CalendarWeekLabel == "Week 1"
    assert rows[3].CalendarDayOfWeekLabel == "Thursday"


def test_spine_and_facts(spark):
    from tillcast.functions.calendar import create_facts, date_spine
    spine = date_spine(spark, "1999-12-25", "2000-03-01")
    assert spine.count() == (dt.date(2000, 3, 1) - dt.date(1999, 12, 25)).days + 1
    facts = create_facts(spine)
    bad = facts.where(F.col("IsWorkDay_WeekEnd") + F.col("IsWorkDay_WorkDay") != 1).count()
    assert bad == 0
    r = facts.where(F.col("DateKey") == dt.date(2000, 1, 1)).first()
    assert abs(r.sin_MonthNumber - 0.5) < 1e-12 and r.IsWorkDay_WeekEnd == 1
