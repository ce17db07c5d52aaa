"""DuckDB SQL twins of the registered queries (same names, same output
column names)."""

from __future__ import annotations

from tillcast.plans.oracle_base import ML_COLS, date_where, sample_where, with_sales

ORACLE: dict[str, str] = {}

DASH_COLS = """SalesKey, DateKey, channelKey AS ChannelKey, StoreKey, ProductKey, PromotionKey,
  UnitCost, UnitPrice, SalesQuantity, ReturnQuantity, ReturnAmount, DiscountQuantity,
  DiscountAmount, TotalCost, SalesAmount, ChannelName, PromotionName, PromotionType,
  CalendarYear, CalendarQuarterLabel, CalendarMonthLabel, CalendarDayOfWeekLabel, MonthNumber,
  CalendarDayOfWeekNumber, ProductName, ProductSubcategoryKey, ProductSubcategoryName,
  ProductCategoryKey, ProductCategoryName, GeographyKey, StoreType, StoreName, ContinentName"""

R6 = "ROUND({0}, 6)"


def sql(name: str, text: str) -> None:
    ORACLE[name] = text


sql("denorm_ml", with_sales(f"SELECT {ML_COLS} FROM sales"))
sql("denorm_dashboard", with_sales(f"SELECT {DASH_COLS} FROM sales"))
sql("join_bushy", with_sales(
    "SELECT SalesKey, DateKey, StoreKey, SalesAmount, StoreName, RegionCountryName, "
    "ContinentName FROM sales"))
_YEAR = date_where("1996-01-01", "1996-12-31")
sql("get_ml", with_sales(f"SELECT {ML_COLS} FROM sales", where=_YEAR))
sql("get_dashboard", with_sales(f"SELECT {DASH_COLS} FROM sales", where=_YEAR))
sql("join_promotion", with_sales("SELECT SalesKey, PromotionKey, DiscountPercent, PromotionName, PromotionType FROM sales"))
sql("join_date", with_sales("SELECT SalesKey, DateKey, CalendarYear, CalendarQuarterLabel, CalendarWeekLabel, MonthNumber, "
                            "CalendarDayOfWeekNumber, IsWorkDay FROM sales"))
sql("rename_column", with_sales("SELECT SalesKey, SalesAmount AS Revenue FROM sales"))
sql("parse_date", with_sales("SELECT SalesKey, DateKey FROM sales"))
sql("date_range", with_sales("SELECT SalesKey, DateKey, SalesAmount FROM sales",
                             where=date_where("1996-01-01", "1996-12-31")))
sql("sample_rows", with_sales("SELECT SalesKey, DateKey, SalesAmount FROM sales",
                              where=sample_where(0.5, 42)))
sql("select_facts", with_sales(
    "SELECT DateKey, CalendarQuarterLabel, CalendarWeekLabel, IsWorkDay, MonthNumber, "
    "CalendarDayOfWeekNumber FROM sales"))
sql("clean_outliers", with_sales(
    "SELECT SalesKey, DateKey, SalesAmount FROM sales "
    "WHERE SalesAmount <= 2.5 * (SELECT stddev_samp(SalesAmount) FROM sales)"))
sql("daily_revenue", with_sales("""
SELECT DateKey,
  CAST(SUM(CAST(SalesAmount AS DECIMAL(18,4))) AS DOUBLE) AS SalesAmount,
  CAST(SUM(SalesQuantity) AS BIGINT) AS SalesQuantity,
  CAST(SUM(CAST(DiscountAmount AS DECIMAL(18,4))) AS DOUBLE) AS DiscountAmount,
  ROUND(AVG(CASE WHEN IsWorkDay = 'WorkDay' THEN 1.0 ELSE 0.0 END), 6) AS workday_share,
  ROUND(arg_min(sin(2 * pi() * MonthNumber / 12.0), DateKey), 6) AS sin_MonthNumber,
  COUNT(*) AS n_sales
FROM sales
WHERE SalesAmount <= 2.5 * (SELECT stddev_samp(SalesAmount) FROM sales)
GROUP BY DateKey""", where=date_where("1996-01-01", "1996-12-31")))


# ------------------------------------------------------------------ scalars
from tillcast.plans import oracle_values as V  # noqa: E402
from tillcast.plans import oracle_features as OF  # noqa: E402

_IMP = ", ".join(f"coalesce({c}, 0) AS {c}" for c in V.IMPUTE_ZERO)
sql("impute_const", with_sales(f"SELECT SalesKey, {_IMP} FROM sales"))
sql("fill_na_label", with_sales("SELECT SalesKey, coalesce(BrandName, 'N/A') AS BrandName "
                                "FROM sales"))
_T = "trim({0}, " + OF.WS + ") AS {0}"
sql("strip_strings", with_sales("SELECT SalesKey, " + ", ".join(_T.format(c) for c in (
    "BrandName", "StoreType", "CityName", "WeightUnitMeasureID", "IsWorkDay")) + " FROM sales"))
sql("promo_flag", with_sales("SELECT SalesKey, CASE WHEN PromotionKey = 1 THEN 1 ELSE 0 END "
                             "AS PromotionKey FROM sales"))
sql("stock_swap", with_sales("SELECT SalesKey, CASE StockTypeID WHEN 1 THEN 3 WHEN 3 THEN 1 "
                             "ELSE StockTypeID END AS StockTypeID FROM sales"))
sql("weight_to_grams", with_sales(
    "SELECT SalesKey, ROUND(Weight * CASE WeightUnitMeasureID WHEN 'pounds' THEN 453.592 "
    "WHEN 'ounces' THEN 28.3495 WHEN 'grams' THEN 1.0 END, 6) AS Weight_grams FROM sales"))
sql("quarter_number", with_sales(
    "SELECT SalesKey, TRY_CAST(regexp_extract(CalendarQuarterLabel, '(\\d)', 1) AS INTEGER) "
    "AS quarter FROM sales"))
for _name, _expr, _p, _col in (
        ("cyclic_month", "MonthNumber", 12, "MonthNumber"),
        ("cyclic_dow", "CalendarDayOfWeekNumber", 7, "CalendarDayOfWeekNumber"),
        ("cyclic_quarter", "CAST(regexp_extract(CalendarQuarterLabel, '(\\d)', 1) AS INTEGER)", 4,
         "CalendarQuarterLabel")):
    sql(_name, with_sales(
        f"SELECT SalesKey, ROUND(sin(2 * pi() * {_expr} / {_p}.0), 6) AS sin_{_col}, "
        f"ROUND(cos(2 * pi() * {_expr} / {_p}.0), 6) AS cos_{_col} FROM sales"))
_ROUNDED = {"Weight_grams", "sin_MonthNumber", "cos_MonthNumber", "sin_CalendarDayOfWeekNumber",
            "cos_CalendarDayOfWeekNumber", "sin_CalendarQuarterLabel", "cos_CalendarQuarterLabel"}
sql("prepare_rows", with_sales("SELECT * REPLACE (" + ", ".join(f"{R6.format(c)} AS {c}" for c in sorted(_ROUNDED)) + ") FROM prep",
                               extra_ctes=OF.PREP))
sql("date_spine", with_sales(
    "SELECT CAST(d AS DATE) AS DateKey FROM (SELECT min(DateKey) AS lo, max(DateKey) AS hi "
    "FROM sales) b, generate_series(b.lo, b.hi, INTERVAL 1 DAY) g(d)"))
sql("create_facts", with_sales(
    "SELECT DateKey, CASE WHEN isodow(DateKey) > 5 THEN 1 ELSE 0 END AS IsWorkDay_WeekEnd, "
    "CASE WHEN isodow(DateKey) <= 5 THEN 1 ELSE 0 END AS IsWorkDay_WorkDay, "
    "ROUND(sin(2 * pi() * month(DateKey) / 12.0), 6) AS sin_MonthNumber, "
    "ROUND(cos(2 * pi() * month(DateKey) / 12.0), 6) AS cos_MonthNumber, "
    "ROUND(sin(2 * pi() * isodow(DateKey) / 7.0), 6) AS sin_CalendarDayOfWeekNumber, "
    "ROUND(cos(2 * pi() * isodow(DateKey) / 7.0), 6) AS cos_CalendarDayOfWeekNumber, "
    "ROUND(sin(2 * pi() * quarter(DateKey) / 4.0), 6) AS sin_CalendarQuarterLabel, "
    "ROUND(cos(2 * pi() * quarter(DateKey) / 4.0), 6) AS cos_CalendarQuarterLabel "
    "FROM (SELECT CAST(d AS DATE) AS DateKey FROM (SELECT min(DateKey) AS lo, max(DateKey) AS hi "
    "FROM sales) b, generate_series(b.lo, b.hi, INTERVAL 1 DAY) g(d)) s"))
sql("drop_nulls", with_sales(
    f"SELECT {ML_COLS} FROM sales WHERE " + " AND ".join(
        f"{c} IS NOT NULL" for c in V.ML)))
sql("nonzero_filter", with_sales("SELECT SalesKey, ReturnAmount FROM sales "
                                 "WHERE ReturnAmount <> 0"))
sql("threshold_count", with_sales(
    "SELECT " + ", ".join(f"count({c}) AS {c}" for c in V.ML) + " FROM sales WHERE SalesAmount >= 90000.0"))
sql("select_numeric", with_sales("SELECT " + ", ".join(V.NUMERIC) + " FROM sales"))
sql("key_value_filter", with_sales(
    "SELECT SalesKey, DateKey, SalesAmount FROM sales WHERE StoreType = 'BUILDING' "
    "AND channelKey = 2"))

# ------------------------------------------------------------------ encoders
_SCALED = ", ".join(
    f"ROUND({OF.scaled_expr(c)}, 6) AS {'CalendarYear_scaled' if c == 'CalendarYear' else c}"
    for c in V.ROBUST_SCALE)
sql("robust_scale", with_sales(f"SELECT SalesKey, {_SCALED} FROM prep, rstats",
                               extra_ctes=OF.PREP + ",\n" + OF._stats_cte()))
sql("one_hot", with_sales("SELECT SalesKey, " + ", ".join(OF.onehot_exprs()) + " FROM prep",
                          extra_ctes=OF.PREP))
sql("label_encode", with_sales(
    "SELECT prep.SalesKey, "
    + ", ".join(f"CAST(CASE WHEN prep.{c} IS NULL THEN (SELECT count(*) FROM lab_{c}) "
                f"ELSE lab_{c}.code END AS INTEGER) AS {c}" for c in V.LABELS)
    + " FROM prep " + " ".join(f"LEFT JOIN lab_{c} ON prep.{c} = lab_{c}.v"
                               for c in V.LABELS),
    extra_ctes=OF.PREP + ",\n" + OF.label_ctes()))
sql("simple_preprocess", with_sales(
    "SELECT " + ", ".join(
        f"ROUND((CAST({c} AS DOUBLE) - {c}__m) / CASE WHEN {c}__i = 0 THEN 1.0 ELSE {c}__i END, 6) AS {c}"
        if c in V.NUMERIC else c for c in V.ML)
    + " FROM sales, (SELECT "
    + ", ".join(f"quantile_cont({c}, 0.5) AS {c}__m, quantile_cont({c}, 0.75) - "
                f"quantile_cont({c}, 0.25) AS {c}__i" for c in V.NUMERIC) + " FROM sales) st"))
sql("one_hot_ignore", with_sales(
    "SELECT SalesKey, " + ", ".join(
        f"CAST(CASE WHEN {c} = '{v}' THEN 1.0 ELSE 0.0 END AS DOUBLE) AS \"{V.column_name(c, v)}\""
        for c in ("BrandName", "StoreType") for v in OF.FEW_CATEGORIES[c]) + " FROM prep", extra_ctes=OF.PREP))
sql("one_hot_long", with_sales(" UNION ALL ".join(
    f"SELECT SalesKey, '{c}' AS \"column\", {c} AS category FROM sales" for c in ("BrandName", "CityName"))))

# ------------------------------------------------------------- grain aggregates
for _g in V.GRAIN_KEYS:
    sql(f"seasonalize_{_g}", with_sales(OF.grain_select(_g),
                                        extra_ctes=OF.features_ctes()))
    _keys = ", ".join(V.GRAIN_KEYS[_g])
    _nn = " AND ".join(f"{k} IS NOT NULL" for k in V.GRAIN_KEYS[_g])
    sql(f"seasonalize_y_{_g}", with_sales(
        f"SELECT {_keys}, CAST(coalesce(SUM(CAST(SalesAmount AS DECIMAL(18,4))), 0) AS DOUBLE) "
        f"AS SalesAmount FROM sales WHERE {_nn} GROUP BY {_keys}"))


def _simple_aggs(full: bool) -> str:
    money = {"UnitCost", "ReturnAmount", "DiscountAmount", "TotalCost", "SalesAmount",
             "DiscountPercent", "SellingAreaSize", "UnitPrice"}
    spec = {"UnitCost": "mean", "UnitPrice": "mean", "ReturnQuantity": "sum",
            "ReturnAmount": "sum", "DiscountQuantity": "sum", "DiscountAmount": "sum",
            "TotalCost": "sum", "SalesQuantity": "sum", "SalesAmount": "sum"}
    if full:
        spec.update({"DiscountPercent": "mean", "IsWorkDay": "mean", "Weight": "sum",
                     "EmployeeCount": "mean", "SellingAreaSize": "mean"})
    parts = []
    for c, how in spec.items():
        v = c
        if c == "IsWorkDay":
            v = "CASE WHEN IsWorkDay = 'WorkDay' THEN 1.0 WHEN IsWorkDay IS NOT NULL THEN 0.0 END"
        if c in money:
            dv = (f"CAST({v} AS DECIMAL(28,10))" if c == "UnitPrice"
                  else f"CAST({v} AS DECIMAL(18,4))")
            parts.append(f"CAST(SUM({dv}) AS DOUBLE) / COUNT({v}) AS {c}" if how == "mean"
                         else f"CAST(coalesce(SUM({dv}), 0) AS DOUBLE) AS {c}")
        elif how == "mean":
            parts.append(f"ROUND(AVG({v}), 6) AS {c}")
        elif c in ("ReturnQuantity", "DiscountQuantity", "SalesQuantity"):
            parts.append(f"CAST(coalesce(SUM({v}), 0) AS BIGINT) AS {c}")
        else:
            parts.append(f"ROUND(coalesce(SUM({v}), 0), 6) AS {c}")
    return ", ".join(parts)


for _g in V.GRAIN_KEYS:
    _keys = ", ".join(V.GRAIN_KEYS[_g])
    _nn = " AND ".join(f"{k} IS NOT NULL" for k in V.GRAIN_KEYS[_g])
    sql(f"seasonal_simple_{_g}", with_sales(
        f"SELECT {_keys}, {_simple_aggs(False)} FROM sales WHERE {_nn} GROUP BY {_keys}"))
sql("seasonal_full_daily", with_sales(
    f"SELECT DateKey, {_simple_aggs(True)} FROM sales WHERE DateKey IS NOT NULL GROUP BY DateKey"))

_GRAIN_CASE = ("CASE grouping(DateKey, CalendarYear, CalendarWeekLabel, MonthNumber, "
               "CalendarQuarterLabel) WHEN 15 THEN 'daily' WHEN 19 THEN 'weekly' "
               "WHEN 21 THEN 'monthly' WHEN 22 THEN 'quarterly' WHEN 23 THEN 'yearly' END")
sql("multi_grain", with_sales(
    f"SELECT DateKey, CalendarYear, CalendarWeekLabel, MonthNumber, CalendarQuarterLabel, "
    f"{_simple_aggs(False)}, {_GRAIN_CASE} AS grain FROM sales "
    "WHERE DateKey IS NOT NULL AND CalendarYear IS NOT NULL "
    "GROUP BY GROUPING SETS ((DateKey), (CalendarYear, CalendarWeekLabel), "
    "(CalendarYear, MonthNumber), (CalendarYear, CalendarQuarterLabel), (CalendarYear))"))
sql("grouped_forecast_agg", with_sales(
    "SELECT DateKey, StoreType, CAST(coalesce(SUM(CAST(SalesAmount AS DECIMAL(18,4))), 0) AS DOUBLE) AS SalesAmount "
    "FROM sales WHERE DateKey IS NOT NULL GROUP BY DateKey, StoreType"))
sql("group_all_sum", with_sales(
    "SELECT DateKey, " + ", ".join(
        f"ROUND(CAST(coalesce(SUM(CAST({c} AS DECIMAL(28,10))), 0) AS DOUBLE), 4) AS {c}" if V.ML[c] == "double"
        else f"CAST(coalesce(SUM({c}), 0) AS BIGINT) AS {c}" for c in V.NUMERIC)
    + " FROM sales WHERE DateKey IS NOT NULL GROUP BY DateKey"))
sql("preprocess_features", with_sales(OF.grain_select("monthly"), extra_ctes=OF.features_ctes()))


# ---------------------------------------------------------------- profiling
_PC = V.NUMERIC
sql("shape_schema", with_sales(
    "SELECT t.*, (SELECT COUNT(*) FROM sales) AS rows, 40 AS columns FROM (VALUES "
    + ", ".join(f"({i}, '{c}', '{t}')" for i, (c, t) in enumerate(V.ML.items())) + ') t(position, "column", dtype)'))
sql("global_stats", with_sales(
    "SELECT CAST(coalesce(SUM(CAST(SalesAmount AS DECIMAL(18,4))), 0) AS DOUBLE) AS total, "
    "ROUND(stddev_samp(SalesAmount), 4) AS std, "
    "CAST(SUM(CAST(SalesAmount AS DECIMAL(18,4))) AS DOUBLE) / COUNT(SalesAmount) AS mean "
    "FROM sales"))
sql("describe", with_sales(" UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", COUNT({c}) AS count, ROUND(AVG({c}), 4) AS mean, "
    f"ROUND(stddev_samp({c}), 4) AS std, ROUND(MIN(CAST({c} AS DOUBLE)), 6) AS min, "
    f"ROUND(quantile_cont({c}, 0.25), 6) AS q25, ROUND(quantile_cont({c}, 0.5), 6) AS q50, "
    f"ROUND(quantile_cont({c}, 0.75), 6) AS q75, ROUND(MAX(CAST({c} AS DOUBLE)), 6) AS max "
    f"FROM sales" for c in V.NUMERIC)))
sql("null_counts", with_sales(" UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", COUNT(*) - COUNT({c}) AS nulls FROM sales"
    for c in V.ML)))
sql("value_counts", with_sales("SELECT StoreType, COUNT(*) AS count FROM sales "
                               "GROUP BY StoreType"))
sql("distinct_values", with_sales("SELECT DISTINCT BrandName FROM sales"))
sql("count_distinct", with_sales("SELECT COUNT(DISTINCT DateKey) AS n_DateKey FROM sales"))
sql("min_value", with_sales("SELECT MIN(SalesAmount) AS min_SalesAmount FROM sales"))
sql("histogram", with_sales("""
SELECT b.bin, ROUND(r.lo + b.bin * ((r.hi - r.lo) / 30), 6) AS "left",
       ROUND(r.lo + (b.bin + 1) * ((r.hi - r.lo) / 30), 6) AS "right",
       coalesce(c.count, 0) AS count
FROM (SELECT CAST(range AS INTEGER) AS bin FROM range(30)) b
CROSS JOIN (SELECT MIN(SalesAmount) AS lo, MAX(SalesAmount) AS hi FROM sales) r
LEFT JOIN (
  SELECT CAST(coalesce(least(floor((s.SalesAmount - r2.lo) / nullif((r2.hi - r2.lo) / 30, 0)),
                             29), 0) AS INTEGER) AS bin, COUNT(*) AS count
  FROM sales s CROSS JOIN (SELECT MIN(SalesAmount) AS lo, MAX(SalesAmount) AS hi FROM sales) r2
  WHERE s.SalesAmount IS NOT NULL GROUP BY 1) c ON b.bin = c.bin"""))
sql("box_stats", with_sales("""
SELECT ROUND(q.q1, 6) AS q1, ROUND(q.med, 6) AS median, ROUND(q.q3, 6) AS q3,
  ROUND(MIN(CASE WHEN s.SalesAmount BETWEEN q.q1 - 1.5 * (q.q3 - q.q1) AND q.q3 + 1.5 * (q.q3 - q.q1)
            THEN s.SalesAmount END), 6) AS lower_whisker,
  ROUND(MAX(CASE WHEN s.SalesAmount BETWEEN q.q1 - 1.5 * (q.q3 - q.q1) AND q.q3 + 1.5 * (q.q3 - q.q1)
            THEN s.SalesAmount END), 6) AS upper_whisker,
  CAST(SUM(CASE WHEN s.SalesAmount IS NOT NULL AND NOT (s.SalesAmount BETWEEN
       q.q1 - 1.5 * (q.q3 - q.q1) AND q.q3 + 1.5 * (q.q3 - q.q1)) THEN 1 ELSE 0 END) AS BIGINT)
    AS n_outliers
FROM sales s CROSS JOIN (SELECT quantile_cont(SalesAmount, 0.25) AS q1,
  quantile_cont(SalesAmount, 0.5) AS med, quantile_cont(SalesAmount, 0.75) AS q3 FROM sales) q
GROUP BY q.q1, q.med, q.q3"""))
sql("outliers_zscore", with_sales("""
SELECT COUNT(*) AS total,
  CAST(SUM(CASE WHEN abs((SalesAmount - m.mu) / nullif(m.sd, 0)) > 2.5 THEN 1 ELSE 0 END) AS BIGINT)
    AS num_outliers,
  ROUND(100.0 * SUM(CASE WHEN abs((SalesAmount - m.mu) / nullif(m.sd, 0)) > 2.5 THEN 1 ELSE 0 END)
        / COUNT(*), 6) AS pct_outliers
FROM sales CROSS JOIN (SELECT AVG(SalesAmount) AS mu, stddev_pop(SalesAmount) AS sd FROM sales) m"""))
sql("outliers_iqr", with_sales("""
SELECT SalesKey, DiscountAmount FROM sales CROSS JOIN (SELECT quantile_cont(DiscountAmount, 0.25) AS q1,
  quantile_cont(DiscountAmount, 0.75) AS q3 FROM sales) q
WHERE DiscountAmount < q.q1 - 1.5 * (q.q3 - q.q1) OR DiscountAmount > q.q3 + 1.5 * (q.q3 - q.q1)"""))
sql("outliers_quantile", with_sales("""
SELECT SalesKey, SalesAmount FROM sales CROSS JOIN (SELECT quantile_cont(SalesAmount, 0.01) AS lo,
  quantile_cont(SalesAmount, 0.99) AS hi FROM sales) q
WHERE SalesAmount < q.lo OR SalesAmount > q.hi"""))
_PAIRS = [(a, b) for i, a in enumerate(_PC) for b in _PC[i + 1:]]
_CORR = " UNION ALL ".join(
    f"SELECT '{a}' AS var1, '{b}' AS var2, corr(CAST({a} AS DOUBLE), CAST({b} AS DOUBLE)) "
    f"AS correlation FROM sales" for a, b in _PAIRS)
sql("correlation_pairs", with_sales(
    f"SELECT var1, var2, ROUND(correlation, 6) AS correlation, "
    f"ROUND(abs(correlation), 6) AS absolute_correlation FROM ({_CORR}) t"))
sql("top_correlated_pairs", with_sales(
    f"SELECT var1, var2, ROUND(correlation, 6) AS correlation, "
    f"ROUND(abs(correlation), 6) AS absolute_correlation FROM ({_CORR}) t "
    f"WHERE correlation IS NOT NULL ORDER BY abs(correlation) DESC, var1, var2 LIMIT 10"))


def _erfc_sql(x: str) -> str:
    coeffs = [-1.26551223, 1.00002368, 0.37409196, 0.09678418, -0.18628806,
              0.27886807, -1.13520398, 1.48851587, -0.82215223, 0.17087277]
    t = f"(1.0 / (1.0 + 0.5 * abs({x})))"
    poly = f"{coeffs[-1]}"
    for c in reversed(coeffs[:-1]):
        poly = f"({c} + {t} * {poly})"
    ans = f"({t} * exp(-abs({x}) * abs({x}) + {poly}))"
    return f"(CASE WHEN {x} >= 0 THEN {ans} ELSE 2.0 - {ans} END)"


_Z = "((v - st.mu) / st.sd)"
_LCDF = f"ln(0.5 * {_erfc_sql(f'(-{_Z} / sqrt(2.0))')})"
_LSF = f"ln(0.5 * {_erfc_sql(f'({_Z} / sqrt(2.0))')})"
sql("anderson_darling", with_sales(f"""
SELECT a.n, ROUND(a.statistic, 4) AS statistic, CAST(l.significance AS DOUBLE) AS significance,
  ROUND(l.base / (1.0 + 4.0 / a.n - 25.0 / (a.n * a.n)), 6) AS critical,
  a.statistic < l.base / (1.0 + 4.0 / a.n - 25.0 / (a.n * a.n)) AS looks_normal
FROM (
  SELECT MAX(st.n) AS n, -MAX(st.n) - SUM(
      (CAST(r1 AS DOUBLE) * r1 - CAST(r1 - w AS DOUBLE) * (r1 - w)) * {_LCDF}
    + (w * (2.0 * st.n + 1) - (CAST(r1 AS DOUBLE) * (r1 + 1) - CAST(r1 - w AS DOUBLE) * (r1 - w + 1)))
      * {_LSF}) / MAX(st.n) AS statistic
  FROM (SELECT v, w, SUM(w) OVER (ORDER BY v) AS r1
        FROM (SELECT CAST(SalesAmount AS DOUBLE) AS v, COUNT(*) AS w FROM sales
              WHERE SalesAmount IS NOT NULL GROUP BY 1)) p
  CROSS JOIN (SELECT COUNT(*) AS n, AVG(SalesAmount) AS mu, stddev_samp(SalesAmount) AS sd
              FROM sales WHERE SalesAmount IS NOT NULL) st
) a CROSS JOIN (VALUES (15.0, 0.576), (10.0, 0.656), (5.0, 0.787), (2.5, 0.918), (1.0, 1.092))
  l(significance, base)"""))

# --------------------------------------------------------------- time series
DAILY = ("daily AS (SELECT DateKey, CAST(coalesce(SUM(CAST(SalesAmount AS DECIMAL(18,4))), 0) "
         "AS DOUBLE) AS SalesAmount FROM sales GROUP BY DateKey)")
sql("lag_baseline", with_sales("""
SELECT COUNT(*) AS n, ROUND(1.0 - SUM((y - yp) * (y - yp)) / nullif(SUM((y - mu) * (y - mu)), 0), 6)
  AS r2
FROM (SELECT SalesAmount AS y, LAG(SalesAmount) OVER (ORDER BY DateKey) AS yp FROM daily) t
CROSS JOIN (SELECT AVG(y) AS mu FROM (SELECT SalesAmount AS y,
  LAG(SalesAmount) OVER (ORDER BY DateKey) AS yp FROM daily) u WHERE yp IS NOT NULL) m
WHERE yp IS NOT NULL""", extra_ctes=DAILY))
sql("lag_baseline_rows", with_sales("""
SELECT COUNT(*) AS n, ROUND(1.0 - SUM((y - yp) * (y - yp)) / nullif(SUM((y - mu) * (y - mu)), 0), 6)
  AS r2
FROM (SELECT SalesAmount AS y, LAG(SalesAmount) OVER (ORDER BY SalesKey) AS yp FROM sales) t
CROSS JOIN (SELECT AVG(y) AS mu FROM (SELECT SalesAmount AS y,
  LAG(SalesAmount) OVER (ORDER BY SalesKey) AS yp FROM sales) u WHERE yp IS NOT NULL) m
WHERE yp IS NOT NULL"""))
sql("diff", with_sales("SELECT DateKey, SalesAmount, ROUND(SalesAmount - LAG(SalesAmount) OVER "
                       "(ORDER BY DateKey), 6) AS diff FROM daily", extra_ctes=DAILY))
sql("diff_backfill", with_sales(
    "SELECT DateKey, SalesAmount, ROUND(coalesce(SalesAmount - LAG(SalesAmount) OVER "
    "(ORDER BY DateKey), LEAD(SalesAmount) OVER (ORDER BY DateKey) - SalesAmount), 6) AS diff "
    "FROM daily", extra_ctes=DAILY))
_SPLIT = ("SELECT DateKey, SalesAmount, CAST(row_number() OVER (ORDER BY DateKey) AS INTEGER) AS rn,"
          " row_number() OVER (ORDER BY DateKey) <= round_even(COUNT(*) OVER () * 0.7, 0) "
          "AS is_train FROM daily")
sql("chrono_split", with_sales(f"SELECT DateKey, rn, is_train FROM ({_SPLIT}) t",
                               extra_ctes=DAILY))
sql("log_split", with_sales(
    f"SELECT DateKey, ROUND(CASE WHEN SalesAmount > 0 THEN ln(SalesAmount) END, 6) AS log_y, "
    f"is_train FROM ({_SPLIT}) t", extra_ctes=DAILY))
sql("ln_exp", with_sales("SELECT DateKey, ROUND(CASE WHEN SalesAmount > 0 THEN SalesAmount END, 0) AS log_y FROM daily",
                         extra_ctes=DAILY))
sql("every_nth", with_sales(
    "SELECT SalesKey, SalesAmount, rn FROM (SELECT SalesKey, SalesAmount, "
    "row_number() OVER (ORDER BY SalesKey) AS rn FROM sales) t WHERE (rn - 1) % 500 = 0"))


def _decompose_sql(mult: bool, select: str) -> str:
    op, inv = ("/", "*") if mult else ("-", "+")
    trend = ("CASE WHEN COUNT(SalesAmount) OVER w = 365 THEN "
             "CAST(SUM(CAST(SalesAmount AS DECIMAL(18,4))) OVER w AS DOUBLE) / 365.0 END")
    base = (f"SELECT DateKey, SalesAmount, (row_number() OVER (ORDER BY DateKey) - 1) % 365 AS phase,"
            f" {trend} AS trend FROM daily "
            f"WINDOW w AS (ORDER BY DateKey ROWS BETWEEN 182 PRECEDING AND 182 FOLLOWING)")
    centre = "pm / c" if mult else "pm - c"
    resid = ("SalesAmount / (trend * seasonal)" if mult
             else "SalesAmount - trend - seasonal")
    return with_sales(f"""
SELECT {select} FROM (
  SELECT b.DateKey, b.SalesAmount, b.trend, s.seasonal, {resid} AS resid
  FROM ({base}) b
  LEFT JOIN (SELECT phase, {centre} AS seasonal FROM (
      SELECT phase, AVG(SalesAmount {op} trend) AS pm FROM ({base}) x GROUP BY phase) pp
    CROSS JOIN (SELECT AVG(pm) AS c FROM (SELECT phase, AVG(SalesAmount {op} trend) AS pm
      FROM ({base}) y GROUP BY phase) q) cc) s ON b.phase = s.phase) t""", extra_ctes=DAILY)


_DEC_COLS = ("DateKey, ROUND(trend, 6) AS trend, ROUND(seasonal, 6) AS seasonal, "
             "ROUND(resid, 6) AS resid")
sql("decompose_additive", _decompose_sql(False, _DEC_COLS))
sql("decompose_multiplicative", _decompose_sql(True, _DEC_COLS))
sql("deseasonalize", _decompose_sql(True, "DateKey, ROUND(SalesAmount / seasonal, 2) AS "
                                          "deseasonalized"))
sql("acf", with_sales("""
SELECT l.lag, ROUND(SUM(a.e * b.e) / MAX(d.den), 6) AS acf
FROM (SELECT row_number() OVER (ORDER BY DateKey) AS rn,
             SalesAmount - AVG(SalesAmount) OVER () AS e FROM daily) a
CROSS JOIN (SELECT CAST(range AS INTEGER) AS lag FROM range(31)) l
JOIN (SELECT row_number() OVER (ORDER BY DateKey) AS rn,
             SalesAmount - AVG(SalesAmount) OVER () AS e FROM daily) b ON b.rn = a.rn + l.lag
CROSS JOIN (SELECT SUM(e * e) AS den FROM (SELECT SalesAmount - AVG(SalesAmount) OVER () AS e
            FROM daily) z) d
GROUP BY l.lag""", extra_ctes=DAILY))
sql("sort_by_date", with_sales("SELECT DateKey, SalesAmount FROM daily ORDER BY DateKey",
                               extra_ctes=DAILY))
sql("head", with_sales("SELECT DateKey, SalesAmount FROM daily ORDER BY DateKey LIMIT 10",
                       extra_ctes=DAILY))
sql("zip_dates", with_sales(
    "SELECT CAST(g.d AS DATE) AS DateKey, daily.SalesAmount FROM (SELECT MIN(DateKey) AS lo, "
    "MAX(DateKey) AS hi FROM daily) b, generate_series(b.lo, b.hi, INTERVAL 1 DAY) g(d) "
    "LEFT JOIN daily ON daily.DateKey = CAST(g.d AS DATE)", extra_ctes=DAILY))


# ------------------------------------------------------- models and metrics
sql("metrics", with_sales("""
SELECT COUNT(*) AS n, ROUND(AVG(abs(y - p)), 2) AS mae, ROUND(AVG((y - p) * (y - p)), 0) AS mse,
  ROUND(sqrt(AVG((y - p) * (y - p))), 2) AS rmse,
  ROUND(1.0 - SUM((y - p) * (y - p)) / nullif(SUM((y - m.mu) * (y - m.mu)), 0), 6) AS r2
FROM (SELECT SalesAmount AS y, LAG(SalesAmount) OVER (ORDER BY DateKey) AS p FROM daily) t
CROSS JOIN (SELECT AVG(y) AS mu FROM (SELECT SalesAmount AS y, LAG(SalesAmount) OVER
  (ORDER BY DateKey) AS p FROM daily) u WHERE p IS NOT NULL) m
WHERE p IS NOT NULL""", extra_ctes=DAILY))
_SPLIT_T = (f"split AS ({_SPLIT})")
sql("mean_baseline", with_sales("""
SELECT COUNT(*) AS n, ROUND(AVG(abs(y - p)), 2) AS mae, ROUND(AVG((y - p) * (y - p)), 0) AS mse,
  ROUND(sqrt(AVG((y - p) * (y - p))), 2) AS rmse,
  ROUND(1.0 - SUM((y - p) * (y - p)) / nullif(SUM((y - m.mu) * (y - m.mu)), 0), 6) AS r2
FROM (SELECT SalesAmount AS y, (SELECT AVG(SalesAmount) FROM split WHERE is_train) AS p
      FROM split WHERE NOT is_train) t
CROSS JOIN (SELECT AVG(SalesAmount) AS mu FROM split WHERE NOT is_train) m""",
    extra_ctes=DAILY + ",\n" + _SPLIT_T))
sql("holdout_split", with_sales(
    "SELECT DateKey, row_number() OVER (ORDER BY DateKey) <= floor(COUNT(*) OVER () * 0.9) "
    "AS is_train FROM daily", extra_ctes=DAILY))

_CLEANED = ("cleaned AS (SELECT * FROM sales WHERE SalesAmount <= 2.5 * "
            "(SELECT stddev_samp(SalesAmount) FROM sales))")
sql("pipeline_preprocess", with_sales(
    OF.grain_select("daily"),
    extra_ctes=_CLEANED + ",\n" + OF.features_ctes(base="cleaned")))
sql("attach_target", with_sales(
    "SELECT DateKey, CalendarYear, SalesQuantity, SalesAmount FROM (" + OF.grain_select("daily")
    + ") t", extra_ctes=_CLEANED + ",\n" + OF.features_ctes(base="cleaned")))

# -------------------------------------------------------- similarity scores
_SIMPLE_DAILY = (f"simple AS (SELECT DateKey, {_simple_aggs(False)} FROM sales GROUP BY DateKey), "
                 "ha AS (SELECT * FROM simple WHERE year(DateKey) <= 1997), "
                 "hb AS (SELECT * FROM simple WHERE year(DateKey) >= 1998)")


def _ks(c: str) -> str:
    return (f"SELECT '{c}' AS \"column\", ROUND(1.0 - MAX(abs(fr - fs)), 6) AS ks_complement "
            f"FROM (SELECT v, SUM(nr) OVER (ORDER BY v) / SUM(nr) OVER () AS fr, "
            f"SUM(ns) OVER (ORDER BY v) / SUM(ns) OVER () AS fs FROM ("
            f"SELECT coalesce(x.v, y.v) AS v, coalesce(x.n, 0) AS nr, coalesce(y.n, 0) AS ns "
            f"FROM (SELECT CAST({c} AS DOUBLE) AS v, COUNT(*) AS n FROM ha WHERE {c} IS NOT NULL "
            f"GROUP BY 1) x FULL JOIN (SELECT CAST({c} AS DOUBLE) AS v, COUNT(*) AS n FROM hb "
            f"WHERE {c} IS NOT NULL GROUP BY 1) y ON x.v = y.v) u) w")


sql("ks_complement", with_sales(" UNION ALL ".join(
    _ks(c) for c in V.DAILY_NUMERIC), extra_ctes=_SIMPLE_DAILY))
_SIM_PAIRS = [(a, b) for i, a in enumerate(V.DAILY_NUMERIC) for b in V.DAILY_NUMERIC[i + 1:]]
sql("correlation_similarity", with_sales(" UNION ALL ".join(
    f"SELECT '{a}' AS col_a, '{b}' AS col_b, ROUND(1.0 - abs((SELECT corr(CAST({a} AS DOUBLE), "
    f"CAST({b} AS DOUBLE)) FROM ha) - (SELECT corr(CAST({a} AS DOUBLE), CAST({b} AS DOUBLE)) "
    f"FROM hb)) / 2.0, 6) AS correlation_similarity" for a, b in _SIM_PAIRS),
    extra_ctes=_SIMPLE_DAILY))
_STAR_HALVES = ("sa AS (SELECT * FROM sales WHERE CalendarYear <= 1997), "
                "sb AS (SELECT * FROM sales WHERE CalendarYear >= 1998)")


def _tv(cols: list[str], name: str) -> str:
    keys = ", ".join(cols)
    on = " AND ".join(f"x.{c} IS NOT DISTINCT FROM y.{c}" for c in cols)
    return (f"SELECT ROUND(1.0 - 0.5 * SUM(abs(coalesce(x.p, 0) - coalesce(y.q, 0))), 6) AS {name} "
            f"FROM (SELECT {keys}, COUNT(*) * 1.0 / (SELECT COUNT(*) FROM sa) AS p FROM sa "
            f"GROUP BY {keys}) x FULL JOIN (SELECT {keys}, COUNT(*) * 1.0 / "
            f"(SELECT COUNT(*) FROM sb) AS q FROM sb GROUP BY {keys}) y ON {on}")


sql("tv_complement", with_sales(" UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", tv_complement FROM ({_tv([c], 'tv_complement')}) t"
    for c in V.STAR_TEXT), extra_ctes=_STAR_HALVES))
sql("contingency_similarity", with_sales(" UNION ALL ".join(
    f"SELECT '{a}' AS col_a, '{b}' AS col_b, contingency_similarity FROM ({_tv([a, b], 'contingency_similarity')}) t"
    for i, a in enumerate(V.STAR_TEXT) for b in V.STAR_TEXT[i + 1:]), extra_ctes=_STAR_HALVES))

# ------------------------------------------------------------ sources/sinks
sql("write_csv", with_sales("SELECT DateKey, SalesAmount FROM daily", extra_ctes=DAILY))
sql("write_table", with_sales("SELECT DateKey, SalesAmount FROM daily", extra_ctes=DAILY))
sql("materialize", with_sales("SELECT DateKey, SalesAmount FROM daily", extra_ctes=DAILY))
sql("materialize_filtered", with_sales(
    "SELECT DateKey, SalesAmount FROM daily WHERE DateKey BETWEEN DATE '1996-01-01' AND "
    "DATE '1996-12-31'", extra_ctes=DAILY))
sql("read_table_ordered", with_sales(
    "SELECT DateKey, SalesAmount FROM daily WHERE DateKey BETWEEN DATE '1996-01-01' AND "
    "DATE '1996-12-31' ORDER BY DateKey", extra_ctes=DAILY))
sql("select_except", with_sales("SELECT SalesKey, DateKey, SalesAmount FROM sales"))


# ------------------------------------------------------------- metadata
def _daily_columns() -> list[str]:
    sums = list(V.SUMS) + ["TotalCost", "SalesAmount"]
    onehots = [V.column_name(c, v) for c, cats in OF.ONEHOT_CATEGORIES.items()
               for v in cats]
    return sums + ["DiscountPercent"] + onehots + ["CalendarYear"] + V.CYCLIC_FIRST["daily"]


_FORCED = ("DiscountAmount", "DiscountPercent", "DiscountQuantity", "GeographyType_City")
sql("detect_metadata", with_sales(" UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", COUNT(DISTINCT \"{c}\") AS n_distinct, "
    f"CASE WHEN {'TRUE' if c in _FORCED else 'FALSE'} OR COUNT(DISTINCT \"{c}\") <= 2 "
    f"THEN 'categorical' ELSE 'numerical' END AS sdtype FROM pp" for c in _daily_columns()),
    extra_ctes=_CLEANED + ",\n" + OF.features_ctes(base="cleaned") + ",\npp AS ("
    + OF.grain_select("daily") + ")"))
sql("write_clustered", with_sales("SELECT SalesKey, DateKey, SalesAmount, StoreType FROM sales"))


# ------------------------------------------------------------------- panel
def _panel(step: str) -> str:
    """Revenue of each store type and continent by whole weeks or months."""
    after = {"week": "ds + 7", "month": "ds + INTERVAL 1 MONTH"}[step]
    return (f"panel AS (SELECT * FROM (SELECT StoreType, ContinentName, CAST(date_trunc('{step}', DateKey) AS DATE) AS ds, "
            "CAST(SUM(CAST(SalesAmount AS DECIMAL(18,4))) AS DOUBLE) AS y FROM sales "
            "WHERE StoreType IS NOT NULL AND ContinentName IS NOT NULL GROUP BY ALL) "
            f"WHERE ds >= (SELECT min(DateKey) FROM sales) AND {after} <= (SELECT max(DateKey) FROM sales) + 1)")


sql("pacf", with_sales("""
SELECT StoreType, ContinentName, k AS lag, ROUND(a, 6) AS pacf FROM dl""", extra_ctes=_panel("week") + """,
cen AS (SELECT StoreType, ContinentName, row_number() OVER w AS rn, y - avg(y) OVER (PARTITION BY StoreType, ContinentName) AS e
        FROM panel WINDOW w AS (PARTITION BY StoreType, ContinentName ORDER BY ds)),
cov AS (SELECT x.StoreType, x.ContinentName, z.rn - x.rn AS lag, SUM(x.e * z.e) AS s
        FROM cen x JOIN cen z ON x.StoreType = z.StoreType AND x.ContinentName = z.ContinentName AND z.rn BETWEEN x.rn AND x.rn + 30
        GROUP BY ALL),
rho AS (SELECT StoreType, ContinentName, list(s / s0 ORDER BY lag) AS r
        FROM (SELECT *, max(s) FILTER (lag = 0) OVER (PARTITION BY StoreType, ContinentName) AS s0 FROM cov) GROUP BY ALL),
dl AS (
  SELECT StoreType, ContinentName, r, 0 AS k, []::DOUBLE[] AS phi, 1.0::DOUBLE AS v, 1.0::DOUBLE AS a FROM rho
  UNION ALL
  SELECT StoreType, ContinentName, r, k + 1,
         list_append(list_transform(range(1, k + 1), lambda i: phi[i] - n * phi[k + 1 - i]), n), v * (1 - n * n), n
  FROM (SELECT *, (r[k + 2] - coalesce(list_sum(list_transform(range(1, k + 1), lambda i: phi[i] * r[k + 2 - i])), 0)) / v AS n
        FROM dl WHERE k < 30) t)""").replace("WITH ", "WITH RECURSIVE ", 1))
sql("ar1_forecast", with_sales("""
SELECT StoreType, ContinentName, CAST(last + to_months(CAST(step AS INTEGER)) AS DATE) AS ds, CAST(step AS INTEGER) AS step,
  ROUND(CASE step WHEN 1 THEN c + a * y0 WHEN 2 THEN c + a * (c + a * y0) ELSE c + a * (c + a * (c + a * y0)) END, 2) AS yhat
FROM (SELECT StoreType, ContinentName, regr_slope(y, x) AS a, regr_intercept(y, x) AS c, max(ds) AS last, arg_max(y, ds) AS y0
      FROM (SELECT *, lag(y) OVER (PARTITION BY StoreType, ContinentName ORDER BY ds) AS x FROM panel) GROUP BY ALL), range(1, 4) s(step)""",
    extra_ctes=_panel("month")))
sql("adf_statistic", with_sales("""
SELECT StoreType, ContinentName, ROUND(g / sqrt((sww - g * sxw - c * szw) / (n - 3) * szz / det), 4) AS adf, CAST(n AS INTEGER) AS nobs
FROM (SELECT *, (sxw * szz - szw * sxz) / det AS g, (szw * sxx - sxw * sxz) / det AS c
  FROM (SELECT *, sxx * szz - sxz * sxz AS det
    FROM (SELECT StoreType, ContinentName, count(*) AS n, regr_sxx(w, x) AS sxx, regr_syy(w, x) AS sww, regr_sxy(w, x) AS sxw,
                 regr_sxx(w, z) AS szz, regr_sxy(w, z) AS szw, regr_sxy(z, x) AS sxz
          FROM (SELECT *, x - lag(x) OVER t AS z, y - x AS w
                FROM (SELECT *, lag(y) OVER (PARTITION BY StoreType, ContinentName ORDER BY ds) AS x FROM panel)
                WINDOW t AS (PARTITION BY StoreType, ContinentName ORDER BY ds))
          WHERE z IS NOT NULL GROUP BY ALL)))""", extra_ctes=_panel("month")))
sql("latest_by_time", with_sales("""
SELECT CASE WHEN y = 1996 THEN 'baseline_1996' ELSE 'latest' END AS pick, 'baseline_' || y AS context, n AS row_count, ROUND(mae, 2) AS mae
FROM (SELECT year(DateKey) AS y, COUNT(*) AS n, AVG(abs(SalesAmount - p)) AS mae
      FROM (SELECT *, LAG(SalesAmount) OVER (ORDER BY DateKey) AS p FROM daily) WHERE p IS NOT NULL GROUP BY 1)
WHERE y = 1996 OR y = (SELECT max(year(DateKey)) FROM daily)""", extra_ctes=DAILY))

_MEASURES = ["UnitCost", "UnitPrice", "SalesQuantity", "ReturnAmount", "DiscountAmount", "TotalCost", "SalesAmount"]
sql("diagnostic_halves", with_sales(" UNION ALL ".join(
    [f"SELECT '{c}' AS \"column\", 'numeric' AS kind, true AS present, true AS same_type, "
     f"ROUND((SELECT AVG(CASE WHEN {c} >= lo AND {c} <= hi THEN 1.0 ELSE 0.0 END) FROM sales WHERE CalendarYear >= 1998), 6) AS valid_share "
     f"FROM (SELECT min({c}) AS lo, max({c}) AS hi FROM sales WHERE CalendarYear <= 1997)" for c in _MEASURES]
    + [f"SELECT '{c}', 'categorical', true, true, ROUND(AVG(CASE WHEN {c} IN (SELECT {c} FROM sales WHERE CalendarYear <= 1997 AND {c} IS NOT NULL) "
       f"OR ({c} IS NULL AND EXISTS (SELECT 1 FROM sales WHERE CalendarYear <= 1997 AND {c} IS NULL)) THEN 1.0 ELSE 0.0 END), 6) "
       f"FROM sales WHERE CalendarYear >= 1998" for c in V.STAR_TEXT])))
_SPINE = "(SELECT CAST(x AS DATE) AS DateKey FROM generate_series(DATE '{0}', DATE '{1}', INTERVAL 1 DAY) t(x))"
sql("forecast_past_keys", with_sales(f"""
SELECT s.DateKey, g.StoreType, t.n IS NOT NULL AS predicted
FROM (SELECT DISTINCT StoreType FROM sales WHERE channelKey = 2 AND DateKey BETWEEN DATE '2001-01-01' AND DATE '2001-11-04') g
CROSS JOIN {_SPINE.format('2001-01-01', '2001-11-04')} s
LEFT JOIN (SELECT DateKey, StoreType, count(*) AS n FROM sales WHERE channelKey = 2 GROUP BY ALL) t
  ON t.DateKey = s.DateKey AND t.StoreType IS NOT DISTINCT FROM g.StoreType"""))
sql("forecast_keys", with_sales(f"""
SELECT s.DateKey, g.StoreType, g.ContinentName, CASE WHEN s.DateKey > DATE '2000-12-31' THEN CASE WHEN g.lately THEN 'synthetic' END
  WHEN t.n IS NOT NULL THEN 'actual' END AS source
FROM (SELECT StoreType, ContinentName, bool_or(true) AS lately FROM sales
      WHERE channelKey = 2 AND DateKey BETWEEN DATE '2000-01-02' AND DATE '2000-12-31' GROUP BY ALL) g
CROSS JOIN {_SPINE.format('2000-12-01', '2001-01-31')} s
LEFT JOIN (SELECT DateKey, StoreType, ContinentName, count(*) AS n FROM sales WHERE channelKey = 2 GROUP BY ALL) t
  ON t.DateKey = s.DateKey AND t.StoreType IS NOT DISTINCT FROM g.StoreType AND t.ContinentName IS NOT DISTINCT FROM g.ContinentName"""))
sql("pipeline_train_run", with_sales("""
SELECT 'train' AS context, CAST(floor(count(*) * 0.9) AS BIGINT) AS row_count
FROM (SELECT DISTINCT DateKey FROM sales WHERE SalesAmount <= 2.5 * (SELECT stddev_samp(SalesAmount) FROM sales))"""))
