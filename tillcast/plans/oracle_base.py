"""DuckDB twins of the star views (used by ``oracle_sql``).

These are written independently of the Spark code, in plain SQL over
the registered test tables (lists that must be the same are written out
in ``oracle_values``), so the Spark result is checked against a second
engine.
"""

from __future__ import annotations

DATE = "CAST(l.l_shipdate AS DATE)"

SUBCAT_CTE = """subcat AS (
  SELECT p_type, CAST(dense_rank() OVER (ORDER BY p_type) AS INTEGER) AS sc_code
  FROM (SELECT DISTINCT p_type FROM part WHERE p_type IS NOT NULL) t
)"""

OC_CTE = """oc AS (
  SELECT o.o_orderkey,
         CAST(substr(o.o_orderpriority, 1, 1) AS INTEGER) AS channelKey,
         substr(o.o_orderpriority, 3) AS ChannelName,
         c.c_mktsegment AS StoreType
  FROM orders o LEFT JOIN customer c ON o.o_custkey = c.c_custkey
)"""

SALES_SELECT = f"""
  SELECT
    concat_ws('|', CAST(l.l_orderkey AS VARCHAR), CAST(l.l_linenumber AS VARCHAR),
              CAST(l.l_partkey AS VARCHAR), CAST(l.l_suppkey AS VARCHAR),
              CAST({DATE} AS VARCHAR),
              CAST(CAST(round(l.l_extendedprice * 100) AS BIGINT) AS VARCHAR)) AS SalesKey,
    {DATE} AS DateKey,
    oc.channelKey AS channelKey,
    l.l_suppkey AS StoreKey,
    l.l_partkey AS ProductKey,
    1 + CAST(round(l.l_discount * 100) AS INTEGER) AS PromotionKey,
    p.p_retailprice AS UnitCost,
    l.l_extendedprice / l.l_quantity AS UnitPrice,
    CAST(l.l_quantity AS BIGINT) AS SalesQuantity,
    CASE WHEN l.l_returnflag = 'R' THEN CAST(l.l_quantity AS BIGINT) ELSE CAST(0 AS BIGINT) END
      AS ReturnQuantity,
    CASE WHEN l.l_returnflag = 'R' THEN l.l_extendedprice ELSE 0.0 END AS ReturnAmount,
    CASE WHEN l.l_discount > 0 THEN CAST(l.l_quantity AS BIGINT) ELSE CAST(0 AS BIGINT) END
      AS DiscountQuantity,
    l.l_extendedprice * l.l_discount AS DiscountAmount,
    p.p_retailprice * CAST(CAST(l.l_quantity AS BIGINT) AS DOUBLE) AS TotalCost,
    l.l_extendedprice * (1 - l.l_discount) AS SalesAmount,
    l.l_discount AS DiscountPercent,
    CAST(year({DATE}) AS INTEGER) AS CalendarYear,
    'Q' || CAST(quarter({DATE}) AS VARCHAR) AS CalendarQuarterLabel,
    'Week ' || CAST((dayofyear({DATE}) - 1 + isodow(date_trunc('year', {DATE})) - 1) // 7 + 1 AS VARCHAR) AS CalendarWeekLabel,
    CASE WHEN isodow({DATE}) <= 5 THEN 'WorkDay' ELSE 'WeekEnd' END AS IsWorkDay,
    CAST(month({DATE}) AS INTEGER) AS MonthNumber,
    CAST(isodow({DATE}) AS INTEGER) AS CalendarDayOfWeekNumber,
    CASE WHEN p.p_partkey % 13 = 0 THEN NULL ELSE sc.sc_code END AS ProductSubcategoryKey,
    CASE WHEN p.p_partkey % 11 = 0 THEN NULL ELSE p.p_brand END AS BrandName,
    nullif(p.p_partkey % 3, 0) AS ClassID,
    nullif(p.p_partkey % 5, 0) AS StyleID,
    nullif(p.p_partkey % 7, 0) AS ColorID,
    CAST(p.p_size AS DOUBLE) AS Weight,
    CASE p.p_partkey % 4 WHEN 0 THEN 'pounds' WHEN 1 THEN 'ounces' WHEN 2 THEN 'grams' END
      AS WeightUnitMeasureID,
    1 + p.p_partkey % 3 AS StockTypeID,
    CASE WHEN p.p_partkey % 13 = 0 THEN NULL ELSE sc.sc_code % 3 END AS ProductCategoryKey,
    s.s_nationkey AS GeographyKey,
    oc.StoreType AS StoreType,
    CAST(s.s_suppkey % 50 AS DOUBLE) AS EmployeeCount,
    s.s_acctbal AS SellingAreaSize,
    CASE WHEN n.n_nationkey IS NULL THEN NULL ELSE 'City' END AS GeographyType,
    r.r_name AS ContinentName,
    s.s_name AS CityName,
    n.n_name AS StateProvinceName,
    n.n_name AS RegionCountryName,
    -- dashboard-only attributes
    oc.ChannelName AS ChannelName,
    CASE WHEN l.l_discount = 0 THEN 'No Discount'
         ELSE CAST(CAST(round(l.l_discount * 100) AS INTEGER) AS VARCHAR) || '% Discount' END
      AS PromotionName,
    CASE WHEN l.l_discount = 0 THEN 'No Discount' ELSE 'Volume Discount' END AS PromotionType,
    monthname({DATE}) AS CalendarMonthLabel,
    dayname({DATE}) AS CalendarDayOfWeekLabel,
    p.p_name AS ProductName,
    CASE WHEN p.p_partkey % 13 = 0 THEN NULL ELSE sc.p_type END AS ProductSubcategoryName,
    CASE WHEN p.p_partkey % 13 = 0 THEN NULL ELSE 'Category ' || CAST(sc.sc_code % 3 AS VARCHAR) END
      AS ProductCategoryName,
    s.s_name AS StoreName
  FROM lineitem l
  LEFT JOIN oc ON l.l_orderkey = oc.o_orderkey
  LEFT JOIN part p ON l.l_partkey = p.p_partkey
  LEFT JOIN subcat sc ON p.p_type = sc.p_type
  LEFT JOIN supplier s ON l.l_suppkey = s.s_suppkey
  LEFT JOIN nation n ON s.s_nationkey = n.n_nationkey
  LEFT JOIN region r ON n.n_regionkey = r.r_regionkey
"""

ML_COLS = """SalesKey, DateKey, channelKey, StoreKey, ProductKey, PromotionKey, UnitCost,
  UnitPrice, SalesQuantity, ReturnQuantity, ReturnAmount, DiscountQuantity, DiscountAmount,
  TotalCost, SalesAmount, DiscountPercent, CalendarYear, CalendarQuarterLabel,
  CalendarWeekLabel, IsWorkDay, MonthNumber, CalendarDayOfWeekNumber, ProductSubcategoryKey,
  BrandName, ClassID, StyleID, ColorID, Weight, WeightUnitMeasureID, StockTypeID,
  ProductCategoryKey, GeographyKey, StoreType, EmployeeCount, SellingAreaSize, GeographyType,
  ContinentName, CityName, StateProvinceName, RegionCountryName"""


def with_sales(body: str, where: str = "", extra_ctes: str = "") -> str:
    """``WITH ... sales AS (<star>) <body>``; ``where`` filters the star."""
    w = f"\n  WHERE {where}" if where else ""
    extra = f",\n{extra_ctes}" if extra_ctes else ""
    return (f"WITH {SUBCAT_CTE},\n{OC_CTE},\nsales AS ({SALES_SELECT}{w}\n){extra}\n{body}")


def sample_where(ratio: float, seed: int = 42) -> str:
    thr = format(min(int(ratio * 16 ** 8), 16 ** 8 - 1), "08x")
    key = ("concat_ws('|', CAST(l.l_orderkey AS VARCHAR), CAST(l.l_linenumber AS VARCHAR), "
           "CAST(l.l_partkey AS VARCHAR), CAST(l.l_suppkey AS VARCHAR), "
           f"CAST({DATE} AS VARCHAR), "
           "CAST(CAST(round(l.l_extendedprice * 100) AS BIGINT) AS VARCHAR))")
    return f"substr(md5(concat_ws('|', {key}, '{seed}')), 1, 8) < '{thr}'"


def date_where(lo: str | None, hi: str | None) -> str:
    parts = []
    if lo:
        parts.append(f"{DATE} >= DATE '{lo}'")
    if hi:
        parts.append(f"{DATE} <= DATE '{hi}'")
    return " AND ".join(parts)
