"""DuckDB twin of the feature chain (prepare -> robust scale -> one-hot ->
label codes) over the ``sales`` star CTE, plus grain aggregation."""

from __future__ import annotations

from tillcast.plans import oracle_values as V

# Category sets of the sf0.01 test tables, by rule (for the SQL twin only).
ONEHOT_CATEGORIES = {
    "IsWorkDay": ["WeekEnd", "WorkDay"],
    "BrandName": sorted([f"Brand#{i}" for i in range(1, 26)] + ["N/A"]),
    "StoreType": ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"],
    "GeographyType": ["City"],
    "RegionCountryName": sorted(f"NATION_{i}" for i in range(25)),
}

# Those that the rows of 1996 have without the store type BUILDING.
FEW_CATEGORIES = {"BrandName": ONEHOT_CATEGORIES["BrandName"],
                  "StoreType": [v for v in ONEHOT_CATEGORIES["StoreType"] if v != "BUILDING"]}

WS = ("' ' || chr(9) || chr(10) || chr(13) || chr(11) || chr(12) || chr(28) || chr(29) || "
      "chr(30) || chr(31)")

def prep_cte(src: str = "sales") -> str:
    return f"""prep AS (
  SELECT SalesKey, DateKey, channelKey, StoreKey, ProductKey,
    CASE WHEN PromotionKey = 1 THEN 1 ELSE 0 END AS PromotionKey,
    UnitCost, UnitPrice, SalesQuantity, ReturnQuantity, ReturnAmount, DiscountQuantity,
    DiscountAmount, TotalCost, SalesAmount, DiscountPercent, CalendarYear,
    CAST(regexp_extract(CalendarQuarterLabel, '(\\d)', 1) AS INTEGER) AS CalendarQuarterLabel,
    trim(CalendarWeekLabel, {WS}) AS CalendarWeekLabel,
    trim(IsWorkDay, {WS}) AS IsWorkDay, MonthNumber,
    coalesce(ProductSubcategoryKey, 0) AS ProductSubcategoryKey,
    coalesce(trim(BrandName, {WS}), 'N/A') AS BrandName,
    coalesce(ClassID, 0) AS ClassID, coalesce(StyleID, 0) AS StyleID,
    coalesce(ColorID, 0) AS ColorID,
    CAST(coalesce(Weight, 0) AS DOUBLE) * CASE trim(WeightUnitMeasureID, {WS})
      WHEN 'pounds' THEN 453.592 WHEN 'ounces' THEN 28.3495 WHEN 'grams' THEN 1.0 END
      AS Weight_grams,
    CASE coalesce(StockTypeID, 0) WHEN 1 THEN 3 WHEN 3 THEN 1 ELSE coalesce(StockTypeID, 0) END
      AS StockTypeID,
    coalesce(ProductCategoryKey, 0) AS ProductCategoryKey,
    GeographyKey, trim(StoreType, {WS}) AS StoreType, EmployeeCount, SellingAreaSize,
    trim(GeographyType, {WS}) AS GeographyType, trim(ContinentName, {WS}) AS ContinentName,
    trim(CityName, {WS}) AS CityName, trim(StateProvinceName, {WS}) AS StateProvinceName,
    trim(RegionCountryName, {WS}) AS RegionCountryName,
    sin(2 * pi() * MonthNumber / 12.0) AS sin_MonthNumber,
    cos(2 * pi() * MonthNumber / 12.0) AS cos_MonthNumber,
    sin(2 * pi() * CalendarDayOfWeekNumber / 7.0) AS sin_CalendarDayOfWeekNumber,
    cos(2 * pi() * CalendarDayOfWeekNumber / 7.0) AS cos_CalendarDayOfWeekNumber,
    sin(2 * pi() * CAST(regexp_extract(CalendarQuarterLabel, '(\\d)', 1) AS INTEGER) / 4.0)
      AS sin_CalendarQuarterLabel,
    cos(2 * pi() * CAST(regexp_extract(CalendarQuarterLabel, '(\\d)', 1) AS INTEGER) / 4.0)
      AS cos_CalendarQuarterLabel
  FROM {src}
)"""


PREP = prep_cte("sales")


def _stats_cte(src: str = "prep") -> str:
    parts = []
    for c in V.ROBUST_SCALE:
        parts.append(f"quantile_cont({c}, 0.5) AS {c}__med")
        parts.append(f"quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25) AS {c}__iqr")
    return f"rstats AS (SELECT {', '.join(parts)} FROM {src})"


def scaled_expr(c: str) -> str:
    return (f"(CAST({c} AS DOUBLE) - rstats.{c}__med) / "
            f"CASE WHEN rstats.{c}__iqr = 0 THEN 1.0 ELSE rstats.{c}__iqr END")


def onehot_exprs(agg: str | None = None) -> list[str]:
    out = []
    for c, cats in ONEHOT_CATEGORIES.items():
        for v in cats:
            e = f"CAST(CASE WHEN {c} = '{v}' THEN 1.0 ELSE 0.0 END AS DOUBLE)"
            name = V.column_name(c, v)
            out.append(f'{agg}({e}) AS "{name}"' if agg else f'{e} AS "{name}"')
    return out


def label_ctes() -> str:
    ctes = []
    for c in V.LABELS:
        ctes.append(f"lab_{c} AS (SELECT v, CAST(dense_rank() OVER (ORDER BY v) - 1 AS INTEGER) "
                    f"AS code FROM (SELECT DISTINCT {c} AS v FROM prep WHERE {c} IS NOT NULL))")
    return ",\n".join(ctes)


def features_ctes(src: str = "prep", base: str = "sales") -> str:
    """prep (over ``base``), rstats, feat (scaled + one-hot + raw grain keys)."""
    scaled = []
    for c in V.ROBUST_SCALE:
        name = "CalendarYear_scaled" if c == "CalendarYear" else c
        scaled.append(f"{scaled_expr(c)} AS {name}")
    keep = ["SalesKey", "DateKey", "CalendarYear", "CalendarWeekLabel", "MonthNumber",
            "CalendarQuarterLabel", "SalesQuantity", "SalesAmount"]
    feat = (f"feat AS (SELECT {', '.join('prep.' + k + ' AS ' + k for k in keep)}, "
            f"{', '.join(scaled)}, {', '.join(onehot_exprs())} FROM prep, rstats)")
    return f"{prep_cte(base)},\n{_stats_cte(src)},\n{feat}"


def grain_select(grain: str, include_total_cost: bool = True) -> str:
    keys = V.GRAIN_KEYS[grain]
    sums = list(V.SUMS) + (["TotalCost"] if include_total_cost else [])
    r = "ROUND({0}, 6)"
    parts = [(f"CAST(coalesce(SUM({c}), 0) AS BIGINT) AS {c}" if c == "SalesQuantity"
              else f"{r.format(f'CAST(coalesce(SUM(CAST({c} AS DECIMAL(38,12))), 0) AS DOUBLE)')} AS {c}") for c in sums]
    parts.append("ROUND(CAST(coalesce(SUM(CAST(SalesAmount AS DECIMAL(18,4))), 0) AS DOUBLE), 6)"
                 " AS SalesAmount")
    parts += [f"{r.format('CAST(SUM(CAST(DiscountPercent AS DECIMAL(38,12))) AS DOUBLE) / COUNT(DiscountPercent)')} AS DiscountPercent"]
    for c, cats in ONEHOT_CATEGORIES.items():
        for v in cats:
            name = V.column_name(c, v)
            parts.append(f'{r.format(f"AVG({chr(34)}{name}{chr(34)})")} AS "{name}"')
    firsts = ([] if "CalendarYear" in keys else ["CalendarYear"]) + V.CYCLIC_FIRST[grain]
    for c in firsts:
        val = f"arg_min({c}, DateKey)"
        parts.append(f"{val if c == 'CalendarYear' else r.format(val)} AS {c}")
    where = " AND ".join(f"{k} IS NOT NULL" for k in keys)
    return (f"SELECT {', '.join(keys)}, {', '.join(parts)} FROM feat WHERE {where} "
            f"GROUP BY {', '.join(keys)}")
