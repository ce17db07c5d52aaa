"""Column groups and constants of the retail star schema.

Names follow the sales star the operators were designed for (a sales
fact plus promotion, date, product, subcategory, category, store,
geography and channel dimensions).
"""

from __future__ import annotations

# ---------------------------------------------------------------------------
# Fixed values (must equal the originating pipeline's for equal results)
# ---------------------------------------------------------------------------
IMPUTE_ZERO_COLUMNS = [
    "ProductSubcategoryKey", "ClassID", "StyleID", "ColorID", "Weight",
    "StockTypeID", "ProductCategoryKey",
]
BRAND_FILL = "N/A"
WEIGHT_FACTORS = {"pounds": 453.592, "ounces": 28.3495, "grams": 1.0}
STOCK_SWAP = {1: 3, 3: 1}
MONTHS_IN_YEAR = 12
DAYS_IN_WEEK = 7
QUARTERS_IN_YEAR = 4
OUTLIER_SIGMA = 2.5
ZSCORE_LIMIT = 2.5
IQR_FACTOR = 1.5
QUANTILE_BOUNDS = (0.01, 0.99)
ROBUST_SCALE_COLUMNS = [
    "channelKey", "StoreKey", "ProductKey", "PromotionKey", "StockTypeID",
    "UnitCost", "UnitPrice", "TotalCost", "ReturnQuantity", "ReturnAmount",
    "DiscountQuantity", "DiscountAmount", "DiscountPercent", "CalendarYear",
    "ProductSubcategoryKey", "ClassID", "StyleID", "ColorID", "Weight_grams",
    "ProductCategoryKey", "GeographyKey", "EmployeeCount",
    "SellingAreaSize", "sin_MonthNumber", "cos_MonthNumber",
    "sin_CalendarDayOfWeekNumber", "cos_CalendarDayOfWeekNumber",
    "sin_CalendarQuarterLabel", "cos_CalendarQuarterLabel",
]
ONE_HOT_COLUMNS = ["IsWorkDay", "BrandName", "StoreType", "GeographyType", "RegionCountryName"]
LABEL_COLUMNS = ["CityName", "ContinentName", "StateProvinceName"]
SUM_COLUMNS = [
    "UnitCost", "UnitPrice", "ReturnQuantity", "ReturnAmount", "DiscountQuantity",
    "DiscountAmount", "Weight_grams", "SalesQuantity",
]
MEAN_COLUMNS = ["DiscountPercent"]
MARGINAL_FAMILIES = {"UnitCost": "truncnorm", "UnitPrice": "truncnorm", "SalesQuantity": "gamma",
                     "ReturnAmount": "truncnorm", "SalesAmount": "truncnorm"}
MARGINAL_DEFAULT = "beta"
DEFAULT_MIN_DATE = "2007-01-01"
DEFAULT_MAX_DATE = "2009-12-31"
FUTURE_START = "2010-01-01"
GBT_DEFAULTS = {"max_depth": 10, "n_trees": 500, "learning_rate": 0.1, "patience": 5}

# Cyclic columns kept ("first") per grain; the scaled CalendarYear copy is
# a feature, the raw year is the grain key.
CYCLIC_FIRST = {
    "daily": ["sin_MonthNumber", "cos_MonthNumber", "sin_CalendarDayOfWeekNumber",
              "cos_CalendarDayOfWeekNumber", "sin_CalendarQuarterLabel",
              "cos_CalendarQuarterLabel"],
    "weekly": ["sin_MonthNumber", "cos_MonthNumber", "sin_CalendarQuarterLabel",
               "cos_CalendarQuarterLabel"],
    "monthly": ["sin_MonthNumber", "cos_MonthNumber", "sin_CalendarQuarterLabel",
                "cos_CalendarQuarterLabel"],
    "quarterly": ["sin_CalendarQuarterLabel", "cos_CalendarQuarterLabel"],
    "yearly": [],
}

# Grain -> group keys (raw calendar keys, kept next to the features).
GRAIN_KEYS = {
    "daily": ["DateKey"],
    "weekly": ["CalendarYear", "CalendarWeekLabel"],
    "monthly": ["CalendarYear", "MonthNumber"],
    "quarterly": ["CalendarYear", "CalendarQuarterLabel"],
    "yearly": ["CalendarYear"],
}
# The 40-column ML wide table, in order.
ML_COLUMNS = [
    "SalesKey", "DateKey", "channelKey", "StoreKey", "ProductKey", "PromotionKey",
    "UnitCost", "UnitPrice", "SalesQuantity", "ReturnQuantity", "ReturnAmount",
    "DiscountQuantity", "DiscountAmount", "TotalCost", "SalesAmount", "DiscountPercent",
    "CalendarYear", "CalendarQuarterLabel", "CalendarWeekLabel", "IsWorkDay",
    "MonthNumber", "CalendarDayOfWeekNumber", "ProductSubcategoryKey", "BrandName",
    "ClassID", "StyleID", "ColorID", "Weight", "WeightUnitMeasureID", "StockTypeID",
    "ProductCategoryKey", "GeographyKey", "StoreType", "EmployeeCount", "SellingAreaSize",
    "GeographyType", "ContinentName", "CityName", "StateProvinceName", "RegionCountryName",
]

# The dashboard wide table (33 distinct columns).
DASHBOARD_COLUMNS = [
    "SalesKey", "DateKey", "ChannelKey", "StoreKey", "ProductKey", "PromotionKey",
    "UnitCost", "UnitPrice", "SalesQuantity", "ReturnQuantity", "ReturnAmount",
    "DiscountQuantity", "DiscountAmount", "TotalCost", "SalesAmount",
    "ChannelName", "PromotionName", "PromotionType", "CalendarYear", "CalendarQuarterLabel",
    "CalendarMonthLabel", "CalendarDayOfWeekLabel", "MonthNumber",
    "CalendarDayOfWeekNumber", "ProductName", "ProductSubcategoryKey",
    "ProductSubcategoryName", "ProductCategoryKey", "ProductCategoryName",
    "GeographyKey", "StoreType", "StoreName", "ContinentName",
]

# Columns the business knows in advance for a future day.
FACT_COLUMNS = ["CalendarQuarterLabel", "CalendarWeekLabel", "IsWorkDay", "MonthNumber",
                "CalendarDayOfWeekNumber"]

# Aggregates of the raw measures by grain, and the further ones of the full form.
SIMPLE_AGGS = {"UnitCost": "mean", "UnitPrice": "mean", "ReturnQuantity": "sum",
               "ReturnAmount": "sum", "DiscountQuantity": "sum", "DiscountAmount": "sum",
               "TotalCost": "sum", "SalesQuantity": "sum", "SalesAmount": "sum"}
FULL_EXTRA_AGGS = {"DiscountPercent": "mean", "IsWorkDay": "mean", "Weight": "sum",
                   "EmployeeCount": "mean", "SellingAreaSize": "mean"}
# ---------------------------------------------------------------------------

GRAINS = list(GRAIN_KEYS)
