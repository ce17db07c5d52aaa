"""Values of the SQL twins, written out here and not taken from the engine: a
wrong list there shows as a difference."""

IMPUTE_ZERO = ["ProductSubcategoryKey", "ClassID", "StyleID", "ColorID", "Weight", "StockTypeID", "ProductCategoryKey"]
ROBUST_SCALE = [
    "channelKey", "StoreKey", "ProductKey", "PromotionKey", "StockTypeID", "UnitCost", "UnitPrice", "TotalCost",
    "ReturnQuantity", "ReturnAmount", "DiscountQuantity", "DiscountAmount", "DiscountPercent", "CalendarYear",
    "ProductSubcategoryKey", "ClassID", "StyleID", "ColorID", "Weight_grams", "ProductCategoryKey", "GeographyKey",
    "EmployeeCount", "SellingAreaSize", "sin_MonthNumber", "cos_MonthNumber", "sin_CalendarDayOfWeekNumber",
    "cos_CalendarDayOfWeekNumber", "sin_CalendarQuarterLabel", "cos_CalendarQuarterLabel",
]
LABELS = ["CityName", "ContinentName", "StateProvinceName"]
SUMS = ["UnitCost", "UnitPrice", "ReturnQuantity", "ReturnAmount", "DiscountQuantity", "DiscountAmount", "Weight_grams", "SalesQuantity"]
GRAIN_KEYS = {
    "daily": ["DateKey"],
    "weekly": ["CalendarYear", "CalendarWeekLabel"],
    "monthly": ["CalendarYear", "MonthNumber"],
    "quarterly": ["CalendarYear", "CalendarQuarterLabel"],
    "yearly": ["CalendarYear"],
}
CYCLIC_FIRST = {
    "daily": ["sin_MonthNumber", "cos_MonthNumber", "sin_CalendarDayOfWeekNumber", "cos_CalendarDayOfWeekNumber",
              "sin_CalendarQuarterLabel", "cos_CalendarQuarterLabel"],
    "weekly": ["sin_MonthNumber", "cos_MonthNumber", "sin_CalendarQuarterLabel", "cos_CalendarQuarterLabel"],
    "monthly": ["sin_MonthNumber", "cos_MonthNumber", "sin_CalendarQuarterLabel", "cos_CalendarQuarterLabel"],
    "quarterly": ["sin_CalendarQuarterLabel", "cos_CalendarQuarterLabel"],
    "yearly": [],
}
# The ML star: columns and their types.
ML = {
    "SalesKey": "string", "DateKey": "date", "channelKey": "int", "StoreKey": "bigint", "ProductKey": "bigint", "PromotionKey": "int",
    "UnitCost": "double", "UnitPrice": "double", "SalesQuantity": "bigint", "ReturnQuantity": "bigint", "ReturnAmount": "double",
    "DiscountQuantity": "bigint", "DiscountAmount": "double", "TotalCost": "double", "SalesAmount": "double", "DiscountPercent": "double",
    "CalendarYear": "int", "CalendarQuarterLabel": "string", "CalendarWeekLabel": "string", "IsWorkDay": "string", "MonthNumber": "int",
    "CalendarDayOfWeekNumber": "int", "ProductSubcategoryKey": "int", "BrandName": "string", "ClassID": "bigint", "StyleID": "bigint",
    "ColorID": "bigint", "Weight": "double", "WeightUnitMeasureID": "string", "StockTypeID": "bigint", "ProductCategoryKey": "int",
    "GeographyKey": "int", "StoreType": "string", "EmployeeCount": "double", "SellingAreaSize": "double", "GeographyType": "string",
    "ContinentName": "string", "CityName": "string", "StateProvinceName": "string", "RegionCountryName": "string",
}
NUMERIC = [c for c, t in ML.items() if t in ("int", "bigint", "double")]
DAILY_NUMERIC = ["UnitCost", "UnitPrice", "ReturnQuantity", "ReturnAmount", "DiscountQuantity", "DiscountAmount", "TotalCost", "SalesQuantity", "SalesAmount"]
STAR_TEXT = ["CalendarQuarterLabel", "CalendarWeekLabel", "IsWorkDay", "BrandName", "WeightUnitMeasureID", "StoreType", "GeographyType",
             "ContinentName", "CityName", "StateProvinceName", "RegionCountryName"]


def column_name(column: str, value: str) -> str:
    """Name of a one-hot column: space to underscore, dots and slashes out."""
    return f"{column}_{value}".replace(" ", "_").replace(".", "").replace("/", "")
