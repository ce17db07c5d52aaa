"""The retail star, derived from the TPC-H-style test tables.

Every frame here is a projection / join of the given Parquet tables, so
its size grows with them.  The mapping (one expression per star column)
is the stand-in documented in FIXTURES.md section C.

Physical notes for scale:
* The star plans the hops that its columns need, no others.
* ``lineitem`` x ``orders`` is the one big join (both sides grow with the
  data): a sort-merge join on the order key unless the orders are a
  few MB.  ``orders`` is joined with ``customer`` first (bushy), so the fact is shuffled once for
  the order hop, with the columns of ``fact_rows``; the star computes the
  fact's columns after its joins.
* Dimensions go through ``checked_broadcast`` with their own counted rows:
  broadcast while small, sort-merge beyond the bound.
* Date and promotion attributes are pure functions of fact columns and
  are projected; ``dim_date`` and ``dim_promotion`` are the same as tables.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillcast.functions.calendar import calendar_parts, date_spine_of
from tillcast.operators.joins import checked_broadcast
from tillcast.operators.ranking import dense_code
from tillcast.sources.tables import counted_rows, read_table

# Fixed values of the stand-in mapping.
WEIGHT_UNIT_BY_MOD4 = {0: "pounds", 1: "ounces", 2: "grams"}
BRAND_NULL_MOD = 11
SUBCATEGORY_NULL_MOD = 13
CATEGORY_MOD = 3
EMPLOYEE_MOD = 50
GEOGRAPHY_TYPE = "City"


def sales_key(l_orderkey: Column, l_linenumber: Column, l_partkey: Column,
              l_suppkey: Column, ship_date: Column, extendedprice: Column) -> Column:
    """The unique six-part sales key as one string."""
    return F.concat_ws(
        "|", l_orderkey.cast("string"), l_linenumber.cast("string"), l_partkey.cast("string"),
        l_suppkey.cast("string"), ship_date.cast("string"),
        F.round(extendedprice * F.lit(100)).cast("bigint").cast("string"))


def ship_date_bounds(min_date: str | None, max_date: str | None) -> Column | None:
    """Range on the raw ``l_shipdate`` (timestamp) equal to the inclusive
    DateKey range, so the filter is pushed into the Parquet scan."""
    c = F.col("l_shipdate")
    cond = None
    if min_date is not None:
        cond = c >= F.to_timestamp_ntz(F.lit(min_date))
    if max_date is not None:
        hi = c < F.to_timestamp_ntz(F.date_add(F.to_date(F.lit(max_date)), 1).cast("string"))
        cond = hi if cond is None else cond & hi
    return cond


def orders_channel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bushy hop: orders left-join customer, projected to the order key and
    the attributes the fact needs (channel, channel name, store type)."""
    orders = read_table(spark, sf_dir, "orders", ["o_orderkey", "o_custkey", "o_orderpriority"])
    customer = read_table(spark, sf_dir, "customer", ["c_custkey", "c_mktsegment"])
    joined = orders.join(checked_broadcast(customer, counted_rows(spark, sf_dir, "customer")),
                         orders.o_custkey == customer.c_custkey, "left")
    return joined.select(
        "o_orderkey",
        F.substring("o_orderpriority", 1, 1).cast("int").alias("channelKey"),
        F.substring("o_orderpriority", 3, 100).alias("ChannelName"),
        F.col("c_mktsegment").alias("StoreType"),
    )


def fact_rows(spark: SparkSession, sf_dir: str, min_date: str | None = None,
              max_date: str | None = None) -> DataFrame:
    """The line items with the columns that the fact is computed from, a third
    as wide as the fact: joins that shuffle the rows carry these."""
    li = read_table(spark, sf_dir, "lineitem", [
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
        "l_extendedprice", "l_discount", "l_returnflag", "l_shipdate"])
    cond = ship_date_bounds(min_date, max_date)
    if cond is not None:
        li = li.where(cond)
    return li.withColumnsRenamed({"l_suppkey": "StoreKey", "l_partkey": "ProductKey"})


def fact_columns() -> dict[str, tuple[list[str], Column]]:
    """The fact's columns by name, as (columns of ``fact_rows`` that the
    expression reads, expression)."""
    ship = F.col("l_shipdate").cast("date")
    qty = F.col("l_quantity").cast("bigint")
    price = F.col("l_extendedprice")
    disc = F.col("l_discount")
    returned = F.col("l_returnflag") == "R"
    return {
        "SalesKey": (["l_orderkey", "l_linenumber", "ProductKey", "StoreKey", "l_shipdate", "l_extendedprice"],
                     sales_key(F.col("l_orderkey"), F.col("l_linenumber"), F.col("ProductKey"),
                               F.col("StoreKey"), ship, price)),
        "DateKey": (["l_shipdate"], ship),
        "StoreKey": (["StoreKey"], F.col("StoreKey")),
        "ProductKey": (["ProductKey"], F.col("ProductKey")),
        "PromotionKey": (["l_discount"], F.lit(1) + F.round(disc * F.lit(100)).cast("int")),
        "UnitPrice": (["l_extendedprice", "l_quantity"], price / F.col("l_quantity")),
        "SalesQuantity": (["l_quantity"], qty),
        "ReturnQuantity": (["l_returnflag", "l_quantity"], F.when(returned, qty).otherwise(F.lit(0).cast("bigint"))),
        "ReturnAmount": (["l_returnflag", "l_extendedprice"], F.when(returned, price).otherwise(F.lit(0.0))),
        "DiscountQuantity": (["l_discount", "l_quantity"], F.when(disc > 0, qty).otherwise(F.lit(0).cast("bigint"))),
        "DiscountAmount": (["l_extendedprice", "l_discount"], price * disc),
        "SalesAmount": (["l_extendedprice", "l_discount"], price * (F.lit(1) - disc)),
    }


def fact_sales(spark: SparkSession, sf_dir: str, min_date: str | None = None,
               max_date: str | None = None) -> DataFrame:
    """FactSales stand-in: one row per line item, star keys (``l_orderkey``
    leads to the order's attributes) and measures.

    ``UnitCost``/``TotalCost`` come from the product dimension and are
    added by the star after that join.
    """
    return fact_rows(spark, sf_dir, min_date, max_date).select(
        "l_orderkey", *[c.alias(k) for k, (_, c) in fact_columns().items()])


def dim_subcategory(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ProductSubcategory: dense code of the part type, category = code % 3."""
    types = read_table(spark, sf_dir, "part", ["p_type"]).where("p_type IS NOT NULL").distinct()
    codes = dense_code(types, "p_type", out="ProductSubcategoryKey",
                       max_rows=counted_rows(spark, sf_dir, "part", "types", types))
    return codes.select(
        "ProductSubcategoryKey",
        F.col("p_type").alias("ProductSubcategoryName"),
        (F.col("ProductSubcategoryKey") % CATEGORY_MOD).alias("ProductCategoryKey"),
    )


def dim_category(spark: SparkSession, sf_dir: str) -> DataFrame:
    sub = dim_subcategory(spark, sf_dir)
    return sub.select("ProductCategoryKey").distinct().select(
        "ProductCategoryKey",
        F.concat(F.lit("Category "), F.col("ProductCategoryKey").cast("string"))
        .alias("ProductCategoryName"))


def dim_product(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = read_table(spark, sf_dir, "part",
                      ["p_partkey", "p_name", "p_brand", "p_type", "p_size", "p_retailprice"])
    sub = checked_broadcast(dim_subcategory(spark, sf_dir).select(
        F.col("ProductSubcategoryName").alias("_ptype"), "ProductSubcategoryKey"),
        dim_rows(spark, sf_dir, "subcategory"))
    k = F.col("p_partkey")
    unit = F.when(k % 4 == 0, F.lit(WEIGHT_UNIT_BY_MOD4[0])) \
        .when(k % 4 == 1, F.lit(WEIGHT_UNIT_BY_MOD4[1])) \
        .when(k % 4 == 2, F.lit(WEIGHT_UNIT_BY_MOD4[2]))
    joined = part.join(sub, part.p_type == sub._ptype, "left")
    return joined.select(
        k.alias("ProductKey"),
        F.col("p_name").alias("ProductName"),
        F.when(k % SUBCATEGORY_NULL_MOD == 0, F.lit(None).cast("int"))
        .otherwise(F.col("ProductSubcategoryKey")).alias("ProductSubcategoryKey"),
        F.when(k % BRAND_NULL_MOD == 0, F.lit(None).cast("string"))
        .otherwise(F.col("p_brand")).alias("BrandName"),
        F.nullif(k % 3, F.lit(0)).alias("ClassID"),
        F.nullif(k % 5, F.lit(0)).alias("StyleID"),
        F.nullif(k % 7, F.lit(0)).alias("ColorID"),
        F.col("p_size").cast("double").alias("Weight"),
        unit.alias("WeightUnitMeasureID"),
        (F.lit(1) + k % 3).alias("StockTypeID"),
        F.col("p_retailprice").alias("UnitCost"),
    )


def dim_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = read_table(spark, sf_dir, "supplier", ["s_suppkey", "s_name", "s_nationkey", "s_acctbal"])
    return s.select(
        F.col("s_suppkey").alias("StoreKey"),
        F.col("s_nationkey").alias("GeographyKey"),
        F.col("s_name").alias("StoreName"),
        (F.col("s_suppkey") % EMPLOYEE_MOD).cast("double").alias("EmployeeCount"),
        F.col("s_acctbal").alias("SellingAreaSize"),
        F.col("s_name").alias("CityName"),
    )


def dim_geography(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = read_table(spark, sf_dir, "nation", ["n_nationkey", "n_name", "n_regionkey"])
    r = read_table(spark, sf_dir, "region", ["r_regionkey", "r_name"])
    g = n.join(checked_broadcast(r, counted_rows(spark, sf_dir, "region")),
               n.n_regionkey == r.r_regionkey, "left")
    return g.select(
        F.col("n_nationkey").alias("GeographyKey"),
        F.lit(GEOGRAPHY_TYPE).alias("GeographyType"),
        F.col("r_name").alias("ContinentName"),
        F.col("n_name").alias("StateProvinceName"),
        F.col("n_name").alias("RegionCountryName"),
    )


def dim_channel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Channel dimension: the distinct order priorities (partial aggregate,
    a handful of rows)."""
    o = read_table(spark, sf_dir, "orders", ["o_orderpriority"]).distinct()
    return o.select(
        F.substring("o_orderpriority", 1, 1).cast("int").alias("ChannelKey"),
        F.substring("o_orderpriority", 3, 100).alias("ChannelName"))


def promotion_attrs(promo_key: Column) -> dict[str, Column]:
    """Promotion attributes as a function of the key (1 = no discount)."""
    pct = (promo_key - F.lit(1)).cast("string")
    return {
        "DiscountPercent": (promo_key - F.lit(1)).cast("double") / F.lit(100.0),
        "PromotionName": F.when(promo_key == 1, F.lit("No Discount"))
        .otherwise(F.concat(pct, F.lit("% Discount"))),
        "PromotionType": F.when(promo_key == 1, F.lit("No Discount"))
        .otherwise(F.lit("Volume Discount")),
    }


def date_attrs(date_col: str = "DateKey") -> dict[str, Column]:
    return calendar_parts(date_col)


def dim_promotion(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Promotion dimension as a table: a row for each key that occurs."""
    keys = fact_sales(spark, sf_dir).select("PromotionKey").distinct()
    return keys.select("PromotionKey", *[c.alias(k) for k, c in promotion_attrs(F.col("PromotionKey")).items()])


def dim_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Date dimension as a table: a row for each day from the first sale to the
    last."""
    spine = date_spine_of(fact_sales(spark, sf_dir).select("DateKey"))
    return spine.select("DateKey", *[c.alias(k) for k, c in calendar_parts("DateKey").items()])


# Row bounds of the dimensions.  A dimension that has a row for each row of a
# table is bounded by that table's count; one that is made of distinct values
# is counted itself, since its table can be as large as the fact.
DIM_SOURCE = {"product": "part", "store": "supplier", "geography": "nation", "orders": "orders"}
COUNTED = {"subcategory": ("part", "types", lambda s, d: read_table(s, d, "part", ["p_type"]).where("p_type IS NOT NULL").distinct()),
           "channel": ("orders", "channels", lambda s, d: read_table(s, d, "orders", ["o_orderpriority"]).distinct()),
           "promotion": ("lineitem", "promotions", dim_promotion),
           "date": ("lineitem", "days", dim_date)}


def dim_rows(spark: SparkSession, sf_dir: str, dim: str) -> int:
    if dim == "category":
        return min(CATEGORY_MOD, dim_rows(spark, sf_dir, "subcategory"))
    if dim in COUNTED:
        name, what, make = COUNTED[dim]
        return counted_rows(spark, sf_dir, name, what, make(spark, sf_dir))
    return counted_rows(spark, sf_dir, DIM_SOURCE[dim])
