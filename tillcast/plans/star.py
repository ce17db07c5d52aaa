"""Denormalised wide tables (the ML star and the dashboard star)."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillcast import schema as S
from tillcast.operators.joins import DimSpec, build_star, left_join
from tillcast.sources import standin as st
from tillcast.sources.sample import sample_rows
from tillcast.sources.sinks import cache_key, materialize_filtered
from tillcast.sources.tables import data_version


def _sampled_fact(spark: SparkSession, sf_dir: str, ratio: float | None, seed: int,
                  min_date: str | None, max_date: str | None) -> DataFrame:
    """The rows that the fact's columns are computed from (``fact_columns``)."""
    rows = st.fact_rows(spark, sf_dir, min_date, max_date)
    if ratio is not None and ratio < 1.0:
        rows = sample_rows(rows, ratio, key_cols=[st.fact_columns()["SalesKey"][1]], seed=seed)
    return rows


def fact_measures(spark: SparkSession, sf_dir: str, ratio: float | None = None, seed: int = 42,
                  min_date: str | None = None, max_date: str | None = None) -> DataFrame:
    """The fact rows of ``denorm_ml`` with the same range and sample, before
    any dimension join.  The star's left joins are on unique dimension keys,
    so they keep this row multiset: statistics of fact measures (the
    outlier threshold) are computed here, on one narrow scan, instead of
    re-running the star."""
    rows = _sampled_fact(spark, sf_dir, ratio, seed, min_date, max_date)
    return rows.select(*[c.alias(k) for k, (_, c) in st.fact_columns().items()])


def hops(spark: SparkSession, sf_dir: str) -> dict[str, DimSpec]:
    """The stand-in's dimensions by name."""
    def hop(name: str, make, key: str, columns: list[str], **kw) -> DimSpec:
        return DimSpec(name, lambda: make(spark, sf_dir), key, columns, lambda: st.dim_rows(spark, sf_dir, name), **kw)

    return {d.name: d for d in (
        hop("orders", st.orders_channel, "l_orderkey", ["channelKey", "StoreType"], dim_key="o_orderkey", grows=True),
        hop("product", st.dim_product, "ProductKey",
            ["UnitCost", "ProductName", "ProductSubcategoryKey", "BrandName", "ClassID", "StyleID",
             "ColorID", "Weight", "WeightUnitMeasureID", "StockTypeID"]),
        hop("subcategory", st.dim_subcategory, "ProductSubcategoryKey", ["ProductSubcategoryName", "ProductCategoryKey"]),
        hop("category", st.dim_category, "ProductCategoryKey", ["ProductCategoryName"]),
        hop("store", st.dim_store, "StoreKey", ["GeographyKey", "StoreName", "EmployeeCount", "SellingAreaSize", "CityName"]),
        hop("geography", st.dim_geography, "GeographyKey", ["GeographyType", "ContinentName", "StateProvinceName", "RegionCountryName"]),
        hop("channel", st.dim_channel, "channelKey", ["ChannelName"], dim_key="ChannelKey"),
        hop("promotion", st.dim_promotion, "PromotionKey", ["DiscountPercent", "PromotionName", "PromotionType"]),
        hop("date", st.dim_date, "DateKey", list(st.date_attrs())),
    )}


def _projected() -> dict[str, tuple[list[str], Column]]:
    """The fact's columns, date and promotion attributes as expressions of its
    keys, and the total cost."""
    out = {k: v for k, v in st.fact_columns().items() if v[0] != [k]}
    out |= {k: (["DateKey"], c) for k, c in st.date_attrs("DateKey").items()}
    out |= {k: (["PromotionKey"], c) for k, c in st.promotion_attrs(F.col("PromotionKey")).items()}
    return out | {"TotalCost": (["UnitCost", "SalesQuantity"], F.col("UnitCost") * F.col("SalesQuantity"))}


def denorm_ml(spark: SparkSession, sf_dir: str, ratio: float | None = None, seed: int = 42,
              min_date: str | None = None, max_date: str | None = None,
              columns: Sequence[str] | None = None) -> DataFrame:
    """The ML wide table (40 columns, or those of ``columns``): fact + promotion
    + date + product + subcategory + store + geography.

    The category hop contributes only its key, which the subcategory
    already carries, so it is not joined here (redundant-join removal).
    """
    h = hops(spark, sf_dir)
    return build_star(_sampled_fact(spark, sf_dir, ratio, seed, min_date, max_date),
                      [h[k] for k in ("orders", "product", "subcategory", "store", "geography")],
                      list(columns or S.ML_COLUMNS), _projected())


def denorm_dashboard(spark: SparkSession, sf_dir: str, ratio: float | None = None,
                     seed: int = 42, min_date: str | None = None,
                     max_date: str | None = None, columns: Sequence[str] | None = None) -> DataFrame:
    """The dashboard wide table: channel (differently named key), promotion,
    date, product, subcategory, category, store, geography."""
    h = hops(spark, sf_dir)
    wanted = list(columns or S.DASHBOARD_COLUMNS)
    # the two spellings of the channel's key are one name to Spark
    star = build_star(_sampled_fact(spark, sf_dir, ratio, seed, min_date, max_date),
                      [h[k] for k in ("orders", "channel", "product", "subcategory", "category", "store", "geography")],
                      ["channelKey" if c == "ChannelKey" else c for c in wanted], _projected())
    return star.toDF(*wanted)


def _cached(spark: SparkSession, sf_dir: str, what: str, build, ratio: float | None,
            min_date: str | None, max_date: str | None) -> DataFrame:
    tables = ("lineitem", "orders", "customer", "part", "supplier", "nation", "region")
    key = cache_key(what, sf_dir, ratio, data_version(spark, sf_dir, tables))
    return materialize_filtered(spark, key, lambda: build(spark, sf_dir, ratio=ratio), min_date, max_date)


def get_ml(spark: SparkSession, sf_dir: str, min_date: str | None = None, max_date: str | None = None,
           ratio: float | None = None) -> DataFrame:
    """The ML table of a date range, from the stored star (built on first use,
    and again when the tables have changed)."""
    return _cached(spark, sf_dir, "ml", denorm_ml, ratio, min_date, max_date)


def get_dashboard(spark: SparkSession, sf_dir: str, min_date: str | None = None, max_date: str | None = None,
                  ratio: float | None = None) -> DataFrame:
    return _cached(spark, sf_dir, "dashboard", denorm_dashboard, ratio, min_date, max_date)


def join_bushy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dimension joined to dimension first (store with geography), then the
    fact with the result."""
    store_geo = left_join(st.dim_store(spark, sf_dir), st.dim_geography(spark, sf_dir),
                          "GeographyKey", max_rows=st.dim_rows(spark, sf_dir, "geography"))
    fact = st.fact_sales(spark, sf_dir)
    return left_join(fact.select("SalesKey", "DateKey", "StoreKey", "SalesAmount"),
                     store_geo.select("StoreKey", "StoreName", "RegionCountryName",
                                      "ContinentName"), "StoreKey",
                     max_rows=st.dim_rows(spark, sf_dir, "store"))
