"""Row-level scalar transforms, all built-in expressions (codegen'd)."""

from __future__ import annotations

from typing import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType, StringType

from tillcast import schema as S


def drop_columns(df: DataFrame, *cols: str) -> DataFrame:
    """Drop columns; absent names are ignored (``Unnamed: 0`` etc.)."""
    return df.drop(*cols)


def rename_column(df: DataFrame, old: str, new: str) -> DataFrame:
    return df.withColumnRenamed(old, new)


def sanitize_name(name: str) -> str:
    """space -> ``_``; ``.`` and ``/`` removed (``N/A`` -> ``NA``)."""
    return name.replace(" ", "_").replace(".", "").replace("/", "")


def sanitize_columns(df: DataFrame) -> DataFrame:
    return df.toDF(*[sanitize_name(c) for c in df.columns])


def impute_const(df: DataFrame, cols: Iterable[str] = S.IMPUTE_ZERO_COLUMNS,
                 value: float = 0) -> DataFrame:
    present = [c for c in cols if c in df.columns]
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(value).cast(df.schema[c].dataType))
                           for c in present})


def fill_na_label(df: DataFrame, col: str = "BrandName", label: str = S.BRAND_FILL) -> DataFrame:
    return df.withColumn(col, F.coalesce(F.col(col), F.lit(label)))


# ASCII whitespace as Python's str.strip() sees it.
WHITESPACE = " \t\n\r\x0b\x0c\x1c\x1d\x1e\x1f"


def strip(c: Column) -> Column:
    """Strip leading/trailing whitespace (tabs and newlines too)."""
    return F.btrim(c, F.lit(WHITESPACE))


def strip_strings(df: DataFrame, exclude: Iterable[str] = ("DateKey", "SalesKey")) -> DataFrame:
    skip = set(exclude)
    cols = [f.name for f in df.schema.fields
            if isinstance(f.dataType, StringType) and f.name not in skip]
    return df.withColumns({c: strip(F.col(c)) for c in cols})


def promo_flag(c: Column) -> Column:
    """1 when the promotion key is 1 (no discount), else 0 (null -> 0)."""
    return F.when(c == 1, F.lit(1)).otherwise(F.lit(0))


def stock_swap(c: Column, mapping: dict = S.STOCK_SWAP) -> Column:
    """Swap codes per ``mapping`` (1 <-> 3); other values unchanged."""
    expr = None
    for k, v in mapping.items():
        expr = (F.when(c == k, F.lit(v)) if expr is None else expr.when(c == k, F.lit(v)))
    return expr.otherwise(c)


def weight_to_grams(weight: Column, unit: Column,
                    factors: dict[str, float] = S.WEIGHT_FACTORS) -> Column:
    """Weight times the unit factor; other or null unit -> null."""
    factor = None
    for u, f in factors.items():
        factor = F.when(unit == u, F.lit(f)) if factor is None else factor.when(unit == u, F.lit(f))
    return weight.cast("double") * factor


def quarter_number(label: Column) -> Column:
    """First digit of a quarter label (``Q3`` -> 3); no digit -> null."""
    return F.regexp_extract(label, r"(\d)", 1).try_cast("int")


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, NumericType)]


def select_numeric(df: DataFrame) -> DataFrame:
    return df.select(*numeric_columns(df))


def select_facts(df: DataFrame, with_datekey: bool = False) -> DataFrame:
    cols = (["DateKey"] if with_datekey else []) + S.FACT_COLUMNS
    return df.select(*cols)


def parse_date(c: Column, fmt: str = "yyyy-MM-dd") -> Column:
    return F.to_date(c, fmt)
