"""Shared helpers for registered queries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType


def round_doubles(df: DataFrame, digits: int = 6, exclude=()) -> DataFrame:
    """Round floating columns (output formatting for comparisons).  Columns
    computed exactly (``exclude``) are left as they are."""
    skip = set(exclude)
    return df.withColumns({f.name: F.round(F.col(f.name), digits)
                           for f in df.schema.fields
                           if isinstance(f.dataType, (DoubleType, FloatType))
                           and f.name not in skip})
