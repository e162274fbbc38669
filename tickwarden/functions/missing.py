"""Missing numbers: NaN counts as NULL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def number(column: str) -> Column:
    """The column as a double, NULL where it is NaN."""
    value = F.col(column).cast("double")
    return F.when(~F.isnan(value), value)


def without_nan(df: DataFrame, columns) -> DataFrame:
    """The table with NaN in the named floating columns turned into NULL."""
    kinds = {f.name: f.dataType for f in df.schema.fields}
    floating = [c for c in columns if isinstance(kinds[c], (T.DoubleType, T.FloatType))]
    return df.withColumns({c: F.when(~F.isnan(c), F.col(c)) for c in floating}) if floating else df
