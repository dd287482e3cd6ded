"""Output shaping shared by the registered queries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def round_zero(c, digits: int = 6):
    """Round, with -0.0 written as 0.0 (a true zero can come out as -1e-17)."""
    r = F.round(c, digits)
    return F.when(r == 0, F.lit(0.0)).otherwise(r)


def round_doubles(df: DataFrame, digits: int = 6, keep: tuple = ()) -> DataFrame:
    """Round every double/float column (cross-engine float noise stays below)
    but ``keep``: a value that can stand on a rounding tie is given as it is."""
    return df.select(*[
        round_zero(F.col(f"`{f.name}`"), digits).alias(f.name)
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)) and f.name not in keep
        else F.col(f"`{f.name}`")
        for f in df.schema.fields])
