"""Missing values, safe arithmetic and null-safe comparison: the conventions of every market operator.

Missing is NULL, never NaN; a division by zero is NULL; a comparison with NULL is false before it is negated.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def nan_to_null(df: DataFrame) -> DataFrame:
    """NaN and infinities of float columns as NULL."""
    odd = [float("inf"), float("-inf")]
    return df.withColumns({c: F.when(~F.isnan(c) & ~F.col(c).isin(odd), F.col(c)) for c, t in df.dtypes if t in ("double", "float")})


def ratio(a: Column, b: Column) -> Column:
    """a / b, NULL where b is 0."""
    return F.try_divide(a.cast("double"), b.cast("double"))


def ieee_ratio(a: Column, b: Column) -> Column:
    """a / b as SQL engines without a check divide: infinite where b is 0, NaN for 0 / 0. For queries held against such SQL."""
    a, b = a.cast("double"), b.cast("double")
    return F.when(b == 0, a * float("inf")).otherwise(F.try_divide(a, b))


def ieee_log(x: Column) -> Column:
    """The natural logarithm as SQL engines without a check take it: -infinity of 0, NaN of less. Spark's is NULL there."""
    return F.when(x == 0, float("-inf")).when(x < 0, float("nan")).otherwise(F.log(x))


def holds(condition: Column) -> Column:
    """False where the condition is unknown."""
    return F.coalesce(condition, F.lit(False))


def floor_at(x: Column, least: float) -> Column:
    """x but at least least; NULL stays NULL."""
    return F.when(x.isNotNull(), F.greatest(x, F.lit(least)))


def clip(x: Column, low: float, high: float) -> Column:
    return F.when(x.isNotNull(), F.least(F.greatest(x, F.lit(low)), F.lit(high)))


def half_up(x: Column, digits: int) -> Column:
    """x rounded to digits, ties up, by arithmetic that SQL engines share. What has no digits behind the point, infinities and NaN
    included, stays: a floor is a bigint in Spark."""
    unit = 10.0**digits
    y = x * unit + 0.5
    return F.when(F.abs(y) < 2.0**52, F.floor(y).cast("double")).otherwise(y) / unit


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Doubles rounded for comparison, so that results don't depend on the order of sums. Queries use it last; operators don't."""
    return df.withColumns({c: half_up(F.col(c), digits) for c, t in df.dtypes if t == "double"})
