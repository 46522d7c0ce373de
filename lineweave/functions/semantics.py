"""Column helpers whose rounding, null and tie rules are fixed, so that two engines give the same value.

* ``rnd`` rounds a double after scaling it in binary, halves away from zero (1.005 to two places is 1.0);
* ``whole`` casts to a whole number by rounding halves to even;
* ``counting`` is a half-open range and empty when it would run backwards;
* aggregates that pick a value skip null values, and say how ties are decided.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def rnd(x: Column, places: int = 0) -> Column:
    """Round a double; null stays null."""
    x = x.cast("double")
    return F.round(x * F.lit(10.0**places)) / F.lit(10.0**places) if places else F.round(x)


def whole(x: Column) -> Column:
    return F.rint(x).cast("long")


def counting(low: Column, high: Column) -> Column:
    """low, low + 1, ... up to but without high; null (which ``explode`` drops) when that is nothing."""
    return F.when(high > low, F.sequence(low, high - 1))


def any_known(x: Column) -> Column:
    """Some value of the group that isn't null."""
    return F.any_value(x, F.lit(True))


def least_by(x: Column, *by: Column) -> Column:
    """The value that isn't null where ``by`` is smallest."""
    return F.min_by(x, F.when(x.isNotNull() & by[0].isNotNull(), F.struct(*by)))


def known(p: Column) -> Column:
    """A condition with null read as false."""
    return F.coalesce(p, F.lit(False))


def where(p: Column, x: Column | None = None) -> Column:
    """For an aggregate over the rows that meet a condition: the value there, else null."""
    return F.when(p, F.lit(1) if x is None else x)


def count_where(p: Column) -> Column:
    return F.count(F.when(p, F.lit(1)))


def ratio(a: Column, b: Column) -> Column:
    """a / b as double; null where b is null or 0."""
    return a.cast("double") / F.nullif(b.cast("double"), F.lit(0.0))


def miles(feet: Column, places: int = 1) -> Column:
    """Summed feet as miles; the sum is decimal, so that it doesn't depend on the order of rows."""
    return rnd(F.sum(feet.cast("decimal(18,4)")).cast("double") / F.lit(5280.0), places)


def share_of_total(counted: DataFrame, n: str = "n", places: int = 1) -> Column:
    """Percent of the total of few, already counted rows."""
    return rnd(F.lit(100.0) * F.col(n) / F.sum(n).over(Window.partitionBy()), places)


def tier(x: Column, steps: list[tuple[float, str]], last: str) -> Column:
    """The name of the first step whose upper bound isn't below the value."""
    out = None
    for most, name in steps:
        out = F.when(x <= most, name) if out is None else out.when(x <= most, name)
    return out.otherwise(last)
