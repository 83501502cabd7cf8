"""Order-independent sums and means of money kept as DOUBLE.

Adding doubles gives a different last digit for each order of addition, so a result
would change with the number of partitions. Adding DECIMALs does not. This is for money, whose
values have ``scale`` digits, to be named by the caller; other numbers are summed as they are (``total`` and ``mean``
without a scale).
"""

from pyspark.sql import Column
from pyspark.sql import functions as F


def dec(c: Column | str, scale: int) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return c.cast(f"decimal(18,{scale})")


def exact_sum(c: Column | str, scale: int) -> Column:
    return F.sum(dec(c, scale)).cast("double")


def exact_avg(c: Column | str, scale: int) -> Column:
    return exact_sum(c, scale) / F.count(c)


def total(c: Column | str, scale: int | None = None) -> Column:
    """The sum: of money with ``scale`` digits, or of numbers as they are."""
    return F.sum(c).cast("double") if scale is None else exact_sum(c, scale)


def mean(c: Column | str, scale: int | None = None) -> Column:
    return F.avg(c) if scale is None else exact_avg(c, scale)


def exact_stddev(c: Column | str, scale: int) -> Column:
    """Sample standard deviation from exact count, sum and sum of squares."""
    d = dec(c, scale)
    n = F.count(c)
    s = F.sum(d).cast("double")
    q = F.sum(d * d).cast("double")
    return F.when(n > 1, F.sqrt(F.greatest((q - s * s / n) / (n - 1), F.lit(0.0))))
