"""Exact order statistics of any numeric column (A08), without a sort and with bounded state.

``percentile`` and ``median`` keep an entry per distinct value. Here the rank is closed in on:
an approximate percentile gives two pivots a little below and above the rank, one aggregate counts
what lies below, at, between and above them, and the part that holds the rank is looked at
next. A part shrinks to a few thousandths each time, whatever the values are, and a value
that a third of all rows share is a pivot's own part. At most ``FEW`` values are fetched.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

FEW = 10_000               # values sorted on the driver at the end
ACCURACY = 10_000          # of the approximate percentiles


def nth(values: DataFrame, k: int, n: int, few: int = FEW):
    """The k-th smallest (from 0) of the n values of the column ``v`` (no NULLs)."""
    low = high = None                                        # the rank lies between these, without them
    while True:
        part = values
        if low is not None:
            part = part.where(F.col("v") > F.lit(low))
        if high is not None:
            part = part.where(F.col("v") < F.lit(high))
        if n <= few:
            return sorted(r.v for r in part.collect())[k]
        share, slack = (k + 0.5) / n, 2.0 / ACCURACY
        a, b = part.agg(F.percentile_approx("v", [max(0.0, share - slack), min(1.0, share + slack)], ACCURACY)).first()[0]
        v = F.col("v")
        at = part.agg(*[F.count(F.when(c, 1)) for c in (v < a, v == a, (v > a) & (v < b), (v == b) & F.lit(b > a))]).first()
        parts = [(None, at[0], (low, a)), (a, at[1], None), (None, at[2], (a, b)), (b, at[3], None),
                 (None, n - sum(at), (b, high))]
        for value, size, ends in parts:
            if k < size:
                break
            k -= size
        if value is not None:
            return value
        n, (low, high) = size, ends


def exact_median(df: DataFrame, column: str, few: int = FEW) -> float | None:
    """The mean of the two middle values as a double; NULL and NaN values are left out; None
    without values."""
    values = df.select(F.col(column).cast("double").alias("v")).where("v IS NOT NULL AND NOT isnan(v)")
    n = values.count()
    if n == 0:
        return None
    middle = nth(values, (n - 1) // 2, n, few)
    return middle if n % 2 else (middle + nth(values, n // 2, n, few)) / 2.0
