"""Exact medians without gathering a column: counts in bins of a narrowing range, then the few values left."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BINS = 4096
#: Values at most that are fetched in the end, unless they are neighbouring doubles, of which a bin holds few.
FETCHED = 10_000


def exact_median(df: DataFrame, value: Column) -> float | None:
    """The median of the finite values; None if there are none. With an even number, the mean of the two in the middle.

    Each pass counts the values of the range in BINS bins (partial aggregates, at most BINS rows to the driver) and goes
    on in the one bin of the middle rank. A range shrinks BINS-fold in each pass, so a few passes do for any number of
    rows, and a range too narrow to be cut holds no more than a few thousand different doubles.
    """
    source = df.select(value.cast("double").alias("v")).filter("v is not null and not isnan(v) and abs(v) < double('Infinity')")
    n, lo, hi = source.agg(F.count("v"), F.min("v"), F.max("v")).first()
    if not n:
        return None
    low = _ranked(source, (n - 1) // 2, lo, hi)
    if n % 2:
        return low
    upto, above = source.agg(F.count_if(F.col("v") <= low), F.min(F.when(F.col("v") > low, F.col("v")))).first()
    return low if upto > n // 2 else low / 2 + above / 2 if abs(low) > 1e300 else (low + above) / 2


def _ranked(source: DataFrame, rank: int, lo: float, hi: float) -> float:
    """The value with so many values before it in order; all lie between lo and hi."""
    below = 0
    while lo < hi:
        part = source.filter(F.col("v").between(lo, hi))
        # Halves, so that the range of all doubles does not overflow.
        width = hi / 2 / BINS - lo / 2 / BINS
        if width <= 0 or lo / 2 + width <= lo / 2:
            break
        b = F.least(F.floor((F.col("v") / 2 - lo / 2) / width), F.lit(BINS - 1)).alias("b")
        bins = sorted(part.groupBy(b).agg(F.count("v").alias("c"), F.min("v").alias("lo"), F.max("v").alias("hi")).collect(), key=lambda r: r["b"])
        for r in bins:
            if below + r["c"] > rank:
                break
            below += r["c"]
        lo, hi = r["lo"], r["hi"]
        if r["c"] <= FETCHED:
            break
    if lo == hi:
        return float(lo)
    for r in sorted(source.filter(F.col("v").between(lo, hi)).groupBy("v").agg(F.count("v").alias("c")).collect(), key=lambda r: r["v"]):
        below += r["c"]
        if below > rank:
            return float(r["v"])
    raise AssertionError("ranks lie within the rows")
