"""Chart-ready series (G2-G5): bounded aggregates computed in Spark; drawing
is left to the caller.  A scatter of millions of points is reduced to a
2-D grid of counts, so what reaches a plotting library is bounded by the
grid size, not the data."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkwright.functions.exprs import safe_div
from sparkwright.session import materialize


def _axis_bin(v: str, lo: float, hi: float, bins: int):
    if hi is None or lo is None or hi == lo:
        return F.lit(1)
    raw = F.floor((F.col(v) - F.lit(lo)) * bins / F.lit(hi - lo)) + 1
    return F.least(raw, F.lit(bins)).cast("int")


def scatter_grid(df: DataFrame, x: str, y: str, bins: int = 20, by: str | None = None) -> DataFrame:
    """([by,] bin_x, bin_y, x_lo, y_lo, count) over an equal-width grid,
    the same for every value of ``by``; rows with a null coordinate are dropped.  The four range numbers come from one
    aggregate and enter the binning as literals."""
    grp = [by] if by else []
    pts = df.select(*grp, F.col(x).cast("double").alias("x"), F.col(y).cast("double").alias("y")).na.drop(subset=["x", "y"])
    r = pts.agg(F.min("x").alias("x0"), F.max("x").alias("x1"), F.min("y").alias("y0"), F.max("y").alias("y1")).first()
    x0, x1, y0, y1 = r["x0"], r["x1"], r["y0"], r["y1"]
    g = (pts.select(*grp, _axis_bin("x", x0, x1, bins).alias("bin_x"), _axis_bin("y", y0, y1, bins).alias("bin_y"))
         .groupBy(*grp, "bin_x", "bin_y").agg(F.count(F.lit(1)).alias("count")))
    wx = ((x1 - x0) / bins) if x0 is not None else 0.0
    wy = ((y1 - y0) / bins) if y0 is not None else 0.0
    return g.select(*grp, "bin_x", "bin_y", (F.lit(x0) + (F.col("bin_x") - 1) * F.lit(wx)).alias("x_lo"),
                    (F.lit(y0) + (F.col("bin_y") - 1) * F.lit(wy)).alias("y_lo"), "count")


def line_series(df: DataFrame, x: str, y: str) -> DataFrame:
    """(x, y_mean, n) with one point per x (mean when x repeats)."""
    return df.groupBy(x).agg(F.avg(y).alias("y_mean"), F.count(F.lit(1)).alias("n"))


def pie_series(df: DataFrame, name: str, value: str) -> DataFrame:
    """(name, total, share) where share = total / grand total, the sum of
    the totals (one pass over the rows)."""
    g = materialize(df.groupBy(name).agg(F.sum(value).alias("total")))
    grand = g.agg(F.sum("total")).first()[0]
    share = safe_div(F.col("total").cast("double"), F.lit(float(grand)) if grand is not None else F.lit(None))
    return g.select(name, "total", share.cast("double").alias("share"))


def bar_series(df: DataFrame, x: str, y: str, stack: str | None = None) -> DataFrame:
    """Sum of y per x (and per stack category for a stacked bar)."""
    keys = [x] + ([stack] if stack else [])
    return df.groupBy(*keys).agg(F.sum(y).alias("total"))
