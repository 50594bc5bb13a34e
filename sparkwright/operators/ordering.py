"""Exact running totals and ranks without a single-group window.

A window ``partitionBy(g).orderBy(o)`` sends each group to one task; with a hot
group holding a third of the rows that task does a third of the job.  Here the
order is cut into buckets at points (whole tuples of the order columns) taken
from a bounded sample, so a group spreads over all buckets, also where most
rows agree in the first order column.  The input is stored once; the cut points
are literals in the plan, searched by halving.  Each (group, bucket) starts
from the total of the group's earlier buckets: that total enters the window as
a row of its own, before the bucket's rows, so the data is exchanged once and
never joined.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sparkwright.functions.exprs import join_groups
from sparkwright.operators.selection import quantiles
from sparkwright.session import materialize

#: Sampled rows per cut point, and sampled rows at most (they go to the driver).
SAMPLE_PER_CUT = 50
MOST_SAMPLED = 100_000


def _n_partitions(df: DataFrame, n: int | None) -> int:
    if n:
        return n
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))


def _cut_points(df: DataFrame, order_cols: list[str], part_cols: list[str], buckets: int) -> list[tuple]:
    """Up to ``buckets`` - 1 ascending tuples of the order columns, from the
    rows with the smallest hashes (the order and group columns identify a row,
    so this is a uniform sample, the same in every run)."""
    order = [F.col(f"`{c}`") for c in order_cols]
    few = (df.select(*order, F.xxhash64(*part_cols, *order_cols).alias("_s"))
           .orderBy("_s", *order).limit(min(MOST_SAMPLED, buckets * SAMPLE_PER_CUT))
           .orderBy(*order).select(*order).collect())
    values = [tuple(few[i * len(few) // buckets]) for i in range(1, buckets)] if few else []
    return [v for i, v in enumerate(values) if i == 0 or v != values[i - 1]]


def _bucket(order_cols: list[str], cuts: list[tuple], kinds: dict[str, str]) -> Column:
    """Number of cut points below the row (nulls first), by binary search in a
    constant array."""
    if not cuts:
        return F.lit(0)
    points = F.array(*[F.struct(*[F.lit(v).cast(kinds[c]).alias(f"o{i}") for i, (c, v) in enumerate(zip(order_cols, cut))])
                       for cut in cuts])
    row = F.struct(*[F.col(f"`{c}`").alias(f"o{i}") for i, c in enumerate(order_cols)])
    steps = F.array(*[F.lit(1 << k) for k in reversed(range(len(cuts).bit_length()))])
    return F.aggregate(steps, F.lit(0), lambda at, step: F.when(
        (at + step <= len(cuts)) & (F.get(points, at + step - 1) < row), at + step).otherwise(at))


def running_total(df: DataFrame, order_cols: list[str], weight: str | None = None,
                  part_cols: list[str] | tuple = (), out: str = "_run",
                  num_partitions: int | None = None) -> DataFrame:
    """Add ``out`` = inclusive running sum of ``weight`` (1 per row when None)
    within ``part_cols`` in ascending ``order_cols`` order, nulls first.
    ``order_cols`` (with ``part_cols``) must identify rows uniquely for a
    deterministic result; a null group is a group like any other.  ``df`` is
    stored once (pass the columns that are needed), then read for the cut
    points, the totals and the rows."""
    part_cols = list(part_cols)
    df = materialize(df)
    # More buckets than partitions, so that hashing spreads them evenly.
    buckets = 2 * _n_partitions(df, num_partitions)
    cuts = _cut_points(df, order_cols, part_cols, buckets)
    x = df.withColumns({"_bucket": _bucket(order_cols, cuts, dict(df.dtypes)),
                        "_w": F.col(weight) if weight else F.lit(1).cast("long"), "_first": F.lit(1)})
    # One row per group and bucket, combined map-side.
    totals = x.groupBy(*part_cols, "_bucket").agg(F.sum("_w").alias("_total"))
    earlier = Window.partitionBy(*part_cols).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = (totals.withColumn("_w", F.sum("_total").over(earlier)).where(F.col("_w").isNotNull())
              .select(*part_cols, "_bucket", "_w", F.lit(0).alias("_first")))
    inside = (Window.partitionBy(*part_cols, "_bucket").orderBy("_first", *order_cols)
              .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return (x.unionByName(starts, allowMissingColumns=True).withColumn(out, F.sum("_w").over(inside))
            .where("_first = 1").select(*[F.col(f"`{c}`") for c in df.columns if c != out], out))


def row_number_exact(df: DataFrame, order_cols: list[str], part_cols=(), out: str = "rn",
                     num_partitions: int | None = None) -> DataFrame:
    """1-based row number within ``part_cols``; skew-safe."""
    return running_total(df, order_cols, None, part_cols, out, num_partitions)


def rank_table(df: DataFrame, value: str, part_cols=(), out: str = "rank",
               num_partitions: int | None = None) -> DataFrame:
    """(*part_cols, value, out): the average rank of every distinct value within
    ``part_cols`` (ties share the mean of their positions)."""
    part_cols = list(part_cols)
    counts = (df.where(F.col(value).isNotNull())
              .groupBy(*part_cols, value).agg(F.count(F.lit(1)).alias("_cnt")))
    ranked = running_total(counts, [value], "_cnt", part_cols, "_cum", num_partitions)
    return ranked.select(*part_cols, value, (F.col("_cum") - (F.col("_cnt") - 1) / 2.0).alias(out))


def average_rank(df: DataFrame, value: str, part_cols=(), out: str = "rank",
                 num_partitions: int | None = None) -> DataFrame:
    """``df`` with the average rank of ``value`` within ``part_cols``, as Spearman
    correlation needs.  Nulls get no rank.  The rank table has one row per
    distinct value: the planner broadcasts it when it is small; otherwise it is
    a shuffle join whose hot keys AQE splits."""
    return join_groups(df, rank_table(df, value, part_cols, out, num_partitions), [*part_cols, value])


def exact_quantiles(df: DataFrame, value: str, probs: list[float], part_cols=(),
                    num_partitions: int | None = None) -> DataFrame:
    """Linear-interpolated quantiles per group, by digit histograms; these need
    no number of partitions (see ``selection.quantiles``)."""
    return quantiles(df, value, probs, part_cols)
