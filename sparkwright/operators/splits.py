"""Reproducible splits and samples.

A row's side depends only on its key and the seed: the first 8 hex digits
of md5(key || '|' || seed) compared with the fraction of 2^32 written as 8
hex digits.  Same rows under any partitioning or row order, and the same rows
in any engine that has md5 (``randomSplit`` changes with partitioning).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkwright.functions.exprs import join_groups
from sparkwright.operators.selection import place_among, select_kth
from sparkwright.session import materialize


def hex_threshold(fraction: float) -> str:
    """Fraction of 2^32 as 8 lowercase hex digits (0.8 -> 'cccccccc')."""
    v = min(max(int(fraction * 2 ** 32), 0), 2 ** 32 - 1)
    return f"{v:08x}"


def hash_key(key: str, seed: int | str) -> Column:
    return F.substring(F.md5(F.concat(F.col(key).cast("string"), F.lit(f"|{seed}"))), 1, 8)


def random_split(df: DataFrame, key: str, weights: list[float], seed: int = 42) -> list[DataFrame]:
    """Split by cumulative weights, e.g. [0.8, 0.2]; sides are disjoint
    and their union is the input."""
    total = float(sum(weights))
    h = hash_key(key, seed)
    out, lo = [], None
    acc = 0.0
    for i, w in enumerate(weights):
        acc += w / total
        hi = None if i == len(weights) - 1 else hex_threshold(acc)
        cond = F.lit(True)
        if lo is not None:
            cond = cond & (h >= F.lit(lo))
        if hi is not None:
            cond = cond & (h < F.lit(hi))
        out.append(df.where(cond))
        lo = hi
    return out


def assign_split(df: DataFrame, key: str, test_fraction: float, seed: int = 42, out: str = "is_test") -> DataFrame:
    """H10 as a column: 1 for the test side, 0 for train."""
    return df.withColumn(out, (hash_key(key, seed) < F.lit(hex_threshold(test_fraction))).cast("int"))


def sample_by(df: DataFrame, key: str, label: str, fractions: dict, seed: int = 42) -> DataFrame:
    """Keep each class with its own fraction (absent class -> dropped,
    as with ``sampleBy``)."""
    thr = F.create_map(*[x for k, v in fractions.items() for x in (F.lit(k), F.lit(hex_threshold(v)))])
    return df.where(hash_key(key, seed) < thr[F.col(label)])


def stratified_split(df: DataFrame, key: str, label: str, test_fraction: float, seed: int = 42,
                     exact: bool = True, out: str = "is_test") -> DataFrame:
    """H9: per class, the test side holds round(fraction * class size) rows
    (exact) - the rows with the smallest hashes - or, when not exact, each row
    independently by the hash threshold.  The exact form finds one threshold
    (hash, then key) per class by digit histograms and filters: no class is
    sorted or gathered.  Rows that repeat a key fall on one side."""
    if not exact:
        return assign_split(df, key, test_fraction, seed, out)
    digits = F.conv(hash_key(key, seed), 16, 10).cast("bigint")
    rows = materialize(df.select(label, F.col(key).alias("_key"), digits.alias("key")))
    wanted = materialize(rows.groupBy(label).agg(F.count(F.lit(1)).alias("_n"))
                         .select(label, F.round(F.col("_n") * F.lit(test_fraction)).cast("bigint").alias("k"))
                         .where("k > 0"))
    # 32-bit hashes; rows with the threshold's hash are few and go by key.
    at = select_kth(rows, wanted, [label], bits=32).select(label, F.col("key").alias("_edge"), "rest")
    tied = join_groups(rows, at, [label], "inner").where("key = _edge")
    cut = place_among(tied, [label, "_edge"], "_key").withColumnRenamed("_key", "_last")
    side = (F.col("_h") < F.col("_edge")) | ((F.col("_h") == F.col("_edge")) & (F.col(key) <= F.col("_last")))
    return (join_groups(df.withColumn("_h", digits), materialize(cut), [label])
            .withColumn(out, F.coalesce(side, F.lit(False)).cast("int")).drop("_h", "_edge", "_last"))
