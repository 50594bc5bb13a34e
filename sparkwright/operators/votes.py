"""Thresholds and ensembles over score columns."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def threshold(p, e: float) -> Column:
    """1.0 if p >= e else 0.0; a null probability stays null."""
    p = F.col(p) if isinstance(p, str) else p
    return F.when(p.isNull(), F.lit(None).cast("double")).when(p >= F.lit(e), 1.0).otherwise(0.0)


def mean_of(cols: list[str]) -> Column:
    """Plain mean of score columns."""
    return reduce(lambda a, b: a + b, [F.col(c) for c in cols]) / F.lit(float(len(cols)))


def any_flag(cols: list[str]) -> Column:
    """Bitwise OR of 0/1 flags, as double."""
    return reduce(lambda a, b: a.bitwiseOR(b), [F.col(c).cast("int") for c in cols]).cast("double")


def weighted_vote(weights: dict[str, float]) -> Column:
    """sum(w * c) / sum(w)."""
    num = reduce(lambda a, b: a + b, [F.col(c) * F.lit(float(w)) for c, w in weights.items()])
    return num / F.lit(float(sum(weights.values())))


def class_weights(df: DataFrame, label: str, weights: dict, out: str = "weight",
                  default: float | None = None) -> DataFrame:
    """Per-row weight by label from a literal map."""
    m = F.create_map(*[x for k, v in weights.items() for x in (F.lit(k), F.lit(float(v)))])
    w = m[F.col(label)]
    if default is not None:
        w = F.coalesce(w, F.lit(float(default)))
    return df.withColumn(out, w)
