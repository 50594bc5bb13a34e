"""Mergeable sketches, stored per day or partition and merged later without the
rows (the scale option of A4, A7 and A8).

Quantile sketches (KLL) answer any probability with a bounded rank error, and
distinct-count sketches (HyperLogLog) with a bounded relative error; both merge
without loss, so a table of daily sketches answers questions over any span of
days or classes from a few kilobytes a day.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Size of a quantile sketch: a rank error of about 0.7 %.
QUANTILE_K = 400
#: Log2 of the registers of a distinct sketch: a relative error of about 0.8 %.
DISTINCT_LG = 14


def sketch(df: DataFrame, keys: list[str], quantiles: list[str] = (), distinct: list[str] = (),
           k: int = QUANTILE_K, lg: int = DISTINCT_LG) -> DataFrame:
    """A row per group of ``keys``: rows, a sketch ``q_<column>`` of the values
    and a sketch ``d_<column>`` of the different values.  Nulls count in
    neither; partial sketches are built map-side, so a hot group is too."""
    aggs = [F.count(F.lit(1)).alias("rows")]
    aggs += [F.kll_sketch_agg_double(F.col(c).cast("double"), F.lit(k)).alias(f"q_{c}") for c in quantiles]
    aggs += [F.hll_sketch_agg(c, F.lit(lg)).alias(f"d_{c}") for c in distinct]
    return df.groupBy(*keys).agg(*aggs)


def store(sketches: DataFrame, path: str, by: str) -> None:
    """Store sketches in partitions of ``by`` (a day); a partition that is
    written again is replaced, so late data only rebuilds its day."""
    (sketches.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(by).parquet(path))


def merge(sketches: DataFrame, keys: list[str] = ()) -> DataFrame:
    """Sketches of coarser groups, from sketches alone."""
    aggs = [F.sum("rows").alias("rows")]
    for c in sketches.columns:
        if c.startswith("q_"):
            aggs.append(F.kll_merge_agg_double(c).alias(c))
        elif c.startswith("d_"):
            aggs.append(F.hll_union_agg(c).alias(c))
    return sketches.groupBy(*keys).agg(*aggs)


def quantile_estimates(sketches: DataFrame, column: str, probs: list[float], keys: list[str] = ()) -> DataFrame:
    """(*keys, n, prob, quantile): the values seen and the estimates."""
    q = F.col(f"q_{column}")
    asked = F.array(*[F.struct(F.lit(float(p)).alias("prob"),
                               F.kll_sketch_get_quantile_double(q, F.lit(float(p))).alias("quantile")) for p in probs])
    return sketches.select(*keys, F.kll_sketch_get_n_double(q).alias("n"), F.inline(asked))


def distinct_estimate(sketches: DataFrame, column: str, keys: list[str] = ()) -> DataFrame:
    return sketches.select(*keys, F.hll_sketch_estimate(f"d_{column}").alias(column))
