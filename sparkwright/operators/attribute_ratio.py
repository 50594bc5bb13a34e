"""Attribute-ratio feature selection.

numeric f : max over classes k of avg(f | k) / avg(f); null (zero global mean
            or no values) -> 0.0 after the max.
binary  b : per class sum(b) / (count(b) - sum(b)); null (no zeros) -> 1000.0
            before the max, then max over classes.

One grouped aggregate per class gives every (sum, count) needed; the global
mean is derived from the class sums, so the input is scanned once and only a
table of #classes rows is reshaped afterwards.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sparkwright.functions.exprs import safe_div

# Fixed value: the ratio a binary feature gets in a class that has no zeros.
NO_ZERO_RATIO = 1000.0


def attribute_ratio(df: DataFrame, numeric: list[str], binary: list[str], label: str) -> DataFrame:
    """Long table (feature, kind, position, ratio), one row per feature."""
    aggs = []
    for c in numeric + binary:
        x = F.col(c).cast("double")
        aggs += [F.sum(x).alias(f"{c}__s"), F.count(x).alias(f"{c}__n")]
    per_class = df.groupBy(label).agg(*aggs)
    feats = [(c, "numeric", i) for i, c in enumerate(numeric)] + \
            [(c, "binary", len(numeric) + i) for i, c in enumerate(binary)]
    rows = [F.struct(F.lit(c).alias("feature"), F.lit(k).alias("kind"), F.lit(p).alias("position"),
                     F.col(f"`{c}__s`").alias("s"), F.col(f"`{c}__n`").alias("n"))
            for c, k, p in feats]
    long = per_class.select(label, F.inline(F.array(*rows)))
    # Global mean of each feature from the class sums: a window over the tiny
    # (#classes x #features) table, so the input is aggregated exactly once.
    by_feature = Window.partitionBy("feature")
    j = long.withColumn("_gmean", F.sum("s").over(by_feature) / F.sum("n").over(by_feature))
    class_ratio = (F.when(F.col("kind") == "numeric", safe_div(safe_div("s", "n"), "_gmean"))
                   .otherwise(F.coalesce(safe_div("s", F.col("n") - F.col("s")), F.lit(NO_ZERO_RATIO))))
    out = (j.withColumn("_r", class_ratio)
           .groupBy("feature", "kind", "position").agg(F.max("_r").alias("ratio"))
           .withColumn("ratio", F.coalesce(F.col("ratio"), F.lit(0.0))))
    return out


def rank_features(ratios: DataFrame) -> DataFrame:
    """Descending ratio, ties keep the role order (numeric then binary)."""
    return ratios.orderBy(F.col("ratio").desc(), F.col("position").asc())


def ranked(ratios: DataFrame, out: str = "rank") -> DataFrame:
    """A15 as a column: 1-based rank by (ratio desc, position).  The table has
    one row per feature - bounded by the schema, not the data - so a
    single-partition window is the right tool here."""
    w = Window.orderBy(F.col("ratio").desc(), F.col("position").asc())
    return ratios.withColumn(out, F.row_number().over(w).cast("long"))


def select_features(ratios: DataFrame, min_ratio: float) -> DataFrame:
    """Features with ratio >= threshold (as a table)."""
    return ratios.where(F.col("ratio") >= min_ratio)


def selected_names(ratios: DataFrame, min_ratio: float) -> list[str]:
    """A16 for model building: only the selected names reach the driver."""
    rows = select_features(ratios, min_ratio).orderBy(F.col("ratio").desc(), "position").collect()
    return [r["feature"] for r in rows]
