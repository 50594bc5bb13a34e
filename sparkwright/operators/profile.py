"""Profiling and aggregates.

Wide statistics, histograms and densities are computed in one aggregate over
the wide row, and only the result row is transposed to long form.  Exact
quantiles descend through digit histograms (``selection``), ranks go column by
column (``ordering``), and correlations of wide tables are matrix products
(``moments``): one scan each.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkwright.functions.exprs import local_table
from sparkwright.operators.moments import correlations
from sparkwright.operators.ordering import join_groups, rank_table
from sparkwright.operators.selection import quantiles
from sparkwright.session import materialize

# ------------------------------------------------------------- small helpers


def _transpose(one_row: DataFrame, cols: list[str], stats: list[str], key: str = "column") -> DataFrame:
    """Turn the single row ``{c}__{s}`` into rows (key, s...) per column c."""
    rows = [F.struct(F.lit(c).alias(key), *[F.col(f"`{c}__{s}`").alias(s) for s in stats])
            for c in cols]
    return one_row.select(F.inline(F.array(*rows)))


def _long(df: DataFrame, cols: list[str], ids: list[str] = (), name: str = "column") -> DataFrame:
    """Unpivot numeric columns to (ids..., name, value double)."""
    sel = df.select(*ids, *[F.col(c).cast("double").alias(c) for c in cols])
    return sel.unpivot(list(ids), cols, name, "value")


# ---------------------------------------------------------------- A1 - A5


def shape(df: DataFrame) -> DataFrame:
    """A1/A2: (rows, columns)."""
    return df.agg(F.count(F.lit(1)).alias("rows"), F.lit(len(df.columns)).cast("long").alias("columns"))


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """A3: counts per value, most frequent first, ties by value."""
    return (df.groupBy(column).agg(F.count(F.lit(1)).alias("count"))
            .orderBy(F.col("count").desc(), F.col(column).asc_nulls_first()))


def distinct_counts(df: DataFrame, columns: list[str], approx: bool = False, rsd: float = 0.01) -> DataFrame:
    """A4: exact (or HyperLogLog) distinct count per column, one row.  Exact
    counts take one pruned pass per column, whose distinct values are found
    map-side first, instead of one pass that copies every row per column."""
    if approx:
        return df.agg(*[F.approx_count_distinct(c, rsd).alias(c) for c in columns])
    counts = reduce(DataFrame.unionAll, [
        df.select(c).where(F.col(c).isNotNull()).distinct().agg(F.count(F.lit(1)).alias("_n"))
        .select(F.lit(c).alias("_c"), "_n") for c in columns])
    return counts.agg(*[F.max(F.when(F.col("_c") == c, F.col("_n"))).alias(c) for c in columns])


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    return df.select(column).distinct()


#: Values that may become columns (as for Spark's own pivot).
MOST_COLUMNS = 10_000


def crosstab_long(df: DataFrame, a: str, b: str) -> DataFrame:
    """A5 for any number of values: (a, b, count) of the pairs that occur,
    nulls included."""
    return df.groupBy(a, b).agg(F.count(F.lit(1)).alias("count"))


def crosstab(df: DataFrame, a: str, b: str, values: list | None = None) -> DataFrame:
    """A5: contingency table, first column ``a_b`` holds a's value, one count
    column per value of b (``null`` for its nulls), missing pairs = 0.  Keys
    keep their type (unlike ``DataFrame.crosstab``).  The wide form has a
    column per value, listed or found; more than ``MOST_COLUMNS`` found ones are
    an error, and ``crosstab_long`` takes any number."""
    if values is None:
        found = [r[0] for r in df.select(b).distinct().limit(MOST_COLUMNS + 1).collect()]
        if len(found) > MOST_COLUMNS:
            raise ValueError(f"{b} has more than {MOST_COLUMNS} values; use crosstab_long")
        values = sorted(v for v in found if v is not None) + [None] * (None in found)
    counts = [F.count_if(F.col(b).eqNullSafe(F.lit(v))).alias("null" if v is None else str(v)) for v in values]
    return df.groupBy(F.col(a).alias(f"{a}_{b}")).agg(*counts)


# ---------------------------------------------------------------- A6 - A9

_BASIC = ["count", "mean", "stddev", "min", "max"]


def describe(df: DataFrame, columns: list[str]) -> DataFrame:
    """(column, count, mean, stddev (sample), min, max) as doubles."""
    aggs = []
    for c in columns:
        x = F.col(c).cast("double")
        aggs += [F.count(x).alias(f"{c}__count"), F.avg(x).alias(f"{c}__mean"),
                 F.stddev_samp(x).alias(f"{c}__stddev"), F.min(x).alias(f"{c}__min"),
                 F.max(x).alias(f"{c}__max")]
    return _transpose(df.agg(*aggs), columns, _BASIC)


def describe_quartiles(df: DataFrame, columns: list[str], approx: bool = False,
                       accuracy: int = 10_000) -> DataFrame:
    """Describe plus 25/50/75 % quantiles with linear interpolation
    (exact, by digit histograms; ``approx=True`` uses percentile_approx)."""
    basic = describe(df, columns)
    probs = [0.25, 0.5, 0.75]
    if approx:
        aggs = [F.percentile_approx(F.col(c).cast("double"), probs, accuracy).alias(f"{c}__q")
                for c in columns]
        qs = _transpose(df.agg(*aggs), columns, ["q"])
        qs = qs.select("column", *[F.col("q")[i].alias(n) for i, n in enumerate(["q25", "q50", "q75"])])
    else:
        q = quantiles(_long(df, columns), "value", probs, ["column"])
        qs = q.groupBy("column").pivot("prob", probs).agg(F.first("quantile"))
        qs = qs.select("column", *[F.col(f"`{p}`").alias(n) for p, n in zip(probs, ["q25", "q50", "q75"])])
    return basic.join(qs, "column", "left")


def describe_by_class(df: DataFrame, column: str, by: str) -> DataFrame:
    """Describe one column per class in one pass (plus exact quartiles)."""
    x = F.col(column).cast("double")
    basic = df.groupBy(by).agg(F.count(x).alias("count"), F.avg(x).alias("mean"),
                               F.stddev_samp(x).alias("stddev"), F.min(x).alias("min"),
                               F.max(x).alias("max"))
    probs = [0.25, 0.5, 0.75]
    q = quantiles(df.select(by, x.alias("_v")), "_v", probs, [by])
    qs = q.groupBy(by).pivot("prob", probs).agg(F.first("quantile"))
    names = ["q25", "q50", "q75"]
    qs = qs.select(by, *[F.col(f"`{p}`").alias(n) for p, n in zip(probs, names)])
    return join_groups(basic, qs, [by])


def info(df: DataFrame) -> DataFrame:
    """(position, column, dtype, non_null) for every column."""
    row = df.agg(*[F.count(F.col(f"`{c}`")).alias(c) for c in df.columns])
    rows = [F.struct(F.lit(i).alias("position"), F.lit(c).alias("column"), F.lit(t).alias("dtype"),
                     F.col(f"`{c}`").alias("non_null"))
            for i, (c, t) in enumerate(df.dtypes)]
    return row.select(F.inline(F.array(*rows)))


def means(df: DataFrame, columns: list[str]) -> DataFrame:
    """A10: one row of global means."""
    return df.agg(*[F.avg(c).alias(c) for c in columns])


# ------------------------------------------------------------- A18 / A19


# Pairs of columns that one aggregate takes; more go through matrix products.
_PAIRS = 400


def corr_pearson(df: DataFrame, columns: list[str]) -> DataFrame:
    """Pairwise Pearson, long (a, b, corr) for a before b in ``columns``;
    each pair over the rows where both are present, zero variance -> null.  One
    scan: few pairs are one aggregate, the pairs of a wide table blocked matrix
    products (``moments.correlations``)."""
    pairs = [(a, b) for i, a in enumerate(columns) for b in columns[i + 1:]]
    if not pairs:
        return local_table(df.sparkSession, [], "a string, b string, corr double")
    if len(pairs) > _PAIRS:
        return correlations(df, columns)
    one = df.agg(*[F.corr(F.col(a).cast("double"), F.col(b).cast("double")).alias(f"{a}|{b}") for a, b in pairs])
    rows = [F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"),
                     F.nanvl(F.col(f"`{a}|{b}`"), F.lit(None).cast("double")).alias("corr")) for a, b in pairs]
    return one.select(F.inline(F.array(*rows)))


def corr_spearman(df: DataFrame, columns: list[str]) -> DataFrame:
    """Spearman = Pearson of average ranks.  The distinct values of all
    columns are ranked together, column by column in one running total; the
    ranks are then joined to the rows, which are not put together again."""
    base = df.select(*[F.col(c).cast("double").alias(c) for c in columns])
    ranks = materialize(rank_table(_long(base, columns), "value", ["column"]))
    ranked = base
    for i, c in enumerate(columns):
        own = ranks.where(F.col("column") == c).select(F.col("value").alias(c), F.col("rank").alias(f"_rank{i}"))
        ranked = join_groups(ranked, own, [c])
    return corr_pearson(ranked.select(*[F.col(f"_rank{i}").alias(c) for i, c in enumerate(columns)]), columns)


# ---------------------------------------------------------- A20 - A22


def _wide_ranges(df: DataFrame, columns: list[str], by: list[str] = ()) -> DataFrame:
    """Min, max, count and stddev of all columns (per class): one aggregate."""
    aggs = []
    for c in columns:
        v = F.col(f"`{c}`").cast("double")
        aggs += [F.min(v).alias(f"{c}__mn"), F.max(v).alias(f"{c}__mx"), F.count(v).alias(f"{c}__n"),
                 F.stddev_samp(v).alias(f"{c}__sd")]
    return df.groupBy(*by).agg(*aggs)


def _long_ranges(wide: DataFrame, columns: list[str], by: list[str] = ()) -> DataFrame:
    rows = [F.struct(F.lit(c).alias("column"), *[F.col(f"`{c}__{s}`").alias(f"_{s}") for s in ("mn", "mx", "n", "sd")])
            for c in columns]
    return wide.select(*by, F.inline(F.array(*rows)))


def _ranges(df: DataFrame, columns: list[str]) -> DataFrame:
    """A row per column: min, max, count and stddev."""
    return _long_ranges(_wide_ranges(df, columns), columns)


def histogram(df: DataFrame, columns: list[str], bins: int = 10, by: str | None = None) -> DataFrame:
    """Equal-width histogram per column (and class): rows
    (column[, by], bin, lo, hi, count, density); empty bins are kept, a null
    class is a class.  Range per column (and class); top edge folded into the
    last bin.  Without classes the ranges are literals of the counting
    projection; with classes a row meets one row with the ranges of its class."""
    grp = [by] if by else []
    if by:
        # Stored, so that the planner knows how small the table of classes is.
        wide = materialize(_wide_ranges(df, columns, grp))
        cells = []
        for c in columns:
            value, low, high = F.col(f"`{c}`").cast("double"), F.col(f"`{c}__mn`"), F.col(f"`{c}__mx`")
            raw = F.floor(F.try_divide((value - low) * bins, high - low)) + 1
            at = F.when(value.isNotNull(), F.when(low == high, F.lit(1)).otherwise(F.least(raw, F.lit(bins))))
            cells.append(F.struct(F.lit(c).alias("column"), at.cast("int").alias("bin")))
        binned = (join_groups(df.select(by, *columns), wide, [by], "inner")
                  .select(by, F.inline(F.array(*cells))).where("bin is not null"))
        ranges = _long_ranges(wide, columns, grp)
    else:
        # At most one row per column.
        ranges = _ranges(df, columns)
        ranges = local_table(df.sparkSession, ranges.collect(), ranges.schema)
        rows = {r["column"]: r for r in ranges.collect()}
        cells = []
        for c in columns:
            value, r = F.col(c).cast("double"), rows.get(c)
            if r and r["_n"]:
                width = r["_mx"] - r["_mn"]
                raw = F.floor((value - F.lit(r["_mn"])) * bins / F.lit(width)) + 1 if width else F.lit(1)
                cells.append(F.struct(F.lit(c).alias("column"), F.when(
                    value.isNotNull(), F.least(raw, F.lit(bins))).cast("int").alias("bin")))
        binned = (df.select(F.inline(F.array(*cells))) if cells
                  else local_table(df.sparkSession, [], "column string, bin int")).where("bin is not null")
    counted = binned.groupBy("column", *grp, "bin").agg(F.count(F.lit(1)).alias("count"))
    width = (F.col("_mx") - F.col("_mn")) / bins
    ranges = ranges.where("_n > 0")
    grid = ranges.select("column", *grp, "_mn", "_mx", "_n", F.explode(F.sequence(F.lit(1), F.lit(bins))).alias("bin"))
    out = (join_groups(grid, counted, ["column", *grp, "bin"])
           .withColumn("count", F.coalesce("count", F.lit(0)).cast("long")))
    return out.select("column", *grp, "bin",
                      (F.col("_mn") + (F.col("bin") - 1) * width).alias("lo"),
                      (F.col("_mn") + F.col("bin") * width).alias("hi"),
                      "count",
                      F.try_divide(F.col("count"), F.col("_n") * width).alias("density"))


#: Grid points of a density curve, as plotting libraries draw it.
KDE_POINTS = 200


def kde(df: DataFrame, columns: list[str], points: int = KDE_POINTS) -> DataFrame:
    """Gaussian kernel density on ``points`` evenly spaced grid points per
    column, bandwidth = stddev * n^(-1/5).  Equal values are counted first; each
    distinct value meets the grid inside its task, and the sums per point are
    combined map-side, so only ``points`` rows a task are shuffled.  The ranges
    are literals."""
    parts = []
    for r in _ranges(df, columns).collect():  # a row per column
        if not r["_n"] or r["_sd"] is None:
            continue
        h = r["_sd"] * float(r["_n"]) ** -0.2
        step = (r["_mx"] - r["_mn"]) / (points - 1)
        values = (df.select(F.col(r["column"]).cast("double").alias("_v")).where(F.col("_v").isNotNull())
                  .groupBy("_v").agg(F.count(F.lit(1)).alias("_times")))
        x = F.lit(r["_mn"]) + F.lit(step) * F.col("point")
        z = F.try_divide(x - F.col("_v"), F.lit(h))
        sums = (values.select("_v", "_times", F.explode(F.sequence(F.lit(0), F.lit(points - 1))).alias("point"))
                .groupBy("point").agg(F.sum(F.col("_times") * F.exp(-0.5 * z * z)).alias("_sum")))
        parts.append(sums.select(F.lit(r["column"]).alias("column"), "point", x.alias("x"), F.try_divide(
            F.col("_sum"), F.lit(r["_n"] * h * math.sqrt(2 * math.pi))).alias("density")))
    if not parts:
        return local_table(df.sparkSession, [], "column string, point int, x double, density double")
    return reduce(DataFrame.unionAll, parts)


# ----------------------------------------------------------- A23 - A25


def last_per_key(df: DataFrame, key: str, value, seq: str, out: str = "value") -> DataFrame:
    """Per key, the value computed on the row with the largest sequence
    (last write wins); ``max_by`` is combined map-side."""
    v = F.col(value) if isinstance(value, str) else value
    return df.groupBy(key).agg(F.max_by(v, F.col(seq)).alias(out), F.max(seq).alias("seq"))


def cluster_profile(df: DataFrame, cluster: str, label: str, labels=("attack", "normal")) -> DataFrame:
    """Per cluster the count of each label, their total, sorted by cluster."""
    ct = crosstab(df, cluster, label, list(labels))
    key = f"{cluster}_{label}"
    total = sum((F.col(f"`{v}`") for v in labels[1:]), F.col(f"`{labels[0]}`"))
    return ct.withColumn("count", total).orderBy(key)


# Fixed bin edges of the parity CASE (closed ranges; values in the gaps -> null).
AGE_BIN_CASE = """CASE
          WHEN {c} BETWEEN 14.9 AND 27.49 THEN 1
          WHEN {c} BETWEEN 27.5 AND 39.99 THEN 2
          WHEN {c} BETWEEN 40.0 AND 52.49 THEN 3
          WHEN {c} BETWEEN 52.5 AND 64.49 THEN 4
          END AS {out}"""


def case_bins(df: DataFrame, column: str, out: str = "bins") -> DataFrame:
    """A25 parity: ``selectExpr('*', CASE ...)`` with the fixed closed ranges."""
    return df.selectExpr("*", AGE_BIN_CASE.format(c=column, out=out))


def even_splits(lo: float, hi: float, n: int) -> list[float]:
    """n equal-width bins over [lo, hi] -> n+1 split points."""
    return [lo + (hi - lo) * i / n for i in range(n + 1)]


def bucketize(df: DataFrame, column: str, splits: list[float], out: str = "bucket") -> DataFrame:
    """A25 intended version: buckets [s_i, s_i+1) numbered from 1, the last one
    closed on the right; values outside [s_0, s_n] and nulls -> null."""
    v = F.col(column)
    n = len(splits) - 1
    e = F.when((v >= splits[n - 1]) & (v <= splits[n]), F.lit(n))
    for i in range(n - 2, -1, -1):
        e = e.when((v >= splits[i]) & (v < splits[i + 1]), F.lit(i + 1))
    return df.withColumn(out, e.cast("int"))
