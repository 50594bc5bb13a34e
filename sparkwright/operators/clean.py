"""Cleaning and missing values.

Null, NaN and the blank string are three different "missing" values; each
operator says which ones it treats.  ``isnan`` is applied to float/double
columns only (on text it fails under ANSI mode).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from sparkwright.functions.exprs import is_floating, local_table


def nan_counts(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """One row, one count per column of NaN values (0 for non-float columns)."""
    cols = columns or df.columns
    return df.agg(*[
        (F.count_if(F.isnan(c)) if is_floating(df, c) else F.lit(0).cast("long")).alias(c)
        for c in cols])


def missing_to_null(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Null / NaN / blank-after-trim -> null; other values keep their text."""
    cols = set(columns or df.columns)
    out = []
    for f in df.schema.fields:
        c = F.col(f.name)
        if f.name in cols and isinstance(f.dataType, StringType):
            c = F.when(F.trim(c) == "", F.lit(None).cast("string")).otherwise(c)
        elif f.name in cols and is_floating(df, f.name):
            c = F.when(F.isnan(c), F.lit(None).cast(f.dataType)).otherwise(c)
        out.append(c.alias(f.name))
    return df.select(*out)


def drop_incomplete(df: DataFrame, subset: list[str] | None = None) -> DataFrame:
    """Drop rows holding a null in any (listed) column."""
    return df.na.drop(how="any", subset=subset)


def replace_value(df: DataFrame, old, new, subset: list[str] | None = None) -> DataFrame:
    """C4: replace one value by another in the listed columns."""
    return df.replace(old, new, subset=subset)


def blank_to_null(df: DataFrame) -> DataFrame:
    """The exact empty string -> null in every string column (numeric
    columns untouched; ' ' is not blank here)."""
    return df.select(*[
        (F.when(F.col(f.name) == "", F.lit(None).cast("string")).otherwise(F.col(f.name))
         if isinstance(f.dataType, StringType) else F.col(f.name)).alias(f.name)
        for f in df.schema.fields])


def fill_missing(df: DataFrame, value, subset: list[str] | None = None) -> DataFrame:
    """Null (and NaN for floats) -> constant."""
    return df.fillna(value, subset=subset)


def _row_hash(df: DataFrame, columns: list[str]) -> Column:
    """256-bit hash of some columns, nulls and lengths told apart: the group key
    of whole rows, so that long texts are neither shuffled nor sorted."""
    parts = []
    for c in columns:
        v = F.col(f"`{c}`")
        text = v if dict(df.dtypes)[c] == "string" else F.to_json(F.struct(v))
        parts.append(F.coalesce(F.concat(F.length(text).cast("string"), F.lit(":"), text), F.lit("-")))
    return F.sha2(F.concat_ws(",", *parts), 256)


def duplicate_count(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Number of rows that repeat an earlier row (nulls compare equal).
    Rows are counted by hash, combined map-side, so a hot row costs no single
    task and no text leaves the scan."""
    cols = columns or df.columns
    g = df.select(_row_hash(df, cols).alias("_h")).groupBy("_h").agg(F.count(F.lit(1)).alias("_n"))
    return g.agg(F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).cast("long").alias("duplicates"),
                 F.coalesce(F.sum("_n"), F.lit(0)).cast("long").alias("rows"),
                 F.count(F.lit(1)).cast("long").alias("distinct_rows"))


def dedup(df: DataFrame, subset: list[str] | None = None, keep_first_by: list[str] | None = None,
          columns: list[str] | None = None) -> DataFrame:
    """Drop duplicate rows.  With ``subset`` and ``keep_first_by`` the row with
    the smallest order key is kept; ``min_by`` is a partial aggregate, so a key
    with a third of all rows is reduced map-side before the shuffle.  The
    rows are grouped by the hash of ``subset``, so of long texts only the
    returned ``columns`` (all by default) are shuffled."""
    if not subset:
        return df.dropDuplicates()
    if not keep_first_by:
        return df.dropDuplicates(subset)
    order = F.struct(*[F.col(c) for c in keep_first_by])
    kept = (df.withColumn("_h", _row_hash(df, subset)).groupBy("_h")
            .agg(F.min_by(F.struct(*[F.col(c) for c in columns or df.columns]), order).alias("_r")))
    return kept.select("_r.*")


def constant_columns(df: DataFrame, columns: list[str] | None = None) -> list[str]:
    """C9 (names only reach the driver): columns with at most one distinct
    non-null value.  min == max replaces a distinct count: one cheap pass."""
    cols = columns or df.columns
    row = df.agg(*[(F.coalesce(F.min(c) == F.max(c), F.lit(True))).alias(c) for c in cols]).first()
    return [c for c in cols if row[c]]


def drop_constant_columns(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    return df.drop(*constant_columns(df, columns))


def correlated_to_drop(corr_long: DataFrame, threshold: float, order: list[str]) -> DataFrame:
    """From a long Pearson table (a, b, corr) flag each feature that has an
    earlier feature (in ``order``) with |corr| >= threshold.
    Returns (feature, position, dropped)."""
    pos = F.create_map(*[x for i, n in enumerate(order) for x in (F.lit(n), F.lit(i))])
    pairs = corr_long.select(
        F.when(pos[F.col("a")] > pos[F.col("b")], F.col("a")).otherwise(F.col("b")).alias("later"),
        F.abs(F.col("corr")).alias("r"))
    hits = pairs.where(F.col("r") >= threshold).select(F.col("later").alias("feature")).distinct()
    feats = local_table(corr_long.sparkSession, [(n, i) for i, n in enumerate(order)],
                        "feature string, position int")
    return (feats.join(hits.withColumn("dropped", F.lit(1)), "feature", "left")
            .select("feature", "position", F.coalesce("dropped", F.lit(0)).alias("dropped")))
