"""Projection, filters, routing, sorting, union and key joins (P, O, U, J)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StructType

from sparkwright.functions.exprs import null_safe


# ---------------------------------------------------------------- projection


def select_cast(df: DataFrame, types: dict[str, DataType | str] | StructType,
                keep_others: bool = False) -> DataFrame:
    """Project columns under declared types.  ``try_cast`` gives null
    for text that does not parse instead of failing the job (ANSI mode)."""
    if isinstance(types, StructType):
        types = {f.name: f.dataType for f in types.fields}
    cols = [F.col(c).try_cast(t).alias(c) for c, t in types.items()]
    if keep_others:
        cols += [F.col(c) for c in df.columns if c not in types]
    return df.select(*cols)


def with_columns(df: DataFrame, new: dict[str, Column], drop: list[str] | tuple = ()) -> DataFrame:
    """Add or overwrite columns in one projection, then drop others."""
    out = df.withColumns(new) if new else df
    return out.drop(*drop) if drop else out


# ------------------------------------------------------------------ filters


def find(df: DataFrame, match: dict) -> DataFrame:
    """Rows whose fields equal all given values (a null field never matches)."""
    if not match:
        return df
    pred = reduce(lambda a, b: a & b, [F.col(k) == F.lit(v) for k, v in match.items()])
    return df.where(pred)


def find_one(df: DataFrame, order_by: list[str], match: dict | None = None) -> DataFrame:
    """One row, made deterministic by an explicit order (TakeOrderedAndProject)."""
    return find(df, match or {}).orderBy(*order_by).limit(1)


def keep_values(df: DataFrame, column: str, values: list) -> DataFrame:
    """Keep a label group (OR of equalities)."""
    return df.where(F.col(column).isin(list(values)))


def route(df: DataFrame, pred: Column) -> tuple[DataFrame, DataFrame]:
    """P10: two-way routing; a null predicate goes to the second side, so
    together the sides hold every row exactly once."""
    p = null_safe(pred)
    return df.where(p), df.where(~p)


def isin_keys(df: DataFrame, column: str, keys, key_column: str | None = None) -> DataFrame:
    """Membership in a key list (literal) or a key table (semi join, which
    takes repeated keys as they are; the planner picks the join)."""
    if isinstance(keys, DataFrame):
        return df.join(keys.select(F.col(key_column or column).alias(column)), column, "left_semi")
    return df.where(F.col(column).isin(list(keys)))


def class_counts(df: DataFrame, column: str, classes: list) -> DataFrame:
    """One-row counts per listed class, in one pass."""
    return df.agg(*[F.count_if(F.col(column) == F.lit(c)).alias(f"n_{c}") for c in classes],
                  F.count(F.lit(1)).alias("n_total"))


# -------------------------------------------------------------- sort / limit


def order_by_value(df: DataFrame, value: str, tie: str | list[str], descending: bool = True) -> DataFrame:
    """O1/O3: sort by value with an explicit tie-break (stable like the reference)."""
    ties = [tie] if isinstance(tie, str) else list(tie)
    v = F.col(value).desc() if descending else F.col(value).asc()
    return df.orderBy(v, *[F.col(t).asc() for t in ties])


def head(df: DataFrame, n: int, order_by: list) -> DataFrame:
    """First n rows under an explicit order (top-k, no global sort)."""
    return df.orderBy(*order_by).limit(n)


# -------------------------------------------------------------------- union


def union_all(frames: list[DataFrame]) -> DataFrame:
    """Union by name of score tables; no empty typed seed needed."""
    if not frames:
        raise ValueError("union_all needs at least one frame")
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=False), frames)


# -------------------------------------------------------------------- joins


def unique_by(df: DataFrame, key: str) -> DataFrame:
    """``df`` with an error on a key that occurs more than once (when the query
    runs).  Rows without a key match nothing and are left out."""
    others = [c for c in df.columns if c != key]
    row = F.struct(*[F.col(f"`{c}`") for c in others]) if others else F.lit(None)
    rows = df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("_n"), F.any_value(row).alias("_row"))
    message = F.concat(F.lit(f"repeated {key}: "), F.col(key).cast("string"))
    checked = F.when(F.col("_n") == 1, F.col(key)).otherwise(F.raise_error(message).cast(df.schema[key].dataType))
    return rows.select(checked.alias(key), *[F.col("_row")[c].alias(c) for c in others])


def attach_columns(base: DataFrame, key: str, *tables: DataFrame) -> DataFrame:
    """Attach the non-key columns of each table to ``base`` by ``key``,
    replacing columns of the same name.  Left joins: no base row is lost when a
    table misses a key (the reference's inner join dropped such rows), and a
    key that a table has twice is an error, so none is multiplied.  The check
    and the join share the exchange by key; ``score_store`` does both once."""
    out = base
    for t in tables:
        new_cols = [c for c in t.columns if c != key]
        out = out.drop(*[c for c in new_cols if c in out.columns]).join(unique_by(t, key), key, "left")
    return out


def map_lookup(df: DataFrame, column: str, mapping: dict, out: str,
               unknown: str = "null", default=None) -> DataFrame:
    """Dictionary lookup as a literal map (a bounded, driver-given dict).
    ``unknown``: 'null' -> null, 'default' -> ``default``, 'error' -> raise."""
    m = F.create_map(*[x for k, v in mapping.items() for x in (F.lit(k), F.lit(v))])
    val = m[F.col(column)]
    if unknown == "default":
        val = F.coalesce(val, F.lit(default))
    elif unknown == "error":
        val = F.when(val.isNull() & F.col(column).isNotNull(),
                     F.raise_error(F.concat(F.lit("unknown key: "), F.col(column).cast("string")))
                     ).otherwise(val)
    return df.withColumn(out, val)


def table_lookup(df: DataFrame, column: str, mapping: DataFrame, key: str, value: str,
                 out: str, default=None) -> DataFrame:
    """J3 for a mapping held in a table: left join, unknown keys -> ``default``."""
    m = mapping.select(F.col(key).alias("_k"), F.col(value).alias(out))
    j = df.join(m, F.col(column) == F.col("_k"), "left").drop("_k")
    return j.withColumn(out, F.coalesce(F.col(out), F.lit(default))) if default is not None else j
