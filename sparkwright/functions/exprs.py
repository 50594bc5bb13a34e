"""Small column-expression helpers shared by the operators."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType, StructType

FLOATING = (DoubleType, FloatType)


def safe_div(num, den) -> Column:
    """Division that yields null (not an error, not inf) on a zero or null denominator."""
    return F.try_divide(_c(num), _c(den))


def null_safe(pred: Column) -> Column:
    """A predicate where null counts as false (for routing / deleting)."""
    return F.coalesce(pred, F.lit(False))


def is_floating(df: DataFrame, name: str) -> bool:
    return isinstance(df.schema[name].dataType, FLOATING)


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def local_table(spark: SparkSession, rows: list, schema: StructType | str) -> DataFrame:
    """A small driver-side table (statistics, fitted parameters; bounded by
    the schema or the model, never by the data) as literal rows in the plan.
    Unlike ``createDataFrame(list)`` this needs no Python worker to decode
    the rows, and the optimizer sees the literals."""
    if isinstance(schema, str):
        schema = StructType.fromDDL(schema)
    fields = schema.fields

    def cell(v, f):
        return F.lit(v).cast(f.dataType).alias(f.name)

    if not rows:
        return spark.range(0).select(*[cell(None, f) for f in fields])
    structs = [F.struct(*[cell(r[i], f) for i, f in enumerate(fields)]) for r in rows]
    return spark.range(1).select(F.inline(F.array(*structs)))


def join_groups(left: DataFrame, right: DataFrame, cols: list[str], how: str = "left") -> DataFrame:
    """Join on group columns that both frames have; null groups match.  The
    columns of ``left`` stay, those of ``right`` besides ``cols`` are added."""
    named = right.select(*[F.col(f"`{c}`").alias(f"_j{i}") for i, c in enumerate(cols)],
                         *[F.col(f"`{c}`") for c in right.columns if c not in cols])
    on = [F.col(f"`{c}`").eqNullSafe(F.col(f"_j{i}")) for i, c in enumerate(cols)]
    return left.join(named, reduce(lambda x, y: x & y, on), how).drop(*[f"_j{i}" for i in range(len(cols))])
