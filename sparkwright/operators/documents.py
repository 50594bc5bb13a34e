"""Document-collection operations on tables (K4-K6; find is P7/P8).

A collection is a DataFrame (or a table); the operations return the new
collection.  Matching is equality on all given fields; a document whose
field is null does not match, so it is neither updated nor deleted.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkwright.functions.exprs import null_safe


def _match(match: dict) -> Column:
    if not match:
        return F.lit(True)
    return reduce(lambda a, b: a & b, [F.col(k) == F.lit(v) for k, v in match.items()])


def insert_many(collection: DataFrame, docs: DataFrame, key: list[str] | None = None) -> DataFrame:
    """K4: append documents.  Without a key repeats are kept (like
    ``insert_many``); with a key, documents whose key exists are skipped
    (anti join, so a re-run does not double the collection)."""
    new = docs.select(*collection.columns)
    if key:
        new = new.join(collection.select(*key), key, "left_anti")
    return collection.unionByName(new)


def update_many(collection: DataFrame, match: dict, set_fields: dict) -> DataFrame:
    """K5: ``$set`` the given fields (values or Columns) on every match."""
    pred = null_safe(_match(match))
    new = {c: F.when(pred, v if isinstance(v, Column) else F.lit(v)).otherwise(F.col(c)).cast(
        collection.schema[c].dataType) for c, v in set_fields.items()}
    return collection.withColumns(new)


def delete_many(collection: DataFrame, match: dict) -> DataFrame:
    """K6: remove every match; rows with a null field stay."""
    return collection.where(~null_safe(_match(match)))


def append_to_table(docs: DataFrame, path: str, fmt: str = "parquet") -> None:
    """K4 for a stored collection: append files (no key constraint)."""
    docs.write.mode("append").format(fmt).save(path)


def update_stored(spark: SparkSession, path: str, target: str, match: dict, set_fields: dict) -> dict[str, int]:
    """K5 for a stored collection: write the updated collection to ``target``
    (a new version; the old files stay whole until the caller drops them).
    Returns the numbers of matched and of changed documents."""
    old = spark.read.parquet(path)
    update_many(old, match, set_fields).write.parquet(target)
    pred = null_safe(_match(match))
    same = reduce(lambda a, b: a & b, [
        F.col(c).eqNullSafe((v if isinstance(v, Column) else F.lit(v)).cast(old.schema[c].dataType))
        for c, v in set_fields.items()], F.lit(True))
    return old.agg(F.count_if(pred).alias("matched"), F.count_if(pred & ~same).alias("modified")).first().asDict()


def delete_stored(spark: SparkSession, path: str, target: str, match: dict) -> dict[str, int]:
    """K6 for a stored collection: write what is left to ``target``; returns the
    number of deleted documents."""
    old = spark.read.parquet(path)
    delete_many(old, match).write.parquet(target)
    return old.agg(F.count_if(null_safe(_match(match))).alias("deleted")).first().asDict()
