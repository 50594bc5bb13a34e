"""Stored document collections that are updated in place, partition by
partition (K4-K6).

A collection is a Parquet folder partitioned by a hash of one field.  An update
or delete that matches on that field reads and rewrites only the partition of
the wanted value; any other match first finds the partitions that hold a match
(a scan of the matched columns).  Only those partitions are overwritten, the
files of all others stay as they are.  Matched, modified and deleted documents
are counted while the new files are written.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from sparkwright.functions.exprs import null_safe
from sparkwright.operators.documents import _match, update_many

PART = "_part"


class Collection:
    """A stored collection.  ``field`` and ``parts`` are those it was created
    with.  One writer at a time; a failed write leaves the old files."""

    def __init__(self, spark: SparkSession, path: str, field: str, parts: int = 64):
        self.spark, self.path, self.field, self.parts = spark, path, field, parts

    # ----------------------------------------------------------- reading

    def _part_of(self, value: Column) -> Column:
        return F.pmod(F.xxhash64(value), F.lit(self.parts)).cast("int")

    def _all(self) -> DataFrame:
        return self.spark.read.parquet(self.path)

    def read(self) -> DataFrame:
        """All documents."""
        return self._all().drop(PART)

    def find(self, match: dict) -> DataFrame:
        """Documents that match all given fields; a match on the partition field
        reads one partition."""
        return self._touched(match, self._all()).where(null_safe(_match(match))).drop(PART)

    def _touched(self, match: dict, rows: DataFrame) -> DataFrame:
        if self.field in match:
            return rows.where(F.col(PART) == self._number(match[self.field]))
        return rows

    def _number(self, value) -> int:
        """Partition of a value, cast as the field is stored."""
        kind = self._all().schema[self.field].dataType
        return self.spark.range(1).select(self._part_of(F.lit(value).cast(kind))).first()[0]

    # ----------------------------------------------------------- writing

    def insert_many(self, docs: DataFrame) -> None:
        """Append documents; repeats are kept."""
        rows = docs.withColumn(PART, self._part_of(F.col(self.field)))
        # A partition's documents go to one file a write; hot values may be several.
        rows.write.mode("append").partitionBy(PART).parquet(self.path)

    def _parts_with(self, match: dict) -> list[int]:
        """Numbers of the partitions that hold a match: at most ``parts``."""
        if self.field in match:
            return [self._number(match[self.field])]
        found = self._all().where(null_safe(_match(match))).select(PART).distinct()
        return sorted(r[0] for r in found.collect())

    def _replace(self, numbers: list[int], rows: DataFrame) -> None:
        """Overwrite the partitions ``numbers`` with ``rows``."""
        left = Observation()
        # At most ``parts`` numbers: one counter each tells which end up empty.
        counts = [F.count_if(F.col(PART) == n).alias(f"p{n}") for n in numbers]
        (rows.observe(left, *counts).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy(PART).parquet(self.path))
        for n in numbers:
            if not left.get[f"p{n}"]:
                folder = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{PART}={n}")
                folder.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(folder, True)

    def update_many(self, match: dict, set_fields: dict) -> dict[str, int]:
        """``$set`` fields (values) on every match, in place; the numbers of
        matched and of changed documents.  Setting the partition field moves
        documents to the partition of the new value, which is rewritten too."""
        numbers = self._parts_with(match)
        if not numbers:
            return {"matched": 0, "modified": 0}
        if self.field in set_fields:
            numbers = sorted({*numbers, self._number(set_fields[self.field])})
        old = self._all().where(F.col(PART).isin(numbers))
        pred, seen = null_safe(_match(match)), Observation()
        same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.lit(v).cast(old.schema[c].dataType))
                                           for c, v in set_fields.items()], F.lit(True))
        counted = old.observe(seen, F.count_if(pred).alias("matched"), F.count_if(pred & ~same).alias("modified"))
        new = update_many(counted, match, set_fields)
        self._replace(numbers, new.withColumn(PART, self._part_of(F.col(self.field))))
        return seen.get

    def delete_many(self, match: dict) -> dict[str, int]:
        """Remove every match in place; the number of deleted documents."""
        numbers = self._parts_with(match)
        if not numbers:
            return {"deleted": 0}
        pred, seen = null_safe(_match(match)), Observation()
        old = self._all().where(F.col(PART).isin(numbers)).observe(seen, F.count_if(pred).alias("deleted"))
        self._replace(numbers, old.where(~pred))
        return seen.get
