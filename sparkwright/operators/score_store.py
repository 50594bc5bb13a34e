"""Co-located score tables (J1, J2): write once in buckets by id, attach many
times without an exchange.

Every table of a store has the same number of buckets by the same key, one
sorted file a bucket, so Spark joins two of them bucket by bucket.  A key that
occurs twice fails the write, so an attached table never multiplies rows;
``Observation`` counts show that every row came through.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from sparkwright.operators.relational import unique_by
from sparkwright.session import shared_path


class ScoreStore:
    """Tables of one key in ``buckets`` buckets, under one shared folder."""

    def __init__(self, spark: SparkSession, key: str, buckets: int | None = None, path: str | None = None):
        self.spark, self.key = spark, key
        self.buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.path = path or shared_path(spark, "scores")
        self.tables: dict[str, str] = {}

    def write(self, name: str, df: DataFrame) -> int:
        """Store ``df`` under ``name``, replacing an older one; the number of its
        rows.  A repeated key is an error and stores nothing."""
        seen = Observation()
        # Hashed by key as buckets are: the check and the buckets share one exchange.
        rows = unique_by(df.repartition(self.buckets, self.key), self.key).observe(seen, F.count(F.lit(1)).alias("rows"))
        table = f"scores_{uuid.uuid4().hex}"
        (rows.write.format("parquet").bucketBy(self.buckets, self.key).sortBy(self.key)
         .option("path", f"{self.path}/{table}").saveAsTable(table))
        old = self.tables.get(name)
        self.tables[name] = table
        if old:
            self.spark.sql(f"DROP TABLE IF EXISTS {old}")
        return seen.get["rows"]

    def read(self, name: str) -> DataFrame:
        return self.spark.table(self.tables[name])

    def attach(self, base: str, *names: str, how: str = "left") -> DataFrame:
        """The stored table ``base`` with the columns of others, each replacing
        columns of the same name: bucket-wise merge joins, no exchange.  A left
        join keeps every row of ``base`` once; ``how="inner"`` keeps those that
        all tables have."""
        out = self.read(base)
        for name in names:
            new = self.read(name)
            out = out.drop(*[c for c in new.columns if c != self.key and c in out.columns])
            out = out.join(new.hint("merge"), self.key, how)
        return out

    def attach_checked(self, target: str, base: str, *names: str) -> dict[str, int]:
        """Attach, store the result as ``target`` and count: rows of ``base``,
        rows attached and, per table, rows without a match.  An error if rows
        were lost or multiplied."""
        before, after = Observation(), Observation()
        found = {n: f"_has{i}" for i, n in enumerate(names)}
        out = self.read(base).observe(before, F.count(F.lit(1)).alias("rows"))
        for n in names:
            new = self.read(n).withColumn(found[n], F.lit(True))
            out = out.drop(*[c for c in new.columns if c != self.key and c in out.columns])
            out = out.join(new.hint("merge"), self.key, "left")
        counts: list[Column] = [F.count_if(F.col(h).isNull()).alias(n) for n, h in found.items()]
        out = out.observe(after, F.count(F.lit(1)).alias("attached"), *counts).drop(*found.values())
        self.write(target, out)
        rows = before.get | after.get
        if rows["rows"] != rows["attached"]:
            raise RuntimeError(f"{rows['rows']} rows before, {rows['attached']} after attaching {', '.join(names)}")
        return rows

    def drop(self) -> None:
        """Forget the tables (the shared folder goes with the application)."""
        for table in self.tables.values():
            self.spark.sql(f"DROP TABLE IF EXISTS {table}")
        self.tables.clear()

