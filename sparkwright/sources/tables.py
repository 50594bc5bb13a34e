"""Driver tables and the ``feat`` stand-in for the connection table.

``feat`` has one row per order: a raw label, two nominal columns, numeric
measures, binary flags, a constant column, a 5-way and a 2-way label, a rule
score and a planted learnable label.  Line items are pre-aggregated per order
before the join, so only one row per order crosses the shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")

# Column roles of ``feat`` (fixed, mirror the reference's nominal/binary/numeric lists).
FEAT_NOMINAL = ["status", "segment"]
FEAT_NUMERIC = ["total", "acctbal", "n_lines", "qty", "avg_disc"]
FEAT_BINARY = ["has_return", "acct_negative"]
FEAT_LABEL5 = "label_group"
FEAT_LABEL2 = "label2"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def line_summary(lineitem: DataFrame) -> DataFrame:
    """Per-order line aggregate (partial aggregation happens map-side).
    The mean discount is an exact decimal sum divided by the count, so it does
    not depend on summation order (partitioning, engine)."""
    exact_sum = F.sum(F.col("l_discount").cast("decimal(12,2)")).cast("double")
    return (lineitem.groupBy("l_orderkey")
            .agg(F.count(F.lit(1)).alias("n_lines_"),
                 F.sum("l_quantity").alias("qty_"),
                 (exact_sum / F.count(F.lit(1))).alias("avg_disc_"),
                 F.max(F.when(F.col("l_returnflag") == "R", 1).otherwise(0)).alias("has_return_")))


def feat(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = read_table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority")
    customer = read_table(spark, sf_dir, "customer").select("c_custkey", "c_acctbal", "c_mktsegment")
    lines = line_summary(read_table(spark, sf_dir, "lineitem"))
    j = (orders.join(customer, orders.o_custkey == customer.c_custkey, "left")
         .join(lines, orders.o_orderkey == lines.l_orderkey, "left"))
    prio = F.col("o_orderpriority")
    total = F.col("o_totalprice")
    return j.select(
        F.col("o_orderkey").alias("id"),
        prio.alias("raw_label"),
        F.col("o_orderstatus").alias("status"),
        F.col("c_mktsegment").alias("segment"),
        total.alias("total"),
        F.col("c_acctbal").alias("acctbal"),
        F.coalesce(F.col("n_lines_"), F.lit(0)).cast("double").alias("n_lines"),
        F.coalesce(F.col("qty_"), F.lit(0.0)).alias("qty"),
        F.coalesce(F.col("avg_disc_"), F.lit(0.0)).alias("avg_disc"),
        F.coalesce(F.col("has_return_"), F.lit(0)).cast("double").alias("has_return"),
        F.when(F.col("c_acctbal") < 0, 1.0).otherwise(0.0).alias("acct_negative"),
        F.lit(0.0).alias("const_col"),
        F.when(prio == "1-URGENT", "A").when(prio == "2-HIGH", "B")
         .when(prio == "3-MEDIUM", "C").otherwise("normal").alias(FEAT_LABEL5),
        F.when(prio.isin("4-NOT SPECIFIED", "5-LOW"), "normal").otherwise("attack").alias(FEAT_LABEL2),
        F.when(total >= 500000, 1.0).otherwise(total / 500000.0).alias("score1"),
        F.when(total > 250000, 1.0).otherwise(0.0).alias("planted"),
    )


# The same table in SQL, for the DuckDB oracle (prefix with ``WITH``).
FEAT_SQL = """feat AS (
  WITH l AS (
    SELECT l_orderkey, count(*) AS n_lines, sum(l_quantity) AS qty,
           CAST(sum(CAST(l_discount AS DECIMAL(12,2))) AS DOUBLE) / count(*) AS avg_disc,
           max(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END) AS has_return
    FROM lineitem GROUP BY l_orderkey)
  SELECT o_orderkey AS id,
         o_orderpriority AS raw_label, o_orderstatus AS status, c_mktsegment AS segment,
         o_totalprice AS total, c_acctbal AS acctbal,
         CAST(coalesce(n_lines, 0) AS DOUBLE) AS n_lines, coalesce(qty, CAST(0 AS DOUBLE)) AS qty,
         coalesce(avg_disc, CAST(0 AS DOUBLE)) AS avg_disc,
         CAST(coalesce(has_return, 0) AS DOUBLE) AS has_return,
         CAST(CASE WHEN c_acctbal < 0 THEN 1 ELSE 0 END AS DOUBLE) AS acct_negative,
         CAST(0 AS DOUBLE) AS const_col,
         CASE o_orderpriority WHEN '1-URGENT' THEN 'A' WHEN '2-HIGH' THEN 'B'
                              WHEN '3-MEDIUM' THEN 'C' ELSE 'normal' END AS label_group,
         CASE WHEN o_orderpriority IN ('4-NOT SPECIFIED', '5-LOW')
              THEN 'normal' ELSE 'attack' END AS label2,
         CASE WHEN o_totalprice >= 500000 THEN CAST(1 AS DOUBLE)
              ELSE o_totalprice / CAST(500000 AS DOUBLE) END AS score1,
         CAST(CASE WHEN o_totalprice > 250000 THEN 1 ELSE 0 END AS DOUBLE) AS planted
  FROM orders LEFT JOIN customer ON o_custkey = c_custkey LEFT JOIN l ON l_orderkey = o_orderkey)"""
