"""Queries for delimited sources, stride records and document operations
(S1-S6, F6-F8, K4-K6).  Staged copies of the driver tables are written to
the shared checkpoint folder and read back, so the readers do real scans."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, LongType, StringType, StructField, StructType

from sparkwright.operators import documents as D
from sparkwright.plans.registry import query, with_ctes
from sparkwright.session import shared_path
from sparkwright.sources import delimited as DL
from sparkwright.sources import records as RC
from sparkwright.sources.tables import read_table

_ORDER_COLS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority"]
_ORDER_TYPES = {"o_orderkey": LongType(), "o_custkey": LongType(), "o_totalprice": DoubleType()}


@query("src_positional_csv", "SELECT " + ", ".join(_ORDER_COLS) + " FROM orders")
def src_positional_csv(spark, sf):
    path = shared_path(spark, "csv-orders")
    read_table(spark, sf, "orders").select(*_ORDER_COLS).write.option("header", False).csv(path)
    return DL.read_positional_csv(spark, path, DL.positional_schema(_ORDER_COLS, _ORDER_TYPES))


@query("src_header_csv", """
SELECT c_custkey, c_name, CAST(c_nationkey AS BIGINT) AS c_nationkey, c_acctbal, c_mktsegment FROM customer""")
def src_header_csv(spark, sf):
    path = shared_path(spark, "csv-customer")
    read_table(spark, sf, "customer").write.option("header", True).csv(path)
    return DL.read_header_csv(spark, path)


@query("src_string_csv_casts", """
SELECT c_custkey, c_name, CAST(c_nationkey AS VARCHAR) AS c_nationkey, c_acctbal, c_mktsegment FROM customer""")
def src_string_csv_casts(spark, sf):
    path = shared_path(spark, "csv-customer-str")
    read_table(spark, sf, "customer").write.option("header", True).csv(path)
    return DL.read_string_csv(spark, path, {"c_custkey": "bigint", "c_acctbal": "double"})


_SUPPLIER_SCHEMA = StructType([StructField("s_suppkey", IntegerType()), StructField("s_name", StringType()),
                               StructField("s_nationkey", LongType()), StructField("s_acctbal", DoubleType())])


@query("src_apply_schema", """
SELECT CAST(s_suppkey AS INTEGER) AS s_suppkey, s_name, CAST(s_nationkey AS BIGINT) AS s_nationkey, s_acctbal
FROM supplier""")
def src_apply_schema(spark, sf):
    return DL.apply_schema(read_table(spark, sf, "supplier"), _SUPPLIER_SCHEMA)


# ------------------------------------------------------------- records

_LOW = "CASE WHEN p_partkey % 2 = 0 THEN 0 ELSE p_size - 60 END"
_HIGH = "CASE WHEN p_partkey % 2 = 0 THEN 0 ELSE p_size * 3 END"
_CLOUD = "p_size - 150"


def _stage_records(spark, sf) -> str:
    """Write ``part`` as 7 text lines per record (name, type, distance, mass,
    low, high, cloud), records kept whole inside each output file."""
    p = read_table(spark, sf, "part")
    k = F.col("p_partkey")
    even = k % 2 == 0
    fields = [F.col("p_name"), F.col("p_type"), F.col("p_retailprice").cast("string"),
              F.col("p_size").cast("double").cast("string"),
              F.when(even, F.lit(0)).otherwise(F.col("p_size") - 60).cast("string"),
              F.when(even, F.lit(0)).otherwise(F.col("p_size") * 3).cast("string"),
              (F.col("p_size") - 150).cast("string")]
    lines = p.select("p_partkey", F.posexplode(F.array(*fields)).alias("pos", "value"))
    path = shared_path(spark, "records")
    (lines.repartitionByRange("p_partkey").sortWithinPartitions("p_partkey", "pos")
     .select("value").write.text(path))
    return path


def _records(spark, sf):
    lines = RC.numbered_lines(spark, _stage_records(spark, sf), glob="*.txt")
    return RC.stride_records(lines, RC.PLANET_FIELDS, RC.PLANET_TYPES)


_REC_SQL = f"""r AS (SELECT p_name AS name, p_type AS type, p_retailprice AS distance,
       CAST(p_size AS DOUBLE) AS mass, {_LOW} AS low, {_HIGH} AS high, {_CLOUD} AS cloud, p_partkey FROM part)"""


@query("src_stride_records", with_ctes(_REC_SQL, "SELECT name, type, distance, mass, low, high, cloud, false AS rejected FROM r"))
def src_stride_records(spark, sf):
    return _records(spark, sf).drop("file", "record_no")


_VAR_SQL = """v AS (SELECT name, type, distance, mass,
       CASE WHEN NOT (low = 0 AND high = 0) THEN low END AS low,
       CASE WHEN NOT (low = 0 AND high = 0) THEN high END AS high,
       CASE WHEN low = 0 AND high = 0 THEN cloud END AS cloud,
       CASE WHEN low = 0 AND high = 0 THEN 'jovian' ELSE 'terrestrial' END AS variant, p_partkey FROM r)"""


@query("src_record_variant", with_ctes(_REC_SQL, _VAR_SQL, "SELECT name, type, distance, mass, low, high, cloud, variant FROM v"))
def src_record_variant(spark, sf):
    return RC.planet_variant(_records(spark, sf)).select(
        "name", "type", "distance", "mass", "low", "high", "cloud", "variant")


@query("txt_record_render", with_ctes(_REC_SQL, _VAR_SQL, """
SELECT name,
       'Planet Name:' || name || chr(10) || 'Planet type:' || type || chr(10) || 'Distace from Sun (AU):'
       || CAST(distance AS VARCHAR) || chr(10) || 'Mass (kg):' || CAST(mass AS VARCHAR) || chr(10) ||
       CASE WHEN variant = 'jovian' THEN 'Temperature above cloud tops (degrees C):' || CAST(cloud AS VARCHAR)
            ELSE 'Surface Temperature (degrees C):' || CAST(low AS VARCHAR) || ' to ' || CAST(high AS VARCHAR) END
       || chr(10) AS description,
       printf('%s is %.2f million miles from the Sun', name, distance * 93) AS sentence,
       row_number() OVER (ORDER BY distance, p_partkey) AS rank
FROM v"""))
def txt_record_render(spark, sf):
    from sparkwright.operators.ordering import row_number_exact
    r = RC.render_planet(RC.planet_variant(_records(spark, sf)))
    # Ascending distance, ties in file order (file, record number).
    ranked = row_number_exact(r, ["distance", "file", "record_no"], out="rank")
    return ranked.select("name", "description", "sentence", "rank")


# ----------------------------------------------------------- documents


@query("doc_insert_many", """
SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer
UNION ALL
SELECT s_suppkey + 1000000000, s_name, s_nationkey, s_acctbal, 'SUPPLIER' FROM supplier
UNION ALL
SELECT s_suppkey + 1000000000, s_name, s_nationkey, s_acctbal, 'SUPPLIER' FROM supplier""")
def doc_insert_many(spark, sf):
    coll = read_table(spark, sf, "customer")
    s = read_table(spark, sf, "supplier").select(
        (F.col("s_suppkey") + 1000000000).alias("c_custkey"), F.col("s_name").alias("c_name"),
        F.col("s_nationkey").alias("c_nationkey"), F.col("s_acctbal").alias("c_acctbal"),
        F.lit("SUPPLIER").alias("c_mktsegment"))
    once = D.insert_many(coll, s)
    twice = D.insert_many(once, s)                         # a re-run doubles (no key)
    keyed = D.insert_many(twice, s, key=["c_custkey"])     # with a key: no change
    return keyed


@query("doc_update_many", """
SELECT c_custkey, c_name, c_nationkey,
       CASE WHEN c_mktsegment = 'BUILDING' THEN CAST(0 AS DOUBLE) ELSE c_acctbal END AS c_acctbal,
       CASE WHEN c_mktsegment = 'BUILDING' THEN 'CONSTRUCTION' ELSE c_mktsegment END AS c_mktsegment
FROM customer""")
def doc_update_many(spark, sf):
    return D.update_many(read_table(spark, sf, "customer"), {"c_mktsegment": "BUILDING"},
                         {"c_acctbal": 0.0, "c_mktsegment": "CONSTRUCTION"})


def _stored(spark, sf) -> str:
    path = shared_path(spark, "collection")
    read_table(spark, sf, "customer").write.parquet(path)
    return path


@query("doc_update_stored", """
SELECT count(*) FILTER (c_mktsegment = 'BUILDING') AS matched,
       count(*) FILTER (c_mktsegment = 'BUILDING' AND c_nationkey IS DISTINCT FROM 7) AS modified,
       count(*) FILTER (c_mktsegment = 'BUILDING' OR c_nationkey = 7) AS now_seven FROM customer""")
def doc_update_stored(spark, sf):
    path, target = _stored(spark, sf), shared_path(spark, "collection")
    counts = D.update_stored(spark, path, target, {"c_mktsegment": "BUILDING"}, {"c_nationkey": 7})
    return spark.read.parquet(target).agg(
        F.lit(counts["matched"]).cast("bigint").alias("matched"), F.lit(counts["modified"]).cast("bigint").alias("modified"),
        F.count_if(F.col("c_nationkey") == 7).alias("now_seven"))


@query("doc_delete_stored", """
SELECT count(*) FILTER (c_mktsegment = 'AUTOMOBILE') AS deleted,
       count(*) FILTER (c_mktsegment IS DISTINCT FROM 'AUTOMOBILE') AS left_over FROM customer""")
def doc_delete_stored(spark, sf):
    path, target = _stored(spark, sf), shared_path(spark, "collection")
    counts = D.delete_stored(spark, path, target, {"c_mktsegment": "AUTOMOBILE"})
    return spark.read.parquet(target).agg(F.lit(counts["deleted"]).cast("bigint").alias("deleted"),
                                          F.count(F.lit(1)).alias("left_over"))


@query("doc_append_stored", "SELECT 2 * count(*) AS rows, count(DISTINCT c_custkey) AS ids FROM customer")
def doc_append_stored(spark, sf):
    path = _stored(spark, sf)
    D.append_to_table(read_table(spark, sf, "customer"), path)
    return spark.read.parquet(path).agg(F.count(F.lit(1)).alias("rows"), F.count_distinct("c_custkey").alias("ids"))


@query("doc_delete_many", "SELECT * FROM customer WHERE c_mktsegment <> 'AUTOMOBILE' OR c_mktsegment IS NULL")
def doc_delete_many(spark, sf):
    return D.delete_many(read_table(spark, sf, "customer"), {"c_mktsegment": "AUTOMOBILE"})
