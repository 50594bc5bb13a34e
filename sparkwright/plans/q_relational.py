"""Queries for projection, filters, routing, sort, union and key joins."""

from __future__ import annotations

from pyspark.sql import functions as F

from sparkwright.operators import relational as R
from sparkwright.operators.ordering import row_number_exact
from sparkwright.operators.profile import last_per_key
from sparkwright.plans.registry import query, with_ctes
from sparkwright.session import materialize
from sparkwright.sources.tables import FEAT_SQL, feat, read_table

# The order-priority -> label-group dictionary of the feature table.
PRIORITY_GROUP = {"1-URGENT": "A", "2-HIGH": "B", "3-MEDIUM": "C",
                  "4-NOT SPECIFIED": "normal", "5-LOW": "normal"}


@query("proj_select_cast", """
SELECT o_orderkey, CAST(o_custkey AS VARCHAR) AS o_custkey, o_totalprice,
       TRY_CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS prio_num
FROM orders""")
def proj_select_cast(spark, sf):
    o = read_table(spark, sf, "orders")
    typed = R.select_cast(o, {"o_orderkey": "bigint", "o_custkey": "string",
                              "o_totalprice": "double", "o_orderpriority": "string"})
    return typed.select("o_orderkey", "o_custkey", "o_totalprice",
                        F.substring("o_orderpriority", 1, 1).try_cast("int").alias("prio_num"))


@query("proj_with_columns", with_ctes(FEAT_SQL, """
SELECT id, total, total - acctbal AS margin, CAST(total > 250000 AS INTEGER) AS is_big,
       round(qty / nullif(n_lines, 0), 6) AS qty_per_line
FROM feat"""))
def proj_with_columns(spark, sf):
    f = feat(spark, sf).select("id", "total", "acctbal", "qty", "n_lines")
    return R.with_columns(f, {
        "margin": F.col("total") - F.col("acctbal"),
        "is_big": (F.col("total") > 250000).cast("int"),
        "qty_per_line": F.round(F.try_divide("qty", "n_lines"), 6),
    }, drop=["acctbal", "qty", "n_lines"])


@query("filt_find", """
SELECT * FROM customer WHERE c_mktsegment = 'BUILDING' AND c_nationkey = 3""")
def filt_find(spark, sf):
    return R.find(read_table(spark, sf, "customer"), {"c_mktsegment": "BUILDING", "c_nationkey": 3})


@query("filt_find_one", """
SELECT * FROM customer WHERE c_mktsegment = 'MACHINERY' ORDER BY c_custkey LIMIT 1""")
def filt_find_one(spark, sf):
    return R.find_one(read_table(spark, sf, "customer"), ["c_custkey"], {"c_mktsegment": "MACHINERY"})


@query("filt_label_group", with_ctes(FEAT_SQL, """
SELECT id, label_group FROM feat WHERE label_group = 'A' OR label_group = 'normal'"""))
def filt_label_group(spark, sf):
    return R.keep_values(feat(spark, sf), "label_group", ["A", "normal"]).select("id", "label_group")


@query("filt_route", with_ctes(FEAT_SQL, """
SELECT id, CASE WHEN coalesce(total > 200000 AND acctbal > 0, false) THEN 1 ELSE 2 END AS route
FROM feat"""))
def filt_route(spark, sf):
    # Both sides read one copy of the feature table.
    f = materialize(feat(spark, sf).select("id", "total", "acctbal"))
    a, b = R.route(f, (F.col("total") > 200000) & (F.col("acctbal") > 0))
    return R.union_all([a.select("id", F.lit(1).alias("route")), b.select("id", F.lit(2).alias("route"))])


@query("filt_isin", """
SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem
WHERE l_orderkey IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F')""")
def filt_isin(spark, sf):
    keys = read_table(spark, sf, "orders").where(F.col("o_orderstatus") == "F")
    li = read_table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity")
    return R.isin_keys(li, "l_orderkey", keys, key_column="o_orderkey")


@query("agg_class_counts", with_ctes(FEAT_SQL, """
SELECT count(*) FILTER (WHERE label2 = 'attack') AS n_attack,
       count(*) FILTER (WHERE label2 = 'normal') AS n_normal, count(*) AS n_total
FROM feat"""))
def agg_class_counts(spark, sf):
    return R.class_counts(feat(spark, sf), "label2", ["attack", "normal"])


_LAST_SQL = """last AS (
  SELECT user_id, max_by(value + CAST(json_extract_string(props, '$.k') AS DOUBLE), event_id) AS value,
         max(event_id) AS seq
  FROM events GROUP BY user_id)"""


def _last_events(spark, sf):
    e = read_table(spark, sf, "events")
    v = F.col("value") + F.get_json_object("props", "$.k").cast("double")
    return last_per_key(e, "user_id", v, "event_id")


@query("sort_by_value", with_ctes(_LAST_SQL, """
SELECT user_id, round(value, 6) AS value, seq,
       row_number() OVER (ORDER BY value DESC, seq ASC) AS rank
FROM last"""))
def sort_by_value(spark, sf):
    # Computed once: the ranking reads it for its cut points and its rows.
    last = materialize(_last_events(spark, sf).withColumn("_less", -F.col("value")))
    r = row_number_exact(last, ["_less", "seq"], out="rank")
    return r.select("user_id", F.round("value", 6).alias("value"), "seq", "rank")


@query("sort_head", """
SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 10""")
def sort_head(spark, sf):
    o = read_table(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    return R.head(o, 10, [F.col("o_totalprice").desc(), F.col("o_orderkey").asc()])


@query("set_union_scores", with_ctes(FEAT_SQL, """
SELECT id, CAST(1 AS DOUBLE) AS p FROM feat WHERE total >= 400000
UNION ALL
SELECT id, total / CAST(400000 AS DOUBLE) AS p FROM feat WHERE total < 400000"""))
def set_union_scores(spark, sf):
    f = materialize(feat(spark, sf).select("id", "total"))
    hi, lo = R.route(f, F.col("total") >= 400000)
    return R.union_all([hi.select("id", F.lit(1.0).alias("p")),
                        lo.select("id", (F.col("total") / 400000.0).alias("p"))])


@query("join_attach_scores", with_ctes(FEAT_SQL, """
SELECT f.id, f.label2, f.score1, round(greatest(f.acctbal, 0) / 10000.0, 6) AS score2,
       s3.score3
FROM feat f LEFT JOIN (SELECT id, round(qty / 400.0, 6) AS score3 FROM feat WHERE has_return = 1) s3
  ON f.id = s3.id"""))
def join_attach_scores(spark, sf):
    f = materialize(feat(spark, sf).select("id", "label2", "score1", "acctbal", "has_return", "qty"))
    base = f.select("id", "label2", F.lit(None).cast("double").alias("score3"))
    s1 = f.select("id", "score1")
    s2 = f.select("id", F.round(F.greatest("acctbal", F.lit(0.0)) / 10000.0, 6).alias("score2"))
    s3 = f.where(F.col("has_return") == 1).select("id", F.round(F.col("qty") / 400.0, 6).alias("score3"))
    return R.attach_columns(base, "id", s1, s2, s3)


@query("join_features_preds", with_ctes(FEAT_SQL, """
SELECT f.id, f.total, f.qty, p.pred_big, p.pred_ret
FROM feat f JOIN (SELECT id, CAST(total > 250000 AS DOUBLE) AS pred_big,
                         has_return AS pred_ret FROM feat WHERE n_lines > 0) p ON f.id = p.id"""))
def join_features_preds(spark, sf):
    f = materialize(feat(spark, sf).select("id", "total", "qty", "n_lines", "has_return"))
    preds = f.where(F.col("n_lines") > 0).select(
        "id", (F.col("total") > 250000).cast("double").alias("pred_big"), F.col("has_return").alias("pred_ret"))
    return f.select("id", "total", "qty").join(preds, "id", "inner")


@query("join_map_lookup", """
SELECT o_orderkey, o_orderpriority,
       coalesce(CASE o_orderpriority WHEN '1-URGENT' THEN 'A' WHEN '2-HIGH' THEN 'B'
                WHEN '3-MEDIUM' THEN 'C' WHEN '4-NOT SPECIFIED' THEN 'normal'
                WHEN '5-LOW' THEN 'normal' END, 'unknown') AS label_group,
       n_name
FROM orders JOIN customer ON o_custkey = c_custkey LEFT JOIN nation ON c_nationkey = n_nationkey""")
def join_map_lookup(spark, sf):
    o = read_table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderpriority")
    c = read_table(spark, sf, "customer").select("c_custkey", "c_nationkey")
    n = read_table(spark, sf, "nation")
    j = o.join(c, o.o_custkey == c.c_custkey)
    j = R.map_lookup(j, "o_orderpriority", PRIORITY_GROUP, "label_group", unknown="default", default="unknown")
    j = R.table_lookup(j, "c_nationkey", n, "n_nationkey", "n_name", "n_name")
    return j.select("o_orderkey", "o_orderpriority", "label_group", "n_name")
