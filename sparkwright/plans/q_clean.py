"""Queries for cleaning and missing values.

``zoo`` derives null, NaN, '' and '  ' values from ``events`` by fixed key
rules (every row is kept; the rules only decide which value is missing).
"""

from __future__ import annotations

from pyspark.sql import functions as F

from sparkwright.operators import clean as C
from sparkwright.operators.profile import corr_pearson
from sparkwright.plans.registry import query, with_ctes
from sparkwright.sources.tables import FEAT_SQL, feat, read_table


def zoo(spark, sf):
    e = read_table(spark, sf, "events")
    k = F.col("event_id")
    return e.select(
        "event_id",
        F.when(k % 7 == 0, F.lit(float("nan"))).otherwise(F.col("value")).alias("value_nan"),
        F.when(k % 13 == 0, F.lit(None).cast("double")).otherwise(F.col("value")).alias("value_null"),
        F.when(k % 5 == 0, F.lit("")).when(k % 11 == 0, F.lit("  ")).otherwise(F.col("event_type"))
         .alias("label_blank"),
        "user_id")


ZOO_SQL = """zoo AS (
  SELECT event_id,
         CASE WHEN event_id % 7 = 0 THEN CAST('NaN' AS DOUBLE) ELSE value END AS value_nan,
         CASE WHEN event_id % 13 = 0 THEN CAST(NULL AS DOUBLE) ELSE value END AS value_null,
         CASE WHEN event_id % 5 = 0 THEN '' WHEN event_id % 11 = 0 THEN '  ' ELSE event_type END AS label_blank,
         user_id
  FROM events)"""


@query("clean_missing_audit", with_ctes(ZOO_SQL, """
SELECT CAST(0 AS BIGINT) AS event_id, count(*) FILTER (WHERE isnan(value_nan)) AS value_nan,
       count(*) FILTER (WHERE isnan(value_null)) AS value_null, CAST(0 AS BIGINT) AS label_blank,
       CAST(0 AS BIGINT) AS user_id
FROM zoo"""))
def clean_missing_audit(spark, sf):
    return C.nan_counts(zoo(spark, sf))


@query("clean_to_null_drop", with_ctes(ZOO_SQL, """
SELECT * FROM zoo
WHERE value_nan IS NOT NULL AND NOT isnan(value_nan) AND value_null IS NOT NULL
  AND label_blank IS NOT NULL AND trim(label_blank) <> '' AND user_id IS NOT NULL"""))
def clean_to_null_drop(spark, sf):
    return C.drop_incomplete(C.missing_to_null(zoo(spark, sf)))


@query("clean_replace", with_ctes(ZOO_SQL, """
SELECT event_id, CASE WHEN label_blank = '' THEN NULL WHEN label_blank = 'error' THEN 'failure'
                      ELSE label_blank END AS label_blank,
       CASE WHEN value_null = 0.01 THEN -1.0 ELSE value_null END AS value_null
FROM zoo"""))
def clean_replace(spark, sf):
    z = C.blank_to_null(zoo(spark, sf).select("event_id", "label_blank", "value_null"))
    z = C.replace_value(z, "error", "failure", ["label_blank"])
    return C.replace_value(z, 0.01, -1.0, ["value_null"])


@query("clean_fill", with_ctes(ZOO_SQL, """
SELECT event_id, CASE WHEN value_nan IS NULL OR isnan(value_nan) THEN 0.0 ELSE value_nan END AS value_nan,
       coalesce(value_null, 1000.0) AS value_null
FROM zoo"""))
def clean_fill(spark, sf):
    z = zoo(spark, sf).select("event_id", "value_nan", "value_null")
    return C.fill_missing(C.fill_missing(z, 0.0, ["value_nan"]), 1000.0, ["value_null"])


@query("clean_dup_count", """
SELECT CAST(sum(n - 1) AS BIGINT) AS duplicates, CAST(sum(n) AS BIGINT) AS rows, count(*) AS distinct_rows
FROM (SELECT text, count(*) AS n FROM documents GROUP BY text)""")
def clean_dup_count(spark, sf):
    return C.duplicate_count(read_table(spark, sf, "documents"), ["text"])


@query("clean_dedup", """
SELECT doc_id, lang, n_chars FROM documents
WHERE doc_id IN (SELECT min(doc_id) FROM documents GROUP BY text)""")
def clean_dedup(spark, sf):
    d = read_table(spark, sf, "documents")
    return C.dedup(d, ["text"], ["doc_id"], ["doc_id", "lang", "n_chars"])


@query("clean_drop_constant", with_ctes(FEAT_SQL, "SELECT id, total, acctbal, has_return FROM feat"))
def clean_drop_constant(spark, sf):
    f = feat(spark, sf).select("id", "total", "acctbal", "const_col", "has_return")
    return C.drop_constant_columns(f, ["total", "acctbal", "const_col", "has_return"])


_CORR_ORDER = ["total", "acctbal", "n_lines", "qty", "avg_disc", "has_return", "acct_negative"]
_CORR_T = 0.5


def _drop_corr_sql():
    parts = []
    for j, b in enumerate(_CORR_ORDER):
        if j == 0:
            cond = "0"
        else:
            hits = " OR ".join(f"coalesce(abs(corr({a}, {b})) >= {_CORR_T}, false)" for a in _CORR_ORDER[:j])
            cond = f"CASE WHEN {hits} THEN 1 ELSE 0 END"
        src = " FROM feat" if j else ""
        parts.append(f"SELECT '{b}' AS feature, {j} AS position, {cond} AS dropped{src}")
    return with_ctes(FEAT_SQL, "\nUNION ALL\n".join(parts))


@query("feat_drop_correlated", _drop_corr_sql())
def feat_drop_correlated(spark, sf):
    corr = corr_pearson(feat(spark, sf), _CORR_ORDER)
    return C.correlated_to_drop(corr, _CORR_T, _CORR_ORDER)
