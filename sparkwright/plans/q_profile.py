"""Queries for profiling aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from sparkwright.operators import profile as P
from sparkwright.plans.registry import query, with_ctes
from sparkwright.session import materialize
from sparkwright.sources.tables import FEAT_NUMERIC, FEAT_SQL, feat, read_table


def round_doubles(df: DataFrame, digits: int = 6) -> DataFrame:
    """Round every double column (aggregates differ in the last bits between
    engines because of summation order)."""
    return df.select(*[F.round(F.col(f"`{f.name}`"), digits).alias(f.name)
                       if isinstance(f.dataType, DoubleType) else F.col(f"`{f.name}`")
                       for f in df.schema.fields])


def feat_once(spark, sf, cols: list[str]) -> DataFrame:
    """``feat`` for the multi-pass exact-rank queries: they read their input
    several times (ranges or describe, the cut-point sample, the ranked rows), and
    ``feat`` is a join over the line-item aggregate: at
    scale that is three scans and shuffles of the largest table.  The needed
    columns are computed once and written to the shared folder; every pass
    reads that copy."""
    return materialize(feat(spark, sf).select(*cols))


def _union(parts: list[str]) -> str:
    return "\nUNION ALL\n".join(parts)


# ------------------------------------------------------------------ A1-A5

@query("agg_shape", "SELECT count(*) AS rows, CAST(11 AS BIGINT) AS columns FROM lineitem")
def agg_shape(spark, sf):
    return P.shape(read_table(spark, sf, "lineitem"))


@query("agg_value_counts", "SELECT event_type, count(*) AS count FROM events GROUP BY event_type")
def agg_value_counts(spark, sf):
    return P.value_counts(read_table(spark, sf, "events"), "event_type")


_DISTINCT_COLS = ["l_returnflag", "l_linestatus", "l_partkey", "l_suppkey"]


@query("agg_distinct", "SELECT " + ", ".join(f"count(DISTINCT {c}) AS {c}" for c in _DISTINCT_COLS)
       + " FROM lineitem")
def agg_distinct(spark, sf):
    return P.distinct_counts(read_table(spark, sf, "lineitem"), _DISTINCT_COLS)


@query("agg_crosstab", with_ctes(FEAT_SQL, """
SELECT status AS status_label_group,
       count(*) FILTER (WHERE label_group = 'A') AS "A", count(*) FILTER (WHERE label_group = 'B') AS "B",
       count(*) FILTER (WHERE label_group = 'C') AS "C",
       count(*) FILTER (WHERE label_group = 'normal') AS "normal"
FROM feat GROUP BY status"""))
def agg_crosstab(spark, sf):
    return P.crosstab(feat(spark, sf), "status", "label_group")


# ------------------------------------------------------------------ A6-A9

_DESCRIBE_SQL = _union([
    f"""SELECT '{c}' AS "column", count({c}) AS count, round(avg({c}), 6) AS mean,
       round(stddev_samp({c}), 6) AS stddev, round(min({c}), 6) AS min, round(max({c}), 6) AS max FROM feat"""
    for c in FEAT_NUMERIC])


@query("agg_describe", with_ctes(FEAT_SQL, _DESCRIBE_SQL))
def agg_describe(spark, sf):
    return round_doubles(P.describe(feat(spark, sf), FEAT_NUMERIC))


_QUART_COLS = ["total", "qty", "n_lines"]
_QUART_SQL = _union([
    f"""SELECT '{c}' AS "column", count({c}) AS count, round(avg({c}), 6) AS mean,
       round(stddev_samp({c}), 6) AS stddev, round(min({c}), 6) AS min, round(max({c}), 6) AS max,
       round(quantile_cont({c}, 0.25), 6) AS q25, round(quantile_cont({c}, 0.5), 6) AS q50,
       round(quantile_cont({c}, 0.75), 6) AS q75 FROM feat""" for c in _QUART_COLS])


@query("agg_describe_quartiles", with_ctes(FEAT_SQL, _QUART_SQL))
def agg_describe_quartiles(spark, sf):
    return round_doubles(P.describe_quartiles(feat_once(spark, sf, ["id", *_QUART_COLS]), _QUART_COLS))


@query("agg_describe_by_class", with_ctes(FEAT_SQL, """
SELECT label2, count(total) AS count, round(avg(total), 6) AS mean, round(stddev_samp(total), 6) AS stddev,
       round(min(total), 6) AS min, round(max(total), 6) AS max,
       round(quantile_cont(total, 0.25), 6) AS q25, round(quantile_cont(total, 0.5), 6) AS q50,
       round(quantile_cont(total, 0.75), 6) AS q75
FROM feat GROUP BY label2"""))
def agg_describe_by_class(spark, sf):
    return round_doubles(P.describe_by_class(feat_once(spark, sf, ["total", "label2"]), "total", "label2"))


# The customer table's columns and their Spark type names.
_CUSTOMER_TYPES = [("c_custkey", "bigint"), ("c_name", "string"), ("c_nationkey", "int"),
                   ("c_acctbal", "double"), ("c_mktsegment", "string")]


@query("agg_info", _union([
    f"""SELECT {i} AS position, '{c}' AS "column", '{t}' AS dtype, count({c}) AS non_null FROM customer"""
    for i, (c, t) in enumerate(_CUSTOMER_TYPES)]))
def agg_info(spark, sf):
    return P.info(read_table(spark, sf, "customer"))


# ---------------------------------------------------------------- A18/A19

_CORR_COLS = ["total", "acctbal", "n_lines", "qty", "avg_disc", "has_return", "acct_negative"]
_CORR_PAIRS = [(a, b) for i, a in enumerate(_CORR_COLS) for b in _CORR_COLS[i + 1:]]


@query("agg_corr_pearson", with_ctes(FEAT_SQL, _union([
    f"SELECT '{a}' AS a, '{b}' AS b, round(corr({a}, {b}), 6) AS corr FROM feat" for a, b in _CORR_PAIRS])))
def agg_corr_pearson(spark, sf):
    return round_doubles(P.corr_pearson(feat(spark, sf), _CORR_COLS))


_SP_COLS = ["total", "acctbal", "n_lines", "qty"]
_SP_PAIRS = [(a, b) for i, a in enumerate(_SP_COLS) for b in _SP_COLS[i + 1:]]
_SP_RANKS = "r AS (SELECT id, " + ", ".join(
    f"rank() OVER (ORDER BY {c}) + (count(*) OVER (PARTITION BY {c}) - 1) / 2.0 AS {c}" for c in _SP_COLS
) + " FROM feat)"


@query("agg_corr_spearman", with_ctes(FEAT_SQL, _SP_RANKS, _union([
    f"SELECT '{a}' AS a, '{b}' AS b, round(corr({a}, {b}), 6) AS corr FROM r" for a, b in _SP_PAIRS])))
def agg_corr_spearman(spark, sf):
    return round_doubles(P.corr_spearman(feat_once(spark, sf, _SP_COLS), _SP_COLS))


# ---------------------------------------------------------------- A20-A22


def _hist_sql(cols: list[str], bins: int, by: str | None = None) -> str:
    g = f", {by}" if by else ""
    gsel = f"{by}, " if by else ""
    long = _union([f"SELECT '{c}' AS \"column\"{g}, CAST({c} AS DOUBLE) AS value FROM feat WHERE {c} IS NOT NULL"
                   for c in cols])
    jcond = " AND b." + by + " = l." + by if by else ""
    return with_ctes(
        FEAT_SQL,
        f"l AS ({long})",
        f"""b AS (SELECT "column"{g}, min(value) AS mn, max(value) AS mx, count(*) AS n
             FROM l GROUP BY "column"{g})""",
        f"""c AS (SELECT l."column"{', l.' + by if by else ''},
                   CASE WHEN b.mx = b.mn THEN 1
                        ELSE least(CAST(floor((l.value - b.mn) * {bins} / (b.mx - b.mn)) AS BIGINT) + 1, {bins})
                   END AS bin, count(*) AS cnt
             FROM l JOIN b ON b."column" = l."column"{jcond} GROUP BY ALL)""",
        f"""g AS (SELECT b.*, s.bin FROM b, (SELECT CAST(range AS INTEGER) AS bin
             FROM range(1, {bins + 1})) s)""",
        f"""SELECT g."column", {('g.' + by + ', ') if by else ''}g.bin,
       round(g.mn + (g.bin - 1) * ((g.mx - g.mn) / {bins}), 6) AS lo,
       round(g.mn + g.bin * ((g.mx - g.mn) / {bins}), 6) AS hi,
       CAST(coalesce(c.cnt, 0) AS BIGINT) AS count,
       round(coalesce(c.cnt, 0) / nullif(g.n * ((g.mx - g.mn) / {bins}), 0), 6) AS density
FROM g LEFT JOIN c ON c."column" = g."column" AND c.bin = g.bin{(' AND c.' + by + ' = g.' + by) if by else ''}""")


@query("agg_histogram", _hist_sql(["total", "qty", "avg_disc"], 10))
def agg_histogram(spark, sf):
    cols = ["total", "qty", "avg_disc"]
    return round_doubles(P.histogram(feat_once(spark, sf, cols), cols, bins=10))


@query("agg_histogram_by_class", _hist_sql(["total"], 50, "label2"))
def agg_histogram_by_class(spark, sf):
    return round_doubles(P.histogram(feat_once(spark, sf, ["total", "label2"]), ["total"], bins=50, by="label2"))


_KDE_COLS = ["avg_disc", "n_lines"]
_KDE_POINTS = P.KDE_POINTS


@query("agg_kde", with_ctes(
    FEAT_SQL,
    "l AS (" + _union([f"SELECT '{c}' AS \"column\", CAST({c} AS DOUBLE) AS value FROM feat" for c in _KDE_COLS]) + ")",
    """b AS (SELECT "column", min(value) AS mn, max(value) AS mx, count(value) AS n,
              stddev_samp(value) * pow(CAST(count(value) AS DOUBLE), -0.2) AS h FROM l GROUP BY "column")""",
    f"""g AS (SELECT b.*, CAST(range AS INTEGER) AS point, b.mn + (b.mx - b.mn) / {_KDE_POINTS - 1} * range AS x
         FROM b, range(0, {_KDE_POINTS}))""",
    """SELECT g."column", g.point, round(g.x, 6) AS x,
       round(sum(exp(-0.5 * pow((g.x - l.value) / g.h, 2))) / (g.n * g.h * sqrt(2 * pi())), 6) AS density
FROM g JOIN l ON l."column" = g."column" GROUP BY g."column", g.point, g.x, g.n, g.h"""))
def agg_kde(spark, sf):
    return round_doubles(P.kde(feat_once(spark, sf, _KDE_COLS), _KDE_COLS))


# ---------------------------------------------------------------- A23-A25


@query("agg_last_per_key", """
SELECT user_id, round(max_by(value * 2 + CAST(json_extract_string(props, '$.k') AS DOUBLE), event_id), 6) AS value,
       max(event_id) AS seq
FROM events GROUP BY user_id""")
def agg_last_per_key(spark, sf):
    e = read_table(spark, sf, "events")
    v = F.col("value") * 2 + F.get_json_object("props", "$.k").cast("double")
    return round_doubles(P.last_per_key(e, "user_id", v, "event_id"))


@query("agg_cluster_profile", with_ctes(FEAT_SQL, """
SELECT CAST(floor(total / 50000) AS INTEGER) AS cluster_label2,
       count(*) FILTER (WHERE label2 = 'attack') AS attack,
       count(*) FILTER (WHERE label2 = 'normal') AS normal, count(*) AS count
FROM feat GROUP BY 1"""))
def agg_cluster_profile(spark, sf):
    f = feat(spark, sf).withColumn("cluster", F.floor(F.col("total") / 50000).cast("int"))
    return P.cluster_profile(f, "cluster", "label2")


@query("proj_case_bins", """
SELECT c_custkey, c_acctbal / CAST(100 AS DOUBLE) AS age,
       CASE WHEN c_acctbal / CAST(100 AS DOUBLE) BETWEEN 14.9 AND 27.49 THEN 1
            WHEN c_acctbal / CAST(100 AS DOUBLE) BETWEEN 27.5 AND 39.99 THEN 2
            WHEN c_acctbal / CAST(100 AS DOUBLE) BETWEEN 40.0 AND 52.49 THEN 3
            WHEN c_acctbal / CAST(100 AS DOUBLE) BETWEEN 52.5 AND 64.49 THEN 4 END AS bins
FROM customer""")
def proj_case_bins(spark, sf):
    c = read_table(spark, sf, "customer").select("c_custkey", (F.col("c_acctbal") / 100.0).alias("age"))
    return P.case_bins(c, "age", "bins")


@query("proj_bucketize", """
SELECT c_custkey, c_acctbal / CAST(100 AS DOUBLE) AS age,
       CASE WHEN c_acctbal / CAST(100 AS DOUBLE) >= 52.5 AND c_acctbal / CAST(100 AS DOUBLE) <= 65.0 THEN 4
            WHEN c_acctbal / CAST(100 AS DOUBLE) >= 40.0 AND c_acctbal / CAST(100 AS DOUBLE) < 52.5 THEN 3
            WHEN c_acctbal / CAST(100 AS DOUBLE) >= 27.5 AND c_acctbal / CAST(100 AS DOUBLE) < 40.0 THEN 2
            WHEN c_acctbal / CAST(100 AS DOUBLE) >= 15.0 AND c_acctbal / CAST(100 AS DOUBLE) < 27.5 THEN 1
       END AS bucket
FROM customer""")
def proj_bucketize(spark, sf):
    c = read_table(spark, sf, "customer").select("c_custkey", (F.col("c_acctbal") / 100.0).alias("age"))
    return P.bucketize(c, "age", P.even_splits(15.0, 65.0, 4), "bucket")
