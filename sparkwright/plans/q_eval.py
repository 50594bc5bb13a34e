"""Queries for thresholds, votes and evaluation.

Three deterministic rule scores over ``feat`` stand in for model outputs, so
every metric has an exact SQL twin; the label is ``label2 == 'attack'``.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from sparkwright.operators import evaluate as E
from sparkwright.operators import votes as V
from sparkwright.operators.relational import union_all
from sparkwright.plans.q_profile import round_doubles
from sparkwright.plans.registry import query, with_ctes
from sparkwright.session import materialize
from sparkwright.sources.tables import FEAT_SQL, feat


def scored(spark, sf):
    f = feat(spark, sf)
    return f.select(
        "id", "label_group", "total",
        F.when(F.col("label2") == "attack", 1.0).otherwise(0.0).alias("y"),
        "score1",
        F.when(F.col("n_lines") >= 7, 1.0).otherwise(F.col("n_lines") / 7.0).alias("score2"),
        F.least(F.col("avg_disc") * 10.0, F.lit(1.0)).alias("score3"))


SCORED_SQL = """sc AS (
  SELECT id, label_group, total, CAST(CASE WHEN label2 = 'attack' THEN 1 ELSE 0 END AS DOUBLE) AS y, score1,
         CASE WHEN n_lines >= 7 THEN CAST(1 AS DOUBLE) ELSE n_lines / CAST(7 AS DOUBLE) END AS score2,
         least(avg_disc * CAST(10 AS DOUBLE), CAST(1 AS DOUBLE)) AS score3
  FROM feat)"""


def _sql(*parts):
    return with_ctes(FEAT_SQL, SCORED_SQL, *parts)


def metrics_sql(src: str) -> str:
    """Metric columns from a relation with tn, fp, fn, tp (same rules as E)."""
    TN, FP, FN, TP = (f"CAST({x} AS DOUBLE)" for x in ("tn", "fp", "fn", "tp"))
    far = f"{FP} / nullif({FP} + {TN}, 0)"
    dr = f"{TP} / nullif({TP} + {FN}, 0)"
    return f"""SELECT *, round(({TP} + {TN}) / nullif({TN} + {FP} + {FN} + {TP}, 0), 6) AS accuracy,
  round(coalesce({TP} / nullif({TP} + {FP}, 0), 0.0), 6) AS precision,
  round(coalesce({TP} / nullif({TP} + {FN}, 0), 0.0), 6) AS recall,
  round(coalesce(2 * {TP} / nullif(2 * {TP} + {FP} + {FN}, 0), 0.0), 6) AS f1,
  round(coalesce(({TP} * {TN} - {FP} * {FN}) /
        nullif(sqrt(({TP} + {FP}) * ({TP} + {FN}) * ({TN} + {FP}) * ({TN} + {FN})), 0), 0.0), 6) AS mcc,
  round({far}, 6) AS false_alarm_rate, round({dr}, 6) AS detection_rate,
  round(({dr} + 1 - {far}) / 2, 6) AS balanced_accuracy, CAST(fp + fn AS BIGINT) AS errors
FROM {src}"""


def cells_sql(pred: str, label: str = "y") -> str:
    return f"""count(*) FILTER (WHERE {label} = 0.0 AND {pred} = 0.0) AS tn,
  count(*) FILTER (WHERE {label} = 0.0 AND {pred} = 1.0) AS fp,
  count(*) FILTER (WHERE {label} = 1.0 AND {pred} = 0.0) AS fn,
  count(*) FILTER (WHERE {label} = 1.0 AND {pred} = 1.0) AS tp"""


def thr_sql(col: str, e: float) -> str:
    return f"CAST(CASE WHEN {col} IS NULL THEN NULL WHEN {col} >= {e} THEN 1 ELSE 0 END AS DOUBLE)"


# --------------------------------------------------------------- votes


@query("vote_threshold", _sql(f"SELECT id, {thr_sql('score1', 0.5)} AS pred FROM sc"))
def vote_threshold(spark, sf):
    return scored(spark, sf).select("id", V.threshold("score1", 0.5).alias("pred"))


@query("vote_mean", _sql("SELECT id, round((score1 + score2 + score3) / 3.0, 6) AS vote FROM sc"))
def vote_mean(spark, sf):
    return round_doubles(scored(spark, sf).select("id", V.mean_of(["score1", "score2", "score3"]).alias("vote")))


@query("vote_or", _sql(f"""
SELECT id, CAST((CAST({thr_sql('score1', 0.5)} AS INTEGER) | CAST({thr_sql('score2', 0.5)} AS INTEGER)
                | CAST({thr_sql('score3', 0.5)} AS INTEGER)) AS DOUBLE) AS flag FROM sc"""))
def vote_or(spark, sf):
    s = scored(spark, sf)
    flags = s.select("id", *[V.threshold(c, 0.5).alias(f"f{i}") for i, c in enumerate(["score1", "score2", "score3"])])
    return flags.select("id", V.any_flag(["f0", "f1", "f2"]).alias("flag"))


_WEIGHTS = {"score1": 2, "score2": 1, "score3": 1}


@query("vote_weighted", _sql("SELECT id, round((score1 * 2.0 + score2 * 1.0 + score3 * 1.0) / 4.0, 6) AS vote FROM sc"))
def vote_weighted(spark, sf):
    return round_doubles(scored(spark, sf).select("id", V.weighted_vote(_WEIGHTS).alias("vote")))


_FIVE = {"score1": 3, "score2": 1, "score3": 1, "score4": 1, "score5": 1}


@query("vote_weighted_five", _sql("""
SELECT id, round((score1 * 3.0 + score2 + score3 + (score1 + score2) / 2.0 + (score2 + score3) / 2.0) / 7.0, 6) AS vote
FROM sc"""))
def vote_weighted_five(spark, sf):
    s = scored(spark, sf).withColumns({"score4": (F.col("score1") + F.col("score2")) / 2.0,
                                       "score5": (F.col("score2") + F.col("score3")) / 2.0})
    return round_doubles(s.select("id", V.weighted_vote(_FIVE).alias("vote")))


# ---------------------------------------------------------- evaluation


@query("eval_confusion", _sql(f"""
p AS (SELECT y, {thr_sql('score1', 0.5)} AS pred FROM sc)""", """
g AS (SELECT a.v AS label, b.v AS prediction FROM (VALUES (0.0), (1.0)) a(v), (VALUES (0.0), (1.0)) b(v))""", """
SELECT CAST(g.label AS DOUBLE) AS label, CAST(g.prediction AS DOUBLE) AS prediction,
       count(p.y) AS count
FROM g LEFT JOIN p ON p.y = g.label AND p.pred = g.prediction GROUP BY g.label, g.prediction"""))
def eval_confusion(spark, sf):
    s = scored(spark, sf).withColumn("pred", V.threshold("score1", 0.5))
    return E.confusion(s, "y", "pred", [0.0, 1.0])


@query("eval_binary_report", _sql(f"""
p AS (SELECT y, {thr_sql('(score1 + score2 + score3) / 3.0', 0.5)} AS pred FROM sc)""", f"""
c AS (SELECT {cells_sql('pred')} FROM p)""", metrics_sql("c")))
def eval_binary_report(spark, sf):
    s = scored(spark, sf).withColumn("pred", V.threshold(V.mean_of(["score1", "score2", "score3"]), 0.5))
    return round_doubles(E.binary_report(s, "y", "pred"))


@query("eval_threshold_report", _sql(f"""
c AS (SELECT {cells_sql(thr_sql('score1', 0.5))} FROM sc)""", metrics_sql("c")))
def eval_threshold_report(spark, sf):
    return round_doubles(E.threshold_report(scored(spark, sf), "y", "score1", 0.5))


_SWEEP = [0.5, 0.05, 0.01, 0.005]


@query("eval_threshold_sweep", _sql(
    "v AS (SELECT y, (score1 + score2 + score3) / 3.0 AS vote FROM sc)",
    "c AS (" + "\nUNION ALL\n".join(
        f"SELECT CAST({t} AS DOUBLE) AS threshold, {cells_sql(thr_sql('vote', t))} FROM v" for t in _SWEEP) + ")",
    metrics_sql("c")))
def eval_threshold_sweep(spark, sf):
    s = scored(spark, sf).withColumn("vote", V.mean_of(["score1", "score2", "score3"]))
    return round_doubles(E.threshold_sweep(s, "y", "vote", _SWEEP))


@query("eval_auc_scores", _sql("""
r AS (SELECT score1, count(*) FILTER (WHERE y = 1.0) AS pos, count(*) FILTER (WHERE y <> 1.0) AS neg
      FROM sc GROUP BY score1)""", """
c AS (SELECT *, sum(neg) OVER (ORDER BY score1 ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS below FROM r)""", """
SELECT round(sum(pos * (coalesce(below, 0) + 0.5 * neg)) / (CAST(sum(pos) AS DOUBLE) * sum(neg)), 6) AS auc,
       CAST(sum(pos) AS BIGINT) AS positives, CAST(sum(neg) AS BIGINT) AS negatives FROM c"""))
def eval_auc_scores(spark, sf):
    return round_doubles(E.auc(scored(spark, sf), "y", "score1"))


_GROUPS = ["A", "B", "C", "normal"]
_PRED_GROUP_SQL = ("CASE WHEN total > 300000 THEN 'A' WHEN total > 200000 THEN 'B' "
                   "WHEN total > 100000 THEN 'C' ELSE 'normal' END")


@query("eval_class_report", _sql(f"""
p AS (SELECT label_group AS label, {_PRED_GROUP_SQL} AS pred FROM sc)""", """
k AS (SELECT * FROM (VALUES ('A'), ('B'), ('C'), ('normal')) t(cls))""", """
pc AS (SELECT k.cls,
              count(*) FILTER (WHERE p.label = k.cls AND p.pred = k.cls) AS tp,
              count(*) FILTER (WHERE p.label = k.cls) AS support,
              count(*) FILTER (WHERE p.pred = k.cls) AS npred
       FROM k, p GROUP BY k.cls)""", """
m AS (SELECT cls, coalesce(CAST(tp AS DOUBLE) / nullif(npred, 0), 0.0) AS precision,
             coalesce(CAST(tp AS DOUBLE) / nullif(support, 0), 0.0) AS recall,
             coalesce(2.0 * tp / nullif(npred + support, 0), 0.0) AS f1, support, tp FROM pc)""", """
SELECT cls AS class, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1,
       CAST(support AS BIGINT) AS support FROM m
UNION ALL
SELECT 'accuracy', round(sum(tp) / CAST(sum(support) AS DOUBLE), 6), round(sum(tp) / CAST(sum(support) AS DOUBLE), 6),
       round(sum(tp) / CAST(sum(support) AS DOUBLE), 6), CAST(sum(support) AS BIGINT) FROM m
UNION ALL
SELECT 'macro avg', round(avg(precision), 6), round(avg(recall), 6), round(avg(f1), 6), CAST(sum(support) AS BIGINT)
FROM m
UNION ALL
SELECT 'weighted avg', round(sum(precision * support) / sum(support), 6), round(sum(recall * support) / sum(support), 6),
       round(sum(f1 * support) / sum(support), 6), CAST(sum(support) AS BIGINT) FROM m"""))
def eval_class_report(spark, sf):
    s = scored(spark, sf)
    t = F.col("total")
    s = s.withColumn("pred", F.when(t > 300000, "A").when(t > 200000, "B").when(t > 100000, "C").otherwise("normal"))
    return round_doubles(E.class_report(s, "label_group", "pred", _GROUPS))


@query("eval_subset_report", _sql(f"""
c AS (SELECT {cells_sql(thr_sql('score1', 0.5))} FROM sc WHERE label_group = 'A' OR label_group = 'normal')""",
                                  metrics_sql("c")))
def eval_subset_report(spark, sf):
    """E10 on a label subset: the detector's own group against normal."""
    s = scored(spark, sf).where(F.col("label_group").isin("A", "normal"))
    return round_doubles(E.full_report(s, "y", "score1", 0.5)["metrics"])


def _subset_report_sql(name: str, where: str) -> str:
    """confusion, metric and class rows of one label subset."""
    p = f"(SELECT y, {thr_sql('score1', 0.5)} AS pred FROM sc WHERE {where})"
    cells = f"(SELECT {cells_sql('pred')} FROM {p})"
    metrics = ["tn", "fp", "fn", "tp", "accuracy", "precision", "recall", "f1", "mcc", "false_alarm_rate",
               "detection_rate", "balanced_accuracy", "errors"]
    rows = [f"SELECT '{name}' AS subset, 'confusion' AS section, '{a}|{b}' AS name, CAST({c} AS DOUBLE) AS value FROM {cells}"
            for a, b, c in (("0.0", "0.0", "tn"), ("0.0", "1.0", "fp"), ("1.0", "0.0", "fn"), ("1.0", "1.0", "tp"))]
    rows += [f"SELECT '{name}', 'metrics', '{m}', CAST({m} AS DOUBLE) FROM ({metrics_sql(cells)})" for m in metrics]
    per = []
    for cls, tp, fp, fn in (("0.0", "tn", "fn", "fp"), ("1.0", "tp", "fp", "fn")):
        per.append((cls, f"coalesce({tp} / nullif({tp} + {fp}, 0), 0.0)", f"coalesce({tp} / nullif({tp} + {fn}, 0), 0.0)",
                    f"coalesce(2 * {tp} / nullif(2 * {tp} + {fp} + {fn}, 0), 0.0)", f"({tp} + {fn})"))
    n, acc = "(tn + fp + fn + tp)", "(tn + tp) / (tn + fp + fn + tp)"
    mean = lambda i: f"({per[0][i]} + {per[1][i]}) / 2"
    weighted = lambda i: f"({per[0][i]} * {per[0][4]} + {per[1][i]} * {per[1][4]}) / {n}"
    table = [*per, ("accuracy", acc, acc, acc, n), ("macro avg", mean(1), mean(2), mean(3), n),
             ("weighted avg", weighted(1), weighted(2), weighted(3), n)]
    for cls, *values in table:
        rows += [f"SELECT '{name}', 'classes', '{cls}|{m}', round(CAST({v} AS DOUBLE), 6) FROM {cells}"
                 for m, v in zip(("precision", "recall", "f1", "support"), values)]
    return "\nUNION ALL\n".join(rows)


_SUBSETS = {"all": "true", "A": "label_group IN ('A', 'normal')"}


# Confusion matrix, metrics and class table, per label subset.
@query("eval_full_report", _sql("\nUNION ALL\n".join(_subset_report_sql(n, w) for n, w in _SUBSETS.items())))
def eval_full_report(spark, sf):
    s = materialize(scored(spark, sf).select("y", "label_group", "score1"))
    return round_doubles(union_all([E.long_report(s.where(w), "y", "score1", 0.5).select(F.lit(n).alias("subset"), "*")
                                    for n, w in _SUBSETS.items()]))
