"""Classifier evaluation (E1-E11) from aggregates only.

Predictions never travel to the driver: every metric derives from the cells
of the confusion matrix, computed by one aggregate (conditional counts).
Zero denominators: precision, recall, F1, MCC -> 0.0; FAR, detection rate,
balanced accuracy, AUC -> null.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkwright.functions.exprs import safe_div
from sparkwright.operators.ordering import running_total
from sparkwright.operators.votes import threshold
from sparkwright.session import materialize


def _number(cond: Column, weight: str | None) -> Column:
    """Rows for which ``cond`` holds; rows that stand for ``weight`` others
    count as often."""
    return F.count_if(cond) if weight is None else F.coalesce(F.sum(F.when(cond, F.col(weight))), F.lit(0))


def confusion(df: DataFrame, label: str, pred: str, classes: list, weight: str | None = None) -> DataFrame:
    """Long matrix (label, prediction, count), every cell of the class grid
    present (zeros kept)."""
    cells = [(a, b) for a in classes for b in classes]
    one = df.agg(*[_number((F.col(label) == F.lit(a)) & (F.col(pred) == F.lit(b)), weight).alias(f"c{i}")
                   for i, (a, b) in enumerate(cells)])
    rows = [F.struct(F.lit(a).alias("label"), F.lit(b).alias("prediction"), F.col(f"c{i}").alias("count"))
            for i, (a, b) in enumerate(cells)]
    return one.select(F.inline(F.array(*rows)))


def _cells(label: Column, pred: Column, positive, negative, weight: str | None = None) -> list[Column]:
    pos, neg = F.lit(positive), F.lit(negative)
    return [_number((label == neg) & (pred == neg), weight).alias("tn"),
            _number((label == neg) & (pred == pos), weight).alias("fp"),
            _number((label == pos) & (pred == neg), weight).alias("fn"),
            _number((label == pos) & (pred == pos), weight).alias("tp")]


def _metrics(tn="tn", fp="fp", fn="fn", tp="tp") -> list[Column]:
    TN, FP, FN, TP = [F.col(x).cast("double") for x in (tn, fp, fn, tp)]
    n = TN + FP + FN + TP
    z = F.lit(0.0)
    prec = F.coalesce(safe_div(TP, TP + FP), z)
    rec = F.coalesce(safe_div(TP, TP + FN), z)
    f1 = F.coalesce(safe_div(2 * TP, 2 * TP + FP + FN), z)
    mcc_den = F.sqrt((TP + FP) * (TP + FN) * (TN + FP) * (TN + FN))
    mcc = F.coalesce(safe_div(TP * TN - FP * FN, mcc_den), z)
    far = safe_div(FP, FP + TN)
    dr = safe_div(TP, TP + FN)
    return [safe_div(TP + TN, n).alias("accuracy"), prec.alias("precision"), rec.alias("recall"),
            f1.alias("f1"), mcc.alias("mcc"), far.alias("false_alarm_rate"), dr.alias("detection_rate"),
            ((dr + 1 - far) / 2).alias("balanced_accuracy"), (FP + FN).cast("long").alias("errors")]


def binary_report(df: DataFrame, label: str, pred: str, positive=1.0, negative=0.0,
                  weight: str | None = None) -> DataFrame:
    """One row: cells, accuracy, precision, recall, F1, MCC,
    false-alarm rate, detection rate, balanced accuracy (the hard-label
    "AUC" of the reference), number of errors."""
    cells = df.agg(*_cells(F.col(label), F.col(pred), positive, negative, weight))
    return cells.select("tn", "fp", "fn", "tp", *_metrics())


def threshold_report(df: DataFrame, label: str, score: str, e: float | None,
                     positive=1.0, negative=0.0) -> DataFrame:
    """Report at threshold ``e``; ``e is None`` means ``score`` already
    holds hard labels (0 is a valid threshold)."""
    pred = threshold(score, e) if e is not None else F.col(score)
    return binary_report(df.withColumn("_pred", pred), label, "_pred", positive, negative)


def threshold_sweep(df: DataFrame, label: str, score: str, thresholds: list[float],
                    positive=1.0, negative=0.0) -> DataFrame:
    """The report at several thresholds from ONE scan: the four cells per
    threshold are conditional counts of a single aggregate."""
    aggs = []
    for i, t in enumerate(thresholds):
        pred = threshold(score, t)
        lab, pos, neg = F.col(label), F.lit(positive), F.lit(negative)
        aggs += [F.count_if((lab == neg) & (pred == neg)).alias(f"tn_{i}"),
                 F.count_if((lab == neg) & (pred == pos)).alias(f"fp_{i}"),
                 F.count_if((lab == pos) & (pred == neg)).alias(f"fn_{i}"),
                 F.count_if((lab == pos) & (pred == pos)).alias(f"tp_{i}")]
    one = df.agg(*aggs)
    rows = [F.struct(F.lit(float(t)).alias("threshold"),
                     *[F.col(f"{k}_{i}").alias(k) for k in ("tn", "fp", "fn", "tp")])
            for i, t in enumerate(thresholds)]
    long = one.select(F.inline(F.array(*rows)))
    return long.select("threshold", "tn", "fp", "fn", "tp", *_metrics())


def auc(df: DataFrame, label: str, score: str, positive=1.0) -> DataFrame:
    """ROC AUC on scores by the rank-sum identity: for each distinct
    score, positives there beat the negatives below it plus half the ties.
    Scores are ordered by a distributed running total (no single task)."""
    per = (df.where(F.col(score).isNotNull() & F.col(label).isNotNull())
           .groupBy(score).agg(F.count_if(F.col(label) == F.lit(positive)).alias("_pos"),
                               F.count_if(F.col(label) != F.lit(positive)).alias("_neg")))
    cum = running_total(per, [score], "_neg", out="_cneg")
    below = F.col("_cneg") - F.col("_neg")
    return cum.agg(safe_div(F.sum(F.col("_pos") * (below + 0.5 * F.col("_neg"))),
                            F.sum("_pos").cast("double") * F.sum("_neg")).alias("auc"),
                   F.sum("_pos").alias("positives"), F.sum("_neg").alias("negatives"))


def class_report(df: DataFrame, label: str, pred: str, classes: list, weight: str | None = None) -> DataFrame:
    """Per class precision, recall, F1, support, then accuracy, macro and
    weighted averages (rows keyed by a string ``class``).  One aggregate over
    the data gives tp, support and predicted counts of every class; all the
    rest is arithmetic on that single row."""
    lab, prd = F.col(label), F.col(pred)
    aggs = []
    for i, c in enumerate(classes):
        aggs += [_number((lab == F.lit(c)) & (prd == F.lit(c)), weight).alias(f"tp{i}"),
                 _number(lab == F.lit(c), weight).alias(f"sup{i}"),
                 _number(prd == F.lit(c), weight).alias(f"np{i}")]
    one = df.agg(*aggs)
    z = F.lit(0.0)
    prec, rec, f1 = [], [], []
    for i in range(len(classes)):
        tp, sup, npred = (F.col(f"{k}{i}").cast("double") for k in ("tp", "sup", "np"))
        prec.append(F.coalesce(safe_div(tp, npred), z))
        rec.append(F.coalesce(safe_div(tp, sup), z))
        f1.append(F.coalesce(safe_div(2 * tp, npred + sup), z))
    k = float(len(classes))
    n = sum((F.col(f"sup{i}") for i in range(len(classes))), F.lit(0)).cast("long")
    correct = sum((F.col(f"tp{i}") for i in range(len(classes))), F.lit(0)).cast("double")

    def weighted(vals):
        return safe_div(sum((v * F.col(f"sup{i}") for i, v in enumerate(vals)), F.lit(0.0)), n)

    acc = safe_div(correct, n)
    rows = [F.struct(F.lit(str(c)).alias("class"), prec[i].alias("precision"), rec[i].alias("recall"),
                     f1[i].alias("f1"), F.col(f"sup{i}").cast("long").alias("support"))
            for i, c in enumerate(classes)]
    rows += [F.struct(F.lit("accuracy").alias("class"), acc.alias("precision"), acc.alias("recall"),
                      acc.alias("f1"), n.alias("support")),
             F.struct(F.lit("macro avg").alias("class"), (sum(prec, z) / k).alias("precision"),
                      (sum(rec, z) / k).alias("recall"), (sum(f1, z) / k).alias("f1"), n.alias("support")),
             F.struct(F.lit("weighted avg").alias("class"), weighted(prec).alias("precision"),
                      weighted(rec).alias("recall"), weighted(f1).alias("f1"), n.alias("support"))]
    return one.select(F.inline(F.array(*rows)))


def full_report(df: DataFrame, label: str, score: str, e: float | None = None,
                classes=(0.0, 1.0), positive=1.0, negative=0.0) -> dict[str, DataFrame]:
    """Everything the reference prints for one (table, score, threshold):
    confusion matrix, binary metrics and the per-class report.  The rows are
    read once, into the counts of each (label, prediction); all three parts
    come from these.  A label subset is a filter on ``df`` before the call."""
    pred = threshold(score, e) if e is not None else F.col(score)
    p = materialize(df.select(F.col(label), pred.alias("_pred")).groupBy(label, "_pred").agg(F.count(F.lit(1)).alias("_n")))
    return {"confusion": confusion(p, label, "_pred", list(classes), "_n"),
            "metrics": binary_report(p, label, "_pred", positive, negative, "_n"),
            "classes": class_report(p, label, "_pred", list(classes), "_n")}


def long_report(df: DataFrame, label: str, score: str, e: float | None = None, classes=(0.0, 1.0)) -> DataFrame:
    """E10 as one table (section, name, value)."""
    r = full_report(df, label, score, e, classes)
    named = lambda section, name, value: [F.lit(section).alias("section"), name.alias("name"),
                                          value.cast("double").alias("value")]
    parts = [r["confusion"].select(*named("confusion", F.concat_ws("|", F.col("label").cast("string"),
                                                                   F.col("prediction").cast("string")), F.col("count")))]
    for section, table, key in (("metrics", r["metrics"], F.lit("")), ("classes", r["classes"], F.col("class"))):
        cols = [c for c in table.columns if c != "class"]
        parts.append(table.select(F.inline(F.array(*[F.struct(*named(
            section, F.concat(key, F.lit("|" if section == "classes" else ""), F.lit(c)), F.col(c))) for c in cols]))))
    return reduce(DataFrame.unionAll, parts)
