"""Quality classifier: definition, edge cases and held-out accuracy."""

import math

import numpy as np
import pytest

from sparkwright.llm import quality
from tests.conftest import SF_ORACLE
from tests.llm.helpers import clash, docs, prose


def slow_log_density(x, mean, cov, prior):
    d = x - mean
    return math.log(prior) - 0.5 * (np.linalg.slogdet(cov)[1] + d @ np.linalg.inv(cov) @ d)


def test_score_is_the_regularised_discriminant():
    rng = np.random.default_rng(0)
    x = {c: rng.standard_normal((60 + 40 * c, 3)) * (1 + c) + c for c in (0, 1)}
    model = quality.discriminant({c: len(v) for c, v in x.items()}, {c: v.sum(0) for c, v in x.items()},
                                 {c: v.T @ v for c, v in x.items()}, pool=0.2, ridge=0.1)
    cov = {c: np.cov(v.T, bias=True) for c, v in x.items()}
    pooled = (60 * cov[0] + 100 * cov[1]) / 160
    reg = {c: 0.8 * cov[c] + 0.2 * pooled + 0.1 * np.trace(pooled) / 3 * np.eye(3) for c in cov}
    at = rng.standard_normal((20, 3))
    for row, s in zip(at, model.score(at)):
        a = [slow_log_density(row, x[c].mean(0), reg[c], (len(x[c]) + 1) / 162) for c in (0, 1)]
        assert s == pytest.approx(1 / (1 + math.exp(a[0] - a[1])))


def test_held_out_accuracy(spark):
    rows = quality.op2(spark, SF_ORACLE).collect()
    label = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{SF_ORACLE}/labels.parquet").collect()}
    pairs = [(r["predicted"], label[r["doc_id"]]) for r in rows if r["held_out"] and r["doc_id"] in label]
    assert len(pairs) > 50 and sum(a == b for a, b in pairs) >= 0.97 * len(pairs)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3) for r in rows)


def labelled(spark):
    good = [prose(n, n) + "." for n in range(40, 100)]
    bad = ["!! ".join(prose(n, n).upper().split()) for n in range(40, 100)]
    d = docs(spark, good + bad)
    return d, spark.createDataFrame([(i, int(i < 60), None) for i in range(120)] + [(None, 1, 1), (3, 7, 0), (5, None, 1)],
                                    "doc_id bigint, quality int, toxic int")


def test_cases(spark):
    d, labels = labelled(spark)
    model = quality.fit(d, labels)
    texts = [None, "", " ", prose(60, 7) + ".", "!! ".join(prose(60, 8).upper().split()), prose(30_000, 1), (2, "x"), (None, "x")]
    df = clash(docs(spark, texts))
    got = {r["doc_id"]: r["score"] for r in quality.score(df, model).collect()}
    assert quality.score(df, model).count() == len(texts)
    assert got[3] > 0.5 > got[4] and all(0 <= s <= 1 for s in got.values())
    kept = quality.keep_good(df, model)
    assert kept.dtypes == df.dtypes
    want = sorted((str(r["doc_id"]) for r in quality.score(df, model).where(f"score >= {quality.CUT}").collect()))
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == want
    assert quality.score(docs(spark, []), model).count() == 0


def test_without_labels_or_with_one_class(spark):
    d, labels = labelled(spark)
    flat = quality.fit(d, labels.where("false"))
    assert {r["score"] for r in quality.score(d, flat).collect()} == {0.5}
    one = quality.fit(d, labels.where("quality = 1"))
    assert min(r["score"] for r in quality.score(d, one).collect()) > 0.5


def test_sample_bound(spark):
    d, labels = labelled(spark)
    assert quality.fit(d, labels, max_rows=30).low.mean.shape == (len(quality.FEATURES),)
