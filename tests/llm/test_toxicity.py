"""Ordinal toxicity: gradients, order of grades, edge cases, accuracy."""

import random

import numpy as np

from sparkwright.llm import toxicity
from tests.conftest import SF_ORACLE
from tests.llm.helpers import clash, docs, prose

BAD = ["vile", "scumbag", "hateful", "moronic", "nasty"]


def labelled(spark, n=400, seed=3):
    rng = random.Random(seed)
    texts, labels = [], []
    for i in range(n):
        words = prose(60, 1000 + i).split()
        toxic = int(i % 4 == 0)
        for b in rng.sample(BAD, rng.randint(1, 5)) if toxic else []:
            words.insert(rng.randrange(len(words)), b)
        texts.append(" ".join(words))
        labels.append((i, 1, toxic))
    extra = [(None, 1, 1), (3, 1, None), (5, 1, 7), (4, 1, 0)]
    return docs(spark, texts), spark.createDataFrame(labels + extra, "doc_id bigint, quality int, toxic int"), texts


def test_shared_weights_order_the_grades():
    rng = np.random.default_rng(0)
    rows = []
    for _ in range(600):
        x = sorted(rng.choice(6, rng.integers(0, 6), replace=False).tolist())
        rows.append((x, min(3, sum(f < 4 for f in x))))  # features 4 and 5 don't matter
    w, t = toxicity.ordinal_fit(rows, 6)
    assert t[0] < t[1] < t[2]
    assert w[:4].min() > 2 * abs(w[4:]).max()
    s = np.array([w[x].sum() for x, _ in rows])
    severity = (1 / (1 + np.exp(-(s[:, None] - t)))).sum(axis=1)
    grade = np.array([g for _, g in rows])
    assert np.corrcoef(severity, grade)[0, 1] > 0.97
    means = [severity[grade == g].mean() for g in range(4)]
    assert means == sorted(means)


def test_fit_and_cases(spark):
    d, labels, _ = labelled(spark)
    model = toxicity.fit(d, labels)
    assert set(b.encode() for b in BAD) <= set(model.weights)
    texts = [None, "", "!!", prose(50, 5), prose(50, 5) + " VILE, scumbag", "vile scumbag hateful moronic nasty",
             prose(20_000, 6) + " nasty hateful", (2, "x"), (None, "x")]
    df = clash(docs(spark, texts))
    got = toxicity.severity(df, model).collect()
    assert len(got) == len(texts)
    by = {r["doc_id"]: r for r in got}
    assert all(0 <= r["severity"] <= 3 and 0 <= r["toxic_score"] <= 1 for r in got)
    assert by[3]["toxic_score"] < 0.5 < by[4]["toxic_score"] and by[6]["toxic_score"] > 0.5 and by[0]["grade"] == 0
    assert by[5]["severity"] > by[4]["severity"] > by[3]["severity"] and by[5]["grade"] == 3
    assert toxicity.severity(docs(spark, []), model).count() == 0


def test_copies_are_no_evidence(spark):
    d, labels, texts = labelled(spark)
    # One toxic text many times: its plain words stay plain.
    copied = texts[0] + " qqqq wwww"
    many = docs(spark, texts + [copied] * 80)
    more = labels.unionAll(spark.createDataFrame([(400 + i, 1, 1) for i in range(80)], labels.schema))
    model = toxicity.fit(many, more)
    assert b"qqqq" not in model.weights and b"vile" in model.weights


def test_without_toxic_examples(spark):
    d, labels, _ = labelled(spark, 40)
    for some in (labels.where("toxic = 0"), labels.where("false")):
        model = toxicity.fit(d, some)
        assert max(r["toxic_score"] for r in toxicity.severity(d, model).collect()) < 0.01


def test_accuracy_on_the_table(spark):
    label = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{SF_ORACLE}/labels.parquet").collect()}
    rows = [r for r in toxicity.op8(spark, SF_ORACLE).collect() if r["doc_id"] in label]
    clean = [r["toxic"] for r in rows if not label[r["doc_id"]]]
    assert sum(clean) <= 0.01 * len(clean)
