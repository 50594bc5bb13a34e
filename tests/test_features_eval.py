import pytest
from pyspark.sql import functions as F

from sparkwright.operators import evaluate as E
from sparkwright.operators import features as H
from sparkwright.operators import splits as S
from sparkwright.operators import votes as V
from tests.conftest import rows


def test_one_hot_unseen_category_is_all_zero(spark):
    train = spark.createDataFrame([(1, "a"), (2, "b")], "id int, c string")
    test = spark.createDataFrame([(3, "z"), (4, "a"), (5, None)], "id int, c string")
    cats = H.fit_categories(train, ["c"])
    out, names = H.one_hot(test, cats)
    assert names == ["c_a", "c_b"]
    assert rows(out) == [(3, 0.0, 0.0), (4, 1.0, 0.0), (5, 0.0, 0.0)]


def test_standardize_zero_variance_and_mean(spark):
    df = spark.createDataFrame([(1.0, 5.0), (3.0, 5.0)], "x double, c double")
    st = H.fit_standardizer(df, ["x", "c"])
    out = rows(H.standardize(df, st, ["x", "c"]))
    assert out[0][0] == pytest.approx(-0.7071067811865475) and out[0][1] == 0.0
    no_mean = rows(H.standardize(df, st, ["x"], with_mean=False), "x")
    assert no_mean[1][0] == pytest.approx(3.0 / 1.4142135623730951)


def test_frequency_index_ties_alphabetical(spark):
    df = spark.createDataFrame([("b",), ("a",), ("c",), ("c",)], "s string")
    idx = {r.s: r["index"] for r in H.frequency_index(df, "s").collect()}
    assert idx == {"c": 0.0, "a": 1.0, "b": 2.0}


def test_label_stages(spark):
    df = spark.createDataFrame([("normal",), ("smurf",), (None,)], "labels string")
    out = H.BinaryLabel(inputCol="labels", outputCol="labels2").transform(df)
    assert rows(out, "labels2") == [("attack",), ("normal",), (None,)]
    g = H.GroupLabel(inputCol="labels", outputCol="labels5", mapping={"normal": "normal", "smurf": "DoS"},
                     unknown="null").transform(df)
    assert rows(g, "labels5") == [("DoS",), ("normal",), (None,)]


def test_splits_partition_invariant_and_complete(spark):
    df = spark.range(0, 3000).withColumnRenamed("id", "k")
    a1 = rows(S.assign_split(df.repartition(1), "k", 0.2), "k", "is_test")
    a8 = rows(S.assign_split(df.repartition(8), "k", 0.2), "k", "is_test")
    assert a1 == a8
    tr, te = S.random_split(df.repartition(5), "k", [0.8, 0.2])
    assert tr.count() + te.count() == 3000 and tr.join(te, "k").count() == 0
    assert 450 < te.count() < 750


def test_stratified_exact_counts(spark):
    df = spark.createDataFrame([(i, "a" if i < 1000 else "b") for i in range(1100)], "k int, y string")
    out = S.stratified_split(df, "k", "y", 0.33)
    got = {r.y: r.n for r in out.groupBy("y").agg(F.sum("is_test").alias("n")).collect()}
    assert got == {"a": 330, "b": 33}


def test_stable_id_copies(spark):
    df = spark.createDataFrame([(7, "x"), (2, "x"), (3, "y"), (4, None), (9, None)], "k int, t string")
    for parts in (1, 5):
        out = rows(H.stable_id(df.repartition(parts), ["t"], ["k"]), "k", "copy")
        assert out == [(2, 1), (3, 1), (4, 1), (7, 2), (9, 2)]


def test_one_hot_vector_of_many_categories(spark):
    df = spark.range(12_000).selectExpr("id", "concat('c', id) as c")
    idx = H.frequency_index(df.unionByName(df.limit(0)), "c")
    probe = spark.createDataFrame([("c3",), ("new",), (None,)], "c string")
    out = {r.c: r.v for r in H.one_hot_vector(probe, idx, "c", "v").collect()}
    assert out["c3"].size == 12_000 and 0 <= out["c3"].slot < 12_000
    assert out["new"].slot is None and out[None].slot is None


def test_threshold_null_and_equal(spark):
    df = spark.createDataFrame([(0.5,), (0.49,), (None,)], "p double")
    assert rows(df.select(V.threshold("p", 0.5).alias("f"))) == [(0.0,), (1.0,), (None,)]


def test_binary_report_values_and_zero_denominators(spark):
    df = spark.createDataFrame([(1.0, 1.0), (1.0, 0.0), (0.0, 0.0), (0.0, 1.0), (0.0, 0.0)], "y double, p double")
    r = E.binary_report(df, "y", "p").first()
    assert (r.tn, r.fp, r.fn, r.tp) == (2, 1, 1, 1)
    assert r.precision == 0.5 and r.recall == 0.5 and r.false_alarm_rate == pytest.approx(1 / 3)
    assert r.mcc == pytest.approx((1 * 2 - 1 * 1) / (2 * 2 * 3 * 3) ** 0.5)
    one = spark.createDataFrame([(0.0, 0.0)], "y double, p double")
    r1 = E.binary_report(one, "y", "p").first()
    assert r1.precision == 0.0 and r1.mcc == 0.0 and r1.detection_rate is None
    cm = rows(E.confusion(one, "y", "p", [0.0, 1.0]))
    assert cm == [(0.0, 0.0, 1), (0.0, 1.0, 0), (1.0, 0.0, 0), (1.0, 1.0, 0)]


def test_auc_rank_sum_with_ties(spark):
    df = spark.createDataFrame([(1.0, 0.9), (0.0, 0.9), (1.0, 0.7), (0.0, 0.1)], "y double, s double")
    # positives: 0.9 beats 0.1 and ties 0.9 (0.5) -> 1.5; 0.7 beats 0.1 -> 1 ; total 2.5 / 4
    assert E.auc(df, "y", "s").first().auc == pytest.approx(0.625)


def test_threshold_sweep_one_pass(spark):
    df = spark.createDataFrame([(1.0, 0.9), (0.0, 0.2)], "y double, s double")
    out = {r.threshold: (r.tp, r.fp) for r in E.threshold_sweep(df, "y", "s", [0.5, 0.1]).collect()}
    assert out == {0.5: (1, 0), 0.1: (1, 1)}


def test_class_report_macro_weighted(spark):
    df = spark.createDataFrame([("a", "a"), ("a", "b"), ("b", "b")], "y string, p string")
    r = {x["class"]: x for x in E.class_report(df, "y", "p", ["a", "b"]).collect()}
    assert r["a"].precision == 1.0 and r["a"].recall == 0.5
    assert r["accuracy"].precision == pytest.approx(2 / 3)
    assert r["macro avg"].f1 == pytest.approx((2 / 3 + 2 / 3) / 2)


def test_votes(spark):
    df = spark.createDataFrame([(0.2, 0.4, 1.0)], "a double, b double, c double")
    r = df.select(V.mean_of(["a", "b", "c"]).alias("m"), V.weighted_vote({"a": 2, "b": 1, "c": 1}).alias("w")).first()
    assert r.m == pytest.approx(1.6 / 3) and r.w == pytest.approx(1.8 / 4)
    f = spark.createDataFrame([(0.0, 1.0), (0.0, 0.0)], "x double, y double")
    assert rows(f.select(V.any_flag(["x", "y"]).alias("o"))) == [(0.0,), (1.0,)]


def test_full_report_bundle(spark):
    df = spark.createDataFrame([(1.0, 0.9), (0.0, 0.6), (0.0, 0.1)], "y double, s double")
    rep = E.full_report(df, "y", "s", 0.5)
    assert rep["metrics"].first().fp == 1
    assert len(rep["confusion"].collect()) == 4
    assert {r["class"] for r in rep["classes"].collect()} >= {"0.0", "1.0", "accuracy"}


def test_label_stages_persist_in_a_pipeline(spark, tmp_path):
    from pyspark.ml import Pipeline, PipelineModel
    df = spark.createDataFrame([("normal",), ("smurf",)], "labels string")
    pipe = Pipeline(stages=[H.BinaryLabel(inputCol="labels", outputCol="labels2"),
                            H.GroupLabel(inputCol="labels", outputCol="labels5",
                                         mapping={"normal": "normal", "smurf": "DoS"})])
    model = pipe.fit(df)
    path = str(tmp_path / "labels_pipeline")
    model.write().overwrite().save(path)
    again = PipelineModel.load(path)
    assert rows(again.transform(df), "labels2", "labels5") == [("attack", "DoS"), ("normal", "normal")]
