"""Every ML query is run here, with small forests; those with a SQL twin are
also compared in ``test_entry_oracle``."""

import inspect

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from sparkwright.operators import models as M
from sparkwright.plans import ORACLES, QUERIES
from sparkwright.plans import q_ml as Q
from tests.conftest import SF_SMOKE

SMALL = {"num_trees": 8, "max_depth": 4, "seed": 1}
UNCHECKED = sorted(n for n in QUERIES if n not in ORACLES)


def run(spark, name):
    f = QUERIES[name]
    sizes = {k: SMALL for k in ("forest", "flags_forest") if k in inspect.signature(f).parameters}
    return f(spark, SF_SMOKE, **sizes)


@pytest.mark.parametrize("name", UNCHECKED)
def test_query_runs(spark, name):
    df = run(spark, name)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert [n for n in ("CartesianProduct", "BroadcastNestedLoopJoin", "EvalPython") if n in plan] == []
    got = df.collect()
    assert got
    for r in got:
        for c in r.asDict():
            if c in ("p", "p_A", "p_B", "p_C", "p_max", "precision", "recall", "accuracy"):
                assert 0.0 <= r[c] <= 1.0


def test_registered_sizes_are_the_reference_sizes():
    assert (Q.FOREST["num_trees"], Q.FOREST["max_depth"]) == (500, 20)
    assert (Q.FLAGS_FOREST["num_trees"], Q.FLAGS_FOREST["max_depth"]) == (250, 5)
    for name, f in QUERIES.items():
        p = inspect.signature(f).parameters
        if "forest" in p and name != "ml_random_forest":
            assert p["forest"].default == Q.FOREST


def test_ratios_come_from_unscaled_base_rows(spark):
    p = Q.prepared(spark, SF_SMOKE)
    assert p.base_raw.select("part").distinct().collect() == [("base",)]
    assert abs(p.base_raw.agg(F.avg("total")).first()[0]) > 1000
    assert abs(p.part("base").agg(F.avg("total")).first()[0]) < 1e-6
    assert Q._selected(p.ratios, 1.5) != Q.ALL_FEATURES


def test_parts_are_disjoint_and_whole(spark):
    s = Q.base_scores(spark, SF_SMOKE, SMALL)
    ids = {n: {r.id for r in s.where(F.col("part") == n).select("id").collect()} for n in Q.PARTS}
    assert sum(map(len, ids.values())) == len(set().union(*ids.values())) == Q.split_rows(spark, SF_SMOKE).count()
    cv, test = Q._stack_parts(spark, SF_SMOKE, SMALL)
    assert {r.id for r in cv.select("id").collect()} == ids["cv"]
    assert {r.id for r in test.select("id").collect()} == ids["test"]


def test_flags_go_by_model_and_part(spark):
    """Thresholds of the part, and the two ORs: of the detectors (an input of
    the feature stacker) and of all five models (a report)."""
    p = [0.0, 0.005, 0.01, 0.03, 0.05, 0.4, 0.5, 0.9]
    data = [(part, *(p[(i * k + k) % 8] for k in range(1, 6))) for i in range(8) for part in ("base", "cv", "test")]
    rows = spark.createDataFrame(data, "part string, p_km double, p_gm double, p_A double, p_B double, p_C double")
    for r in Q.flagged(rows).collect():
        test = r["part"] == "test"
        want = {"f_km": r["p_km"] >= (0.01 if test else 0.5), "f_gm": r["p_gm"] >= (0.01 if test else 0.5)}
        want |= {f"f_{g}": r[f"p_{g}"] >= (0.01 if test else 0.05) for g in "ABC"}
        assert {c: bool(r[c]) for c in want} == want
        assert bool(r["f_sup"]) == any(want[f"f_{g}"] for g in "ABC")
        assert bool(r["f_any"]) == any(want.values())
        assert abs(r["p_sup"] - (r["p_A"] + r["p_B"] + r["p_C"]) / 3) < 1e-12
    assert Q.FLAGS[-1] == "f_sup" and "f_any" not in Q.FLAGS and len(Q.MODEL_FLAGS) == 5


def test_kept_tables_follow_the_input(spark, tmp_path):
    """A table replaced at the same path is read anew."""
    import shutil
    for name in ("orders", "customer", "lineitem"):
        shutil.copy(f"{SF_SMOKE}/{name}.parquet", tmp_path / f"{name}.parquet")
    before = Q.prepared(spark, str(tmp_path)).scaled.count()
    assert Q.prepared(spark, str(tmp_path)) is Q.prepared(spark, str(tmp_path))
    few = pq.read_table(f"{SF_SMOKE}/orders.parquet").slice(0, 500)
    pq.write_table(few, tmp_path / "orders.parquet")
    assert before > 500 and Q.prepared(spark, str(tmp_path)).scaled.count() == 500


def test_pca_vector_has_the_signed_components(spark):
    rows = spark.range(50).selectExpr("id", "-1.0 * id as a", "cast(id % 7 as double) as b")
    v = M.assemble(rows, ["a", "b"], "vec")
    out = M.pca(v, v, "vec", 2).collect()
    assert all(list(r.pca_features) == [r.pc1, r.pc2] for r in out)


def test_mixture_covariances_are_symmetric(spark):
    model, _ = Q._gmm(spark, SF_SMOKE)
    cov = {(r.component, r.i, r.j): r["cov"] for r in M.gmm_covariances(model).collect()}
    diagonal = {(r.component, r.dim): r.variance for r in M.gmm_params(model).collect()}
    assert all(v == pytest.approx(cov[k, j, i]) for (k, i, j), v in cov.items())
    assert all(cov[k, d, d] == v for (k, d), v in diagonal.items())


def test_mixture_sums_blocks_and_agrees_with_the_estimator(spark, monkeypatch):
    """The estimator went through all rows in every iteration, one object a
    row; it draws the start only, and the result is the same."""
    from pyspark.ml.clustering import GaussianMixture
    rows = spark.range(0, 3000, 1, 3).select("id", F.randn(1).alias("a"), (F.randn(2) + F.col("id") % 3 * 4).alias("b"))
    v = M.assemble(rows, ["a", "b"], "v")
    want = GaussianMixture(k=3, seed=5, maxIter=25, featuresCol="v").fit(v)
    seen, fit = [], GaussianMixture.fit
    monkeypatch.setattr(GaussianMixture, "fit", lambda self, *a: seen.append(self.getMaxIter()) or fit(self, *a))
    got, scored = M.gmm(v, v, "v", 3, 5, 25)
    assert seen == [0] and list(got.weights) == pytest.approx(list(want.weights), abs=1e-9)
    for x, y in zip(got.gaussiansDF.collect(), want.gaussiansDF.collect()):
        assert list(x["mean"]) == pytest.approx(list(y["mean"]), abs=1e-8)
        assert x["cov"].toArray().ravel() == pytest.approx(y["cov"].toArray().ravel(), abs=1e-8)
    same = scored.select("id", "cluster").join(want.transform(v).select("id", F.col("prediction").alias("p")), "id")
    assert scored.columns == [*v.columns, "probability", "cluster"] and same.where("cluster = p").count() == 3000


def test_mixture_of_rows_on_a_line(spark):
    """A singular covariance has a pseudo-inverse, in Spark's model too."""
    from pyspark.ml.clustering import GaussianMixture
    v = M.assemble(spark.range(200).selectExpr("id", "double(id % 17) as a", "2.0 * (id % 17) as b"), ["a", "b"], "v")
    want, got = GaussianMixture(k=2, seed=1, maxIter=5, featuresCol="v").fit(v), M.gmm(v, v, "v", 2, 1, 5)[0]
    assert list(got.weights) == pytest.approx(list(want.weights), abs=1e-6)
