"""Independent fits side by side, within the driver's memory."""

import threading
import time

from pyspark.sql import functions as F

from sparkwright.operators import models as M


def _run(spark, costs, budget):
    """Peak of running fits and of their bytes, and the results."""
    lock, here, peak = threading.Lock(), [], []

    def fit(k):
        with lock:
            here.append(k)
            peak.append((len(here), sum(costs[x] for x in here)))
        time.sleep(0.15)
        pool = spark.sparkContext.getLocalProperty("spark.scheduler.pool")
        group = spark.sparkContext.getLocalProperty("spark.jobGroup.id")
        n = spark.range(100).where(F.col("id") % (k + 2) == 0).count()
        with lock:
            here.remove(k)
        return k, n, pool, group
    spark.sparkContext.setJobGroup("fits", "caller")
    out = M._side_by_side(spark, fit, list(enumerate(costs)), budget)
    return max(p[0] for p in peak), peak, out


def test_fits_share_the_budget(spark):
    together, peak, out = _run(spark, [4, 4, 4, 4, 4, 4], 12)
    assert together == 3 and max(b for _, b in peak) <= 12
    # Results in order, each from its own pool with the caller's properties.
    assert [r[0] for r in out] == list(range(6)) and [r[1] for r in out] == [-(-100 // (k + 2)) for k in range(6)]
    assert [r[2] for r in out] == [f"fit-{k}" for k in range(6)] and {r[3] for r in out} == {"fits"}


def test_large_fits_run_alone(spark):
    together, peak, _ = _run(spark, [50, 3, 50, 3], 10)
    assert all(n == 1 for n, b in peak if b > 10) and together <= 2
    assert M._side_by_side(spark, lambda a: a, []) == []


def test_forest_bytes_grow_with_rows_up_to_the_depth():
    assert M.forest_bytes(1000, num_trees=10, max_depth=20) == 10 * 2000 * M.NODE_BYTES
    assert M.forest_bytes(10**9, num_trees=1, max_depth=5) == 64 * M.NODE_BYTES


def test_scores_do_not_depend_on_the_order_of_fits(spark, monkeypatch):
    rows = spark.range(400).select("id", (F.col("id") % 17).cast("double").alias("a"), (F.col("id") % 5).cast("double").alias("b"),
                                   F.when(F.col("id") % 17 > 9, F.when(F.col("id") % 2 == 0, "A").otherwise("B"))
                                   .otherwise("normal").alias("c"))
    args = (rows, rows, "c", {"A": ["A"], "B": ["B"]}, {"A": ["a"], "B": ["a", "b"]})
    sizes = {"num_trees": 4, "max_depth": 3, "seed": 1}
    side = sorted(map(tuple, M.category_detectors(*args, **sizes).select("id", "p_A", "p_B").collect()))
    monkeypatch.setattr(M, "FITS_AT_ONCE", 1)
    assert side == sorted(map(tuple, M.category_detectors(*args, **sizes).select("id", "p_A", "p_B").collect()))


def test_a_pilot_makes_room_for_forests_that_need_less_than_their_bound(spark, monkeypatch):
    """Forests whose bound exceeds the budget ran one at a time, however few
    nodes their trees had; results stay the same."""
    import threading
    from contextlib import contextmanager
    rows = spark.range(600).select((F.col("id") % 3).cast("int").alias("c"), (F.col("id") % 17).cast("double").alias("a"),
                                   (F.col("id") % 17 > 9).cast("double").alias("y"))
    rows = M.assemble(rows, ["a"]).cache()
    own = [{"route": "model", "cluster": c, "count": 200} for c in range(3)]
    sizes = {"num_trees": 16, "max_depth": 20, "seed": 1}
    budget = 1.9 * M.forest_bytes(200, **sizes)
    peak, here, lock = [], [], threading.Lock()

    class Seen(M.Admission):
        @contextmanager
        def room(self, cost):
            with super().room(cost):
                with lock:
                    here.append(cost)
                    peak.append(list(here))
                yield
                with lock:
                    here.remove(cost)
    monkeypatch.setattr(M, "Admission", lambda _: Seen(budget))
    monkeypatch.setattr(M, "_side_by_side", lambda s, f, j, b=None, pilot=None, _old=M._side_by_side:
                        _old(s, f, j, b or budget, pilot))
    found = M.fit_cluster_forests(rows, own, "c", "features", "y", **sizes)
    # Three trees of two or three nodes each need far less than 400 nodes a tree.
    assert max(map(len, peak)) == 3 and all(sum(p) <= budget for p in peak)
    alone = M.random_forest(features="features", label="y", **sizes).fit(rows.where("c = 1"))
    assert found[1].toDebugString.split("\n", 1)[1] == alone.toDebugString.split("\n", 1)[1]


def test_a_fit_of_many_rows_has_more_partitions(spark, monkeypatch):
    """A forest's rows stayed in the input's partitions, however large."""
    rows = M.assemble(spark.range(0, 900, 1, 2).selectExpr("cast(id as double) as a", "cast(id % 2 as double) as y"), ["a"])
    assert M.spread(rows, 900, num_trees=20) is rows
    monkeypatch.setattr(M, "FIT_BYTES", 900 * (12 * 20 + M.ROW_BYTES) // 5)
    out = M.spread(rows, 900, num_trees=20)
    assert out.rdd.getNumPartitions() == 5 and out.count() == 900
    own = [{"route": "model", "cluster": 1, "count": 900}]
    seen = []
    monkeypatch.setattr(M, "spread", lambda r, n, _f=M.spread, **a: seen.append(_f(r, n, **a)) or seen[-1])
    M.fit_cluster_forests(rows.selectExpr("*", "1 as c"), own, "c", "features", "y", num_trees=20, max_depth=2)
    assert seen[0].rdd.getNumPartitions() == 5


def test_a_forest_of_many_rows_is_fitted_in_batches_of_trees(spark, monkeypatch):
    """Its partitions grew with rows times trees; every pass sends each node's sums from all of them."""
    assert M.tree_batches(576_000, 500, 12) == [500] and M.tree_batches(10**12, 20, 12) == [20]
    assert M.tree_batches(5_760_000, 500, 12) == [72, 72, 72, 71, 71, 71, 71]
    # A rule with a wrong label in ten, so that trees differ.
    rows = M.assemble(spark.range(0, 900, 1, 2).selectExpr(
        "id", "cast(id % 30 as double) as a", "cast(id % 7 as double) as b", "cast(id % 30 > 11 as double) as rule",
        "cast((id % 30 > 11) <> (crc32(cast(id as string)) % 10 = 0) as double) as y"), ["a", "b"])
    monkeypatch.setattr(M, "LEAST_TREES", 4)
    monkeypatch.setattr(M, "FIT_BYTES", 900 * (12 * 6 + M.ROW_BYTES) / (2 * spark.sparkContext.defaultParallelism))
    parts = []
    monkeypatch.setattr(M, "spread", lambda r, n, _f=M.spread, **a: parts.append(_f(r, n, **a)) or parts[-1])
    model = M.fit_forest(rows, 900, num_trees=20, max_depth=4, label="y")
    assert len(parts) == 4 and all(p.rdd.getNumPartitions() <= 2 * spark.sparkContext.defaultParallelism for p in parts)
    assert model.getNumTrees == len(model.trees) == 20 and len({t.toDebugString.split("\n", 1)[1] for t in model.trees}) > 5
    scored = model.transform(rows).withColumn("p", M.p_positive()).select("id", "p", "rule", "prediction").collect()
    assert len(scored) == 900 and sum(r["prediction"] == r["rule"] for r in scored) > 850
    # The mean of the batches' probabilities, by their trees.
    single = [M.random_forest(num_trees=5, max_depth=4, seed=42 + i, label="y").fit(p) for i, p in enumerate(parts)]
    each = [{r["id"]: r["p"] for r in m.transform(rows).withColumn("p", M.p_positive()).collect()} for m in single]
    assert all(abs(r["p"] - sum(e[r["id"]] for e in each) / 4) < 1e-9 for r in scored)


def test_forests_score_in_a_session_with_an_observation(spark):
    """Their models carried the session, which can't be sent to tasks once it has observed a table."""
    from pyspark.sql import Observation
    seen = Observation()
    assert spark.range(5).observe(seen, F.count(F.lit(1)).alias("n")).count() == 5 and seen.get["n"] == 5
    rows = M.assemble(spark.range(60).selectExpr("cast(id as double) as a", "cast(id > 30 as double) as label"), ["a"])
    for model in (M.random_forest(num_trees=3).fit(rows), M.stack_forest(rows.drop("features"), ["a"], "label", num_trees=3),
                  M.stack_logistic(rows.drop("features"), ["a"], "label")):
        assert model.transform(rows.drop("features") if hasattr(model, "stages") else rows).count() == 60
        assert model.transform(rows.drop("features") if hasattr(model, "stages") else rows).where("prediction = label").count() > 50
