"""Forests of many rows and trees, grown on blocks of rows."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from sparkwright.operators import block_forest as B
from sparkwright.operators import models as M


def _gini(c):
    return 1.0 - ((c / c.sum()) ** 2).sum()


def _tree(x, y, edges, depth):
    """(classes, None) of a leaf or (classes, (feature, threshold, left, right)), one node at a time."""
    own, best = np.bincount(y, minlength=2).astype(float), (0.0, None, None)
    if depth and own.min() > 0:
        for f, cuts in enumerate(edges):
            for t in cuts:
                go = x[:, f] <= t
                if 0 < go.sum() < len(y):
                    l, r = np.bincount(y[go], minlength=2), np.bincount(y[~go], minlength=2)
                    gain = _gini(own) - l.sum() / len(y) * _gini(l) - r.sum() / len(y) * _gini(r)
                    if gain > best[0] + 1e-12:
                        best = (gain, f, t)
    if best[1] is None:
        return own, None
    go = x[:, best[1]] <= best[2]
    left, right = (_tree(x[m], y[m], edges, depth - 1) for m in (go, ~go))
    if left[1] is None and right[1] is None and left[0].argmax() == right[0].argmax():
        return own, None
    return own, (best[1], best[2], left, right)


def _p(node, x):
    while node[1] is not None:
        f, t, left, right = node[1]
        node = left if x[f] <= t else right
    return node[0][1] / node[0].sum()


def test_a_block_forest_splits_where_a_search_of_every_split_does(spark, monkeypatch):
    """With every row once and all features at each node, its trees are the tree found node by node."""
    rows = spark.range(0, 600, 1, 3).select("id", F.rand(1).alias("a"), F.rand(2).alias("b"), F.rand(3).alias("noise"))
    rows = rows.selectExpr("id", "a", "b", "double(a + 0.5 * b + 0.4 * noise > 0.9) as label").cache()
    data = rows.orderBy("id").toPandas()
    x, y = data[["a", "b"]].to_numpy(), data["label"].to_numpy().astype(int)

    def whole(chunks, height, seed):
        def task(part, blocks):
            for record in blocks:
                block = np.frombuffer(record["block"], np.uint8).reshape(height, -1)
                n = block.shape[1]
                for c, trees in enumerate(chunks):
                    yield None, (c, block, [(np.arange(n, dtype=np.uint32), np.zeros(n, np.uint32), np.ones(n, np.uint8))] * len(trees))
        return task
    monkeypatch.setattr(B, "_roots", whole)
    monkeypatch.setattr(B, "PART_CELLS", 600)
    model = B.fit_block_forest(M.assemble(rows, ["a", "b"]), 600, num_trees=3, max_depth=4)
    root = _tree(x, y, [B.bin_edges(x[:, i]) for i in range(2)], 4)
    got = model.transform(M.assemble(rows, ["a", "b"])).withColumn("p", M.p_positive()).orderBy("id").select("p").toPandas()["p"]
    assert len(model.trees) == 3 and model.trees[0].depth == 4
    assert np.abs(got.to_numpy() - [_p(root, v) for v in x]).max() < 1e-9


def test_bins_hold_about_as_many_rows_each():
    assert B.bin_edges(np.array([0.0, 1.0, 0.0])).tolist() == [0.5] and B.bin_edges(np.ones(9)).tolist() == []
    edges = B.bin_edges(np.arange(3200.0))
    assert len(edges) == 31 and np.ptp(np.diff(edges)) <= 1


def test_forests_of_many_rows_and_trees_grow_on_blocks(spark, monkeypatch):
    """Each pass looked up a node for every row and tree, those in finished leaves, too."""
    rows = spark.range(0, 900, 1, 2).selectExpr(
        "id", "cast(id % 30 as double) as a", "cast(id % 7 as double) as b", "cast(id % 30 > 11 as double) as rule",
        "cast((id % 30 > 11) <> (crc32(cast(id as string)) % 10 = 0) as double) as y").cache()
    seen = []
    monkeypatch.setattr(M, "BLOCK_CELLS", 900 * 40)
    monkeypatch.setattr(M, "fit_block_forest", lambda *a, _f=M.fit_block_forest, **k: seen.append(k["num_trees"]) or _f(*a, **k))
    monkeypatch.setattr(B, "PART_CELLS", 1000)
    vectors = M.assemble(rows, ["a", "b"])
    model = M.fit_forest(vectors, 900, num_trees=40, max_depth=4, label="y")
    assert seen == [40] and M.fit_forest(vectors, 900, num_trees=3, max_depth=2, label="y").getNumTrees == 3 and seen == [40]
    # In two batches, with draws of their own.
    assert model.getNumTrees == len(model.trees) == 40 and len({t._java_obj.rootNode().impurity() for t in model.trees}) > 30
    scored = model.transform(vectors).withColumn("p", M.p_positive()).select("p", "rule", "prediction").collect()
    assert len(scored) == 900 and all(0 <= r["p"] <= 1 for r in scored) and sum(r["prediction"] == r["rule"] for r in scored) > 850
    # The stacker's forest is the same step, behind indexed flags.
    flags = rows.selectExpr("y", "double(a > 11) as f", "double(b > 3) as g")
    stacked = M.stack_forest(flags, ["f", "g"], "y", num_trees=40, max_depth=3)
    assert seen == [40, 40] and stacked.transform(flags).where("prediction = f").count() == 900
    with pytest.raises(ValueError, match="labels"):
        M.fit_forest(vectors.withColumn("y", F.col("y") - 0.5), 900, num_trees=40, max_depth=4, label="y")


def test_trees_of_a_block_forest_stay_off_the_driver(spark, monkeypatch):
    """Its model was Spark's, whose trees the driver holds (about 300 bytes a node) and sends to the tasks as a whole."""
    from pyspark.ml.classification import RandomForestClassificationModel
    rows = spark.range(0, 700, 1, 2).selectExpr("id", "cast(id % 31 as double) as a", "cast(id % 8 as double) as b",
                                                "cast(id % 31 > 11 as int) + cast(crc32(cast(id as string)) % 3 = 0 as int) as label")
    vectors = M.assemble(rows, ["a", "b"]).cache()
    monkeypatch.setattr(B, "SLICE_BYTES", 3000)
    model = B.fit_block_forest(vectors, 700, num_trees=30, max_depth=6)
    assert not isinstance(model, RandomForestClassificationModel) and len(model.slices()) > 3 and model.totalNumNodes > 300
    columns = ["id", "a", "features", "rawPrediction", "probability", "prediction"]
    got = {}
    for held in (B.HELD_BYTES, 1):      # trees kept by a task, or read again for each lot of rows
        monkeypatch.setattr(B, "HELD_BYTES", held)
        monkeypatch.setattr(B, "MORE_ROWS", 50)
        got[held] = model.transform(vectors).select(columns).orderBy("id").collect()
    assert model._spark_model is None
    want = model.to_spark().transform(vectors).select(columns).orderBy("id").collect()
    for rows_of in got.values():
        assert len(rows_of) == 700
        for x, y in zip(rows_of, want):
            assert x[:3] == y[:3] and x["prediction"] == y["prediction"]
            for c in ("rawPrediction", "probability"):
                assert np.abs(x[c].toArray() - y[c].toArray()).max() < 1e-9


def test_few_forests_on_blocks_grow_at_once_and_none_has_a_pilot(spark, monkeypatch):
    """Up to eight grew side by side, after pilots that the estimator grew on the driver."""
    import threading
    import time
    here, peak, sizes, lock = [], [], [], threading.Lock()

    class Fitted:
        stages, totalNumNodes = [None], 1

    def fit(rows, count, num_trees=20, **_):
        with lock:
            here.append(count)
            sizes.append(num_trees)
            peak.append(len(here))
        time.sleep(0.2)
        with lock:
            here.remove(count)
        return Fitted()
    monkeypatch.setattr(M, "BLOCK_CELLS", 100)
    monkeypatch.setattr(M, "fit_forest", fit)
    rows = spark.range(10).selectExpr("cast(id % 5 as int) as c", "double(id) as y")
    own = [{"route": "model", "cluster": c, "count": 50_000_000} for c in range(5)]
    assert len(M.fit_cluster_forests(rows, own, "c", "features", "y", num_trees=500, max_depth=20)) == 5
    assert max(peak) == M.BLOCK_FITS and sizes == [500] * 5
