"""Selection by digit histograms, cut points on whole tuples, wide correlation."""

import math
import random

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from sparkwright.operators import moments, ordering, selection
from sparkwright.operators import profile as P
from sparkwright.operators.clean import correlated_to_drop
from sparkwright.operators.splits import hash_key, stratified_split

EDGES = [0.0, -0.0, 1.0, -1.0, 0.1, 1e-300, -1e-300, 5e-324, -5e-324, 2.2250738585072014e-308, 2.225073858507201e-308,
         1.7976931348623157e308, -1.7976931348623157e308, math.inf, -math.inf, 2.0, 1.9999999999999998, 4.0, 0.5,
         0.49999999999999994, 3.141592653589793, 8.0, 7.999999999999999, 1024.0, 1e22, 123456789.125]


def test_order_bits_keep_the_order_and_the_value(spark):
    rng = random.Random(3)
    vals = EDGES + [rng.uniform(-1, 1) * 10.0 ** rng.randint(-320, 307) for _ in range(3000)]
    vals += [2.0 ** k for k in range(-1074, 1024, 7)]
    df = spark.createDataFrame([(v,) for v in vals], "v double")
    got = df.select("v", selection.order_bits(F.col("v")).alias("b")).withColumn("back", selection.from_order_bits(F.col("b")))
    rows = got.collect()
    assert all(r["v"] == r["back"] for r in rows)
    bits = [int(np.float64(abs(r["v"])).view(np.int64)) for r in rows]
    assert [r["b"] for r in rows] == [b if r["v"] > 0 else -b for r, b in zip(rows, bits)]
    nan = spark.createDataFrame([(math.nan,), (None,)], "v double").select(selection.order_bits(F.col("v")).alias("b"))
    assert sorted(r["b"] or 0 for r in nan.collect()) == [0, (2047 << 52) + 1]


def test_select_kth_every_position(spark):
    rng = random.Random(1)
    keys = [rng.choice([-(1 << 63), (1 << 63) - 1, 0, 1, -1, 65536, rng.getrandbits(62), -rng.getrandbits(50)])
            for _ in range(300)]
    data = [("a" if i % 3 else None, k) for i, k in enumerate(keys)]
    rows = spark.createDataFrame(data, "g string, key bigint")
    wanted = spark.createDataFrame([(g, k) for g in ("a", None, "absent") for k in (0, 1, 2, 50, 99, 100, 150, 200, 201)],
                                   "g string, k bigint")
    got = {(r["g"], r["k"]): (r["key"], r["rest"]) for r in selection.select_kth(rows, wanted, ["g"]).collect()}
    want = {}
    for g in ("a", None):
        mine = sorted(k for x, k in data if x == g)
        for k in (1, 2, 50, 99, 100, 150, 200):
            if k <= len(mine):
                want[g, k] = (mine[k - 1], k - mine.index(mine[k - 1]))
    assert got == want


def test_quantiles_hot_class_many_classes_and_ties(spark):
    """A class with a third of the rows, a hot value, 2,000 classes."""
    rng = random.Random(5)
    data = [("hot", 0.0 if i % 3 else rng.gauss(0, 1)) for i in range(4000)]
    data += [(f"c{i % 2000}", float(rng.randint(-5, 5))) for i in range(8000)] + [(None, 1.5), ("empty", None)]
    df = spark.createDataFrame(data, "g string, v double")
    probs = [0.0, 0.1, 0.25, 0.5, 0.75, 1.0]
    got = {(r["g"], r["prob"]): r["quantile"] for r in selection.quantiles(df, "v", probs, ["g"]).collect()}
    by = {}
    for g, v in data:
        if v is not None:
            by.setdefault(g, []).append(v)
    assert set(got) == {(g, p) for g in by for p in probs}
    for (g, p), q in got.items():
        assert q == pytest.approx(float(np.quantile(by[g], p)), abs=1e-12)


def test_quantiles_of_small_classes_need_no_counting_passes(spark, monkeypatch):
    """Every row of a small class went through four exchanges."""
    def never(*_, **__):
        raise AssertionError("counted by digits")
    monkeypatch.setattr(selection, "select_kth", never)
    data = [(i % 40 or None, float(i * 7 % 101)) for i in range(600)] + [(1, math.nan), (2, math.inf), (2, None), (99, None)]
    df = spark.createDataFrame(data, "g int, v double")
    got = {(r["g"], r["prob"]): r["quantile"] for r in selection.quantiles(df, "v", [0.0, 0.3, 0.5], ["g"]).collect()}
    want = {(g, p): float(np.quantile(sorted([v for x, v in data if x == g and v is not None], key=lambda v: (v != v, v)), p))
            for g in {g for g, _ in data} - {99, 1} for p in (0.0, 0.3, 0.5)}
    assert {k: v for k, v in got.items() if k[0] != 1} == pytest.approx(want) and len(got) == len(want) + 3


@pytest.mark.parametrize("most", [0, 20, 10**6])
def test_quantiles_gathered_and_counted_agree(spark, monkeypatch, most):
    """Classes on both sides of the limit, and null classes, by either way."""
    rng = random.Random(2)
    data = [(g, rng.choice([0.0, -1.5, rng.gauss(0, 1e6)])) for g, n in (("a", 300), ("b", 20), ("c", 21), (None, 1), ("d", 2))
            for _ in range(n)]
    df = spark.createDataFrame(data, "g string, v double")
    monkeypatch.setattr(selection, "GATHER", most)
    got = {(r["g"], r["prob"]): r["quantile"] for r in selection.quantiles(df, "v", [0.0, 0.4, 0.99], ["g"]).collect()}
    assert got == pytest.approx({(g, p): float(np.quantile([v for x, v in data if x == g], p))
                                 for g in ("a", "b", "c", None, "d") for p in (0.0, 0.4, 0.99)})


def test_quantiles_plan_no_sort_no_window(spark):
    df = spark.range(1000).selectExpr("id % 7 as g", "cast(id as double) as v")
    rows = df.select("g", selection.order_bits(F.col("v")).alias("key"))
    wanted = spark.createDataFrame([(0, 3)], "g bigint, k bigint")
    plan = selection.select_kth(rows, wanted, ["g"])._jdf.queryExecution().optimizedPlan().toString()
    assert "Window" not in plan and "Sort" not in plan


@pytest.mark.parametrize("kind", ["bigint", "string"])
def test_stratified_split_is_exact(spark, kind):
    """The classes' shares are exact, also among equal hashes, and the rows are
    those with the smallest (hash, key)."""
    data = [("hot" if i % 3 == 0 else f"c{i % 50}" if i % 7 else None, str(i)) for i in range(3000)]
    df = spark.createDataFrame(data, "y string, id string").withColumn("id", F.col("id").cast(kind))
    got = stratified_split(df, "id", "y", 0.33).withColumn("h", hash_key("id", 42)).collect()
    by = {}
    for r in got:
        by.setdefault(r["y"], []).append(r)
    assert sum(map(len, by.values())) == 3000 and set(got[0].asDict()) == {"y", "id", "is_test", "h"}
    for rows in by.values():
        rows.sort(key=lambda r: (r["h"], r["id"]))
        n = int(len(rows) * 0.33 + 0.5)
        assert [r["is_test"] for r in rows] == [1] * n + [0] * (len(rows) - n)


def test_stratified_split_ties_go_by_key(spark, monkeypatch):
    """With one hash for all rows the key alone decides."""
    from sparkwright.operators import splits
    monkeypatch.setattr(splits, "hash_key", lambda key, seed: F.lit("0000ffff"))
    df = spark.createDataFrame([("a", i) for i in range(100)] + [("b", 7)], "y string, id int")
    got = splits.stratified_split(df, "id", "y", 0.25).collect()
    assert sorted(r["id"] for r in got if r["is_test"]) == list(range(25))


def test_tied_order_values_spread_over_all_buckets(spark):
    """200,000 values seen equally often: the bucket goes by the whole tuple."""
    df = spark.range(200_000).selectExpr("-1L as less", "lpad(cast(id as string), 7, '0') as v")
    cuts = ordering._cut_points(df, ["less", "v"], [], 16)
    assert len(cuts) == 15
    n = [r["count"] for r in df.groupBy(ordering._bucket(["less", "v"], cuts, dict(df.dtypes)).alias("b")).count().collect()]
    assert len(n) == 16 and max(n) < 2.5 * 200_000 / 16


def test_bucket_counts_smaller_cuts(spark):
    cuts = [(None, 3), (1, None), (1, 5), (2, 0)]
    data = [(a, b) for a in (None, 0, 1, 2, 3) for b in (None, -1, 0, 3, 5, 9)]
    df = spark.createDataFrame(data, "a int, b int")
    got = df.withColumn("n", ordering._bucket(["a", "b"], cuts, dict(df.dtypes))).collect()
    low = lambda t: tuple((x is not None, x or 0) for x in t)
    assert all(r["n"] == sum(low(c) < low((r["a"], r["b"])) for c in cuts) for r in got)


def _wide(spark, n, d, seed, partitions=5):
    rng = np.random.default_rng(seed)
    base = rng.normal(size=(n, 3))
    x = base @ rng.normal(size=(3, d)) + rng.normal(size=(n, d)) + rng.choice([0, 1e3, 1e6], d)
    x[:, 0] = 0.1
    gone = rng.random((n, d)) < rng.choice([0, .1, .6], d)
    table = {f"x{k}": [None if g else float(v) for v, g in zip(x[:, k], gone[:, k])] for k in range(d)}
    import pandas as pd
    pdf = pd.DataFrame({c: pd.array(v, dtype="Float64") for c, v in table.items()})
    schema = ", ".join(f"{c} double" for c in table)
    rows = list(zip(*table.values()))
    return spark.createDataFrame(rows, schema).repartition(partitions), pdf


def test_wide_correlation_equals_duckdb(spark):
    """1,000 columns with nulls in one scan; 60 random pairs against DuckDB."""
    df, pdf = _wide(spark, 150, 1000, 7)
    cols = df.columns
    out = P.corr_pearson(df, cols)
    assert out._jdf.queryExecution().optimizedPlan().toString().count("RepartitionByExpression") <= 4
    got = {(r["a"], r["b"]): r["corr"] for r in out.collect()}
    assert len(got) == 1000 * 999 // 2
    rng = random.Random(2)
    pairs = [("x0", "x5")] + [tuple(sorted(rng.sample(cols, 2), key=cols.index)) for _ in range(60)]
    con = duckdb.connect()
    con.register("t", pdf)
    for a, b in pairs:
        want = con.execute(f"select corr({a}, {b}) from t").fetchone()[0]
        want = None if want is None or math.isnan(want) else want
        assert got[a, b] == (None if want is None else pytest.approx(want, abs=1e-9))


def test_wide_correlation_reads_its_input_once(spark):
    df = spark.range(100).select(*[(F.col("id") * k % 13).cast("double").alias(f"c{k}") for k in range(40)])
    plan = P.corr_pearson(df, df.columns)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Range (0, 100") == 1


def test_wide_correlation_bad_values_constants_and_empty(spark):
    df, _ = _wide(spark, 60, 30, 1)
    odd = (df.withColumn("x1", F.lit(float("nan"))).withColumn("x2", F.lit(None).cast("double"))
           .withColumn("x3", F.lit(1e300)).withColumn("x4", F.when(F.rand(1) < 2, float("inf"))))
    native = odd.agg(F.corr("x7", "x9").alias("r")).first()["r"]
    got = {(r["a"], r["b"]): r["corr"] for r in moments.correlations(odd, odd.columns).collect()}
    assert len(got) == 30 * 29 // 2 and got["x7", "x9"] == pytest.approx(native, abs=1e-12)
    assert all(got[p] is None for p in got if set(p) & {"x0", "x1", "x2", "x3", "x4"})
    empty = moments.correlations(odd.where("false"), odd.columns).collect()
    assert len(empty) == 435 and all(r["corr"] is None for r in empty)


def test_drop_correlated_reads_wide_correlations(spark):
    df = spark.range(200).select(*[F.sin(F.col("id") * (k + 1)).alias(f"c{k}") for k in range(30)])
    df = df.withColumn("copy", F.col("c4") * 3 + 1)
    cols = df.columns
    got = correlated_to_drop(P.corr_pearson(df, cols), 0.99, cols).where("dropped = 1").collect()
    assert [r["feature"] for r in got] == ["copy"]
