import numpy as np
import pytest
from pyspark.sql import functions as F

from sparkwright.operators import attribute_ratio as AR
from sparkwright.operators import profile as P
from sparkwright.operators.ordering import average_rank, exact_quantiles, row_number_exact, running_total
from tests.conftest import rows


def test_exact_quantiles_match_numpy(spark):
    vals = [float(v) for v in np.random.default_rng(0).normal(size=501).round(3)] + [1.0] * 40
    df = spark.createDataFrame([(v,) for v in vals], "v double")
    got = {r.prob: r.quantile for r in exact_quantiles(df, "v", [0.0, 0.25, 0.5, 0.75, 1.0]).collect()}
    for p, q in got.items():
        assert q == pytest.approx(float(np.quantile(vals, p)), abs=1e-12)


def test_quantiles_per_group_with_hot_group(spark):
    data = [("hot", float(i)) for i in range(3000)] + [("cold", float(i)) for i in range(7)]
    df = spark.createDataFrame(data, "g string, v double")
    got = {(r.g, r.prob): r.quantile for r in exact_quantiles(df, "v", [0.5], ["g"], num_partitions=8).collect()}
    assert got[("hot", 0.5)] == 1499.5 and got[("cold", 0.5)] == 3.0


def test_row_number_exact_skewed_partition(spark):
    df = spark.createDataFrame([("a" if i % 10 else "b", i) for i in range(2000)], "g string, k int")
    rn = row_number_exact(df, ["k"], ["g"], num_partitions=8).collect()
    by = {}
    for r in rn:
        by.setdefault(r.g, []).append((r.k, r.rn))
    for g, pairs in by.items():
        pairs.sort()
        assert [p[1] for p in pairs] == list(range(1, len(pairs) + 1))


def test_average_rank_ties(spark):
    df = spark.createDataFrame([(1, 10.0), (2, 20.0), (3, 20.0), (4, 30.0)], "id int, v double")
    got = {r.id: r["rank"] for r in average_rank(df, "v").collect()}
    assert got == {1: 1.0, 2: 2.5, 3: 2.5, 4: 4.0}


def test_describe_and_crosstab(spark):
    df = spark.createDataFrame([(1.0, "a", "x"), (3.0, "a", "y"), (5.0, "b", "x")], "v double, a string, b string")
    d = P.describe(df, ["v"]).first()
    assert (d["count"], d["mean"], d["min"], d["max"]) == (3, 3.0, 1.0, 5.0)
    assert d["stddev"] == pytest.approx(2.0)
    ct = {r.a_b: (r.x, r.y) for r in P.crosstab(df, "a", "b").collect()}
    assert ct == {"a": (1, 1), "b": (1, 0)}


def test_histogram_top_edge_and_empty_bins(spark):
    df = spark.createDataFrame([(0.0,), (1.0,), (10.0,)], "v double")
    h = {r.bin: r["count"] for r in P.histogram(df, ["v"], bins=5).collect()}
    assert h == {1: 2, 2: 0, 3: 0, 4: 0, 5: 1}


def test_spearman_matches_numpy(spark):
    rng = np.random.default_rng(1)
    x = rng.integers(0, 20, 300).astype(float)
    y = x * 0.5 + rng.integers(0, 10, 300)
    df = spark.createDataFrame([(i, float(a), float(b)) for i, (a, b) in enumerate(zip(x, y))], "id int, x double, y double")
    got = P.corr_spearman(df, ["x", "y"]).first()["corr"]

    def avg_rank(v):
        order = v.argsort(kind="mergesort")
        r = np.empty(len(v))
        r[order] = np.arange(1, len(v) + 1)
        for u in np.unique(v):
            r[v == u] = r[v == u].mean()
        return r
    assert got == pytest.approx(np.corrcoef(avg_rank(x), avg_rank(y))[0, 1], abs=1e-9)


def test_case_bins_gaps(spark):
    ages = [14.9, 27.49, 27.495, 27.5, 64.49, 64.5, 65.0]
    df = spark.createDataFrame([(a,) for a in ages], "Age double")
    got = [r.bins for r in P.case_bins(df, "Age").orderBy("Age").collect()]
    assert got == [1, 1, None, 2, 4, None, None]
    b = [r.bucket for r in P.bucketize(df, "Age", P.even_splits(15, 65, 4)).orderBy("Age").collect()]
    assert b == [None, 1, 1, 2, 4, 4, 4]


def test_attribute_ratio_contract(spark):
    df = spark.createDataFrame(
        [("n", 1.0, 1.0, 0.0), ("n", 3.0, 0.0, 0.0), ("k", 4.0, 1.0, 0.0), ("k", 4.0, 1.0, 0.0)],
        "label string, num double, b double, z double")
    r = {x.feature: x.ratio for x in AR.attribute_ratio(df, ["num", "z"], ["b"], "label").collect()}
    assert r["num"] == pytest.approx(4.0 / 3.0)        # max class mean / global mean
    assert r["z"] == 0.0                               # zero global mean -> 0
    assert r["b"] == 1000.0                            # class 'k' has no zeros
    ranked = [x.feature for x in AR.rank_features(AR.attribute_ratio(df, ["num", "z"], ["b"], "label")).collect()]
    assert ranked == ["b", "num", "z"]


def test_last_per_key_and_value_counts_ties(spark):
    df = spark.createDataFrame([("x", 1, 5), ("x", 2, 7), ("y", 1, 3)], "k string, seq int, v int")
    got = rows(P.last_per_key(df, "k", "v", "seq"), "k", "value")
    assert got == [("x", 7), ("y", 3)]
    vc = [tuple(r) for r in P.value_counts(spark.createDataFrame([("b",), ("a",)], "c string"), "c").collect()]
    assert vc == [("a", 1), ("b", 1)]


def test_running_total_many_groups_hot_and_null_groups(spark):
    """Brute force: a hot group (a third of the rows, spread over many
    partitions), a null group, and thousands of one-row groups."""
    from sparkwright.operators.ordering import running_total
    data = [("hot", i, float(i % 5)) for i in range(3000)]
    data += [(None, i, 1.0) for i in range(1500)]
    data += [(f"s{i}", i, 2.0) for i in range(4500)]
    df = spark.createDataFrame(data, "g string, k long, w double")
    got = {(r.g, r.k): r.run for r in running_total(df, ["k"], "w", ["g"], "run", num_partitions=16).collect()}
    want, acc = {}, {}
    for g, k, w in sorted(data, key=lambda x: (x[0] is not None, x[0] or "", x[1])):
        acc[g] = acc.get(g, 0.0) + w
        want[(g, k)] = acc[g]
    assert got == want
    glob = {r.k: r.n for r in running_total(df.where(F.col("g") == "hot"), ["k"], None, (), "n", 8).collect()}
    assert glob == {k: k + 1 for k in range(3000)}


def _null_class(spark):
    data = [("a", 1.0), ("a", 3.0), ("a", 4.0), ("b", 2.0), (None, 5.0), (None, 7.0), (None, 7.0), (None, None), ("b", None)]
    return spark.createDataFrame([(i, g, v) for i, (g, v) in enumerate(data)], "id int, g string, v double")


def test_null_class_keeps_its_rows(spark):
    from sparkwright.operators import splits as S
    df = _null_class(spark)
    d = {r.g: r for r in P.describe_by_class(df, "v", "g").collect()}
    assert (d[None]["count"], d[None].q25, d[None].q50, d[None].q75) == (3, 6.0, 7.0, 7.0)
    assert (d["a"].q50, d["b"].q50) == (3.0, 2.0)
    h = [(r.g, r["count"]) for r in P.histogram(df, ["v"], bins=2, by="g").collect() if r["count"]]
    assert sum(n for g, n in h if g is None) == 3 and sum(n for g, n in h if g == "a") == 3
    split = S.stratified_split(df, "id", "g", 0.5).collect()
    assert sum(r.is_test for r in split if r.g is None) == 2 and all(r.is_test is not None for r in split)


def test_crosstab_keeps_nulls_and_has_no_cap(spark):
    df = spark.createDataFrame([("x", "p"), ("x", None), (None, "p")], "a string, b string")
    out = {r["a_b"]: (r["p"], r["null"]) for r in P.crosstab(df, "a", "b").collect()}
    assert out == {"x": (1, 1), None: (1, 0)}
    wide = spark.range(10_500).selectExpr("id % 3 as a", "id as b")
    assert P.crosstab_long(wide, "a", "b").count() == 10_500


def test_pearson_means_the_same_at_any_width(spark):
    rng = np.random.default_rng(2)
    x = rng.standard_normal((60, 53))
    x[:, 1] += x[:, 0]
    data = [[None if (i + j) % 11 == 0 else float(v) for j, v in enumerate(r)] for i, r in enumerate(x)]
    cols = [f"c{j}" for j in range(53)]
    df = spark.createDataFrame(data, ", ".join(f"{c} double" for c in cols))
    got = {(r.a, r.b): r["corr"] for r in P.corr_pearson(df, cols).collect()}
    assert len(got) == 53 * 52 // 2
    for a, b in ((0, 1), (3, 40), (51, 52)):
        both = [(r[a], r[b]) for r in data if r[a] is not None and r[b] is not None]
        assert got[f"c{a}", f"c{b}"] == pytest.approx(np.corrcoef(np.array(both).T)[0, 1])


def test_running_total_exchanges_its_rows_once(spark):
    df = spark.range(3000).selectExpr("id", "id % 7 as g", "cast(id * 37 % 101 as double) as v")
    out = running_total(df, ["v", "id"], None, ["g"], "n", num_partitions=4)
    plan = out._jdf.queryExecution().executedPlan().toString()
    # One exchange of the rows (with the start rows); the other two hold a row
    # per group and bucket.
    assert plan.count("Exchange hashpartitioning(g") == 3 and "rangepartitioning" not in plan
    got = {r.id: r.n for r in out.collect()}
    want, seen = {}, {}
    for r in sorted(df.collect(), key=lambda r: (r.v, r.id)):
        seen[r.g] = seen.get(r.g, 0) + 1
        want[r.id] = seen[r.g]
    assert got == want
