import math

from pyspark.sql import functions as F

from sparkwright.operators import clean as C
from sparkwright.operators import documents as D
from sparkwright.operators import relational as R
from tests.conftest import rows


def test_route_is_null_safe_and_complete(spark):
    df = spark.createDataFrame([(1, 5.0), (2, None), (3, -1.0)], "id int, v double")
    a, b = R.route(df, F.col("v") > 0)
    assert rows(a, "id") == [(1,)]
    assert rows(b, "id") == [(2,), (3,)]


def test_attach_columns_left_join_keeps_rows_and_replaces(spark):
    base = spark.createDataFrame([(1, 0.0), (2, 0.0)], "id int, s double")
    s1 = spark.createDataFrame([(1, 0.9)], "id int, s double")
    out = R.attach_columns(base, "id", s1)
    assert rows(out) == [(1, 0.9), (2, None)]


def test_map_lookup_policies(spark):
    df = spark.createDataFrame([("a",), ("zz",), (None,)], "k string")
    m = {"a": "A"}
    assert rows(R.map_lookup(df, "k", m, "g"), "g") == [("A",), (None,), (None,)]
    d = R.map_lookup(df, "k", m, "g", unknown="default", default="other")
    assert rows(d, "g") == [("A",), ("other",), ("other",)]
    try:
        R.map_lookup(df, "k", m, "g", unknown="error").collect()
        raise AssertionError("unknown key must fail")
    except Exception as e:  # noqa: BLE001
        assert "unknown key" in str(e)


def test_isin_key_table_and_head(spark):
    df = spark.createDataFrame([(i, float(i % 3)) for i in range(10)], "id int, v double")
    keys = spark.createDataFrame([(2,), (5,), (5,)], "id int")
    assert rows(R.isin_keys(df, "id", keys), "id") == [(2,), (5,)]
    top = R.head(df, 2, [F.col("v").desc(), F.col("id").asc()]).collect()
    assert [r.id for r in top] == [2, 5]


def _zoo(spark):
    return spark.createDataFrame(
        [(1, 1.0, "a"), (2, float("nan"), "b"), (3, None, "c"), (4, 2.0, ""), (5, 3.0, "  "), (6, 4.0, None)],
        "id int, x double, s string")


def test_nan_counts_only_on_floats(spark):
    r = C.nan_counts(_zoo(spark)).first()
    assert (r["id"], r["x"], r["s"]) == (0, 1, 0)


def test_missing_to_null_and_drop(spark):
    out = C.drop_incomplete(C.missing_to_null(_zoo(spark)))
    assert rows(out) == [(1, 1.0, "a")]


def test_blank_to_null_exact_only(spark):
    out = C.blank_to_null(_zoo(spark))
    got = {r.id: r.s for r in out.collect()}
    assert got[4] is None and got[5] == "  "


def test_fill_replaces_nan_and_null(spark):
    out = {r.id: r.x for r in C.fill_missing(_zoo(spark), 0.0, ["x"]).collect()}
    assert out[2] == 0.0 and out[3] == 0.0 and out[1] == 1.0


def test_duplicates_and_dedup_keep_first(spark):
    df = spark.createDataFrame([(1, "a"), (2, "a"), (3, "b"), (4, None), (5, None)], "id int, t string")
    r = C.duplicate_count(df, ["t"]).first()
    assert (r.duplicates, r.rows, r.distinct_rows) == (2, 5, 3)
    kept = C.dedup(df, ["t"], ["id"])
    assert rows(kept, "id") == [(1,), (3,), (4,)]


def test_constant_columns(spark):
    df = spark.createDataFrame([(1, 0.0, None), (2, 0.0, None)], "id int, c double, n double")
    assert C.constant_columns(df) == ["c", "n"]
    assert C.constant_columns(spark.createDataFrame([], "a int")) == ["a"]


def test_documents_update_delete_null_safe(spark):
    df = spark.createDataFrame([(1, "x", 1.0), (2, "y", 2.0), (3, None, 3.0)], "id int, seg string, v double")
    up = D.update_many(df, {"seg": "x"}, {"v": 0.0})
    assert rows(up) == [(1, "x", 0.0), (2, "y", 2.0), (3, None, 3.0)]
    de = D.delete_many(df, {"seg": "y"})
    assert rows(de, "id") == [(1,), (3,)]
    ins = D.insert_many(df, df)
    assert ins.count() == 6
    assert D.insert_many(df, df, key=["id"]).count() == 3


def test_empty_input(spark):
    df = spark.createDataFrame([], "id int, x double, s string")
    assert C.duplicate_count(df).first().duplicates == 0
    assert C.nan_counts(df).first()["x"] == 0
    assert math.isnan(float("nan"))


def test_local_table_literals_and_empty(spark):
    from sparkwright.functions.exprs import local_table
    t = local_table(spark, [("a", 1, float("nan")), ("b", None, 2.5)], "x string, y int, z double")
    assert [f.dataType.simpleString() for f in t.schema.fields] == ["string", "int", "double"]
    got = rows(t)
    assert got[0][:2] == ("a", 1) and got[0][2] != got[0][2] and got[1] == ("b", None, 2.5)
    e = local_table(spark, [], "x string, y bigint")
    assert e.count() == 0 and e.columns == ["x", "y"]
    # No Python worker: the rows are literals in the plan.
    assert "ExistingRDD" not in t._jdf.queryExecution().executedPlan().toString()


def test_semi_join_ignores_repeated_keys(spark):
    df = spark.createDataFrame([(1,), (2,), (None,)], "k int")
    keys = spark.createDataFrame([(2,), (2,), (None,)], "k int")
    assert rows(R.isin_keys(df, "k", keys)) == [(2,)]


def test_shared_folder_is_required_off_local_mode(spark, monkeypatch):
    import pytest
    from sparkwright import session

    class Context:
        master = "spark://cluster:7077"

        @staticmethod
        def getCheckpointDir():
            return None

    class Cluster:
        sparkContext = Context

        class conf:
            @staticmethod
            def get(key, default=None):
                return default

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.checkpoint_root(Cluster)


def test_materialize_keeps_schema_and_metadata(spark):
    from sparkwright.session import materialize
    df = spark.createDataFrame([(1, None, [1.0]), (2, "b", None)], "a int, b string, c array<double>")
    out = materialize(df)
    assert out.schema == df.schema and rows(out.select("a", "b")) == rows(df.select("a", "b"))
    assert "Scan" in out._jdf.queryExecution().executedPlan().toString()


def test_dedup_groups_by_hash(spark):
    df = spark.createDataFrame([(3, "x", None), (1, "x", "q"), (2, None, "q"), (4, None, "r"), (5, "", "s")],
                               "i int, t string, o string")
    out = C.dedup(df, ["t"], ["i"])
    assert rows(out) == rows(df.where("i in (1, 2, 5)"))
    assert rows(C.dedup(df, ["t"], ["i"], ["i"])) == [(1,), (2,), (5,)]
    plan = C.dedup(df, ["t"], ["i"], ["i"])._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(_h" in plan and "hashpartitioning(t" not in plan
    assert rows(C.duplicate_count(df, ["t"])) == [(2, 5, 3)]
