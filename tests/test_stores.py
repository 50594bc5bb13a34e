"""Bucketed score stores, collections updated in place, saved stages, and the
restartable sink."""

import glob
import os
import subprocess
import sys
import textwrap

import pytest
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from sparkwright.operators.features import frequency_index
from sparkwright.operators.relational import attach_columns
from sparkwright.operators.score_store import ScoreStore
from sparkwright.operators.stages import FrequencyIndexer, OneHotByFrequency, RatioSelector, Standardizer
from sparkwright.operators.stored_collection import Collection
from sparkwright.session import shared_path
from sparkwright.streaming import text_job as J
from tests.conftest import SF_SMOKE, rows

# ---------------------------------------------------------------- scores


def _scores(spark, n, name, step=1):
    return spark.range(0, n, step).select(F.col("id"), (F.col("id") * 0.5).alias(name))


def test_five_way_attach_plans_no_exchange(spark):
    store = ScoreStore(spark, "id", 4)
    store.write("base", spark.range(1000).select("id", (F.col("id") % 3).alias("y"), F.lit(-1.0).alias("s1")))
    for k in range(5):
        assert store.write(f"s{k}", _scores(spark, 1000, f"s{k}", k + 1)) == -(-1000 // (k + 1))
    out = store.attach("base", *[f"s{k}" for k in range(5)])
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("SortMergeJoin") == 5 and "Exchange" not in plan
    got = {r["id"]: r for r in out.collect()}
    assert len(got) == 1000 and set(out.columns) == {"id", "y", *[f"s{k}" for k in range(5)]}
    for i, r in got.items():
        assert all(r[f"s{k}"] == (i * 0.5 if i % (k + 1) == 0 else None) for k in range(5))
    assert store.attach("base", "s4", how="inner").count() == 200
    store.drop()


def test_repeated_key_is_an_error(spark):
    store = ScoreStore(spark, "id", 3)
    store.write("base", spark.range(10))
    twice = spark.createDataFrame([(1, 0.5), (2, 0.1), (1, 0.5)], "id bigint, p double")
    with pytest.raises(Exception, match="repeated id: 1"):
        store.write("p", twice)
    assert "p" not in store.tables
    # Rows without a key match nothing.
    assert store.write("p", spark.createDataFrame([(None, 0.5), (None, 0.1), (3, 0.2)], "id bigint, p double")) == 1
    assert store.attach("base", "p").where("p is not null").count() == 1
    with pytest.raises(Exception, match="repeated id: 1"):
        attach_columns(spark.range(10), "id", twice).collect()


def test_attach_counts_and_replaced_tables(spark):
    store = ScoreStore(spark, "id", 3)
    store.write("base", spark.range(100))
    store.write("a", _scores(spark, 100, "a"))
    store.write("b", _scores(spark, 100, "b", 4))
    assert store.attach_checked("all", "base", "a", "b") == {"rows": 100, "attached": 100, "a": 0, "b": 75}
    assert store.read("all").where("b is null").count() == 75
    store.write("a", spark.range(5).select("id", F.lit(9.0).alias("a")))
    assert store.attach("base", "a").where("a = 9").count() == 5
    assert store.write("none", spark.range(0).select("id", F.lit(1.0).alias("z"))) == 0


# ------------------------------------------------------------ collections

DOCS = [(i, f"u{i % 7}" if i % 11 else None, "new", float(i)) for i in range(200)]
KIND = "id int, user string, state string, v double"


def _files(path):
    return {p: os.stat(p).st_mtime_ns for p in glob.glob(f"{path}/_part=*/*.parquet")}


def test_update_and_delete_touch_their_partition_only(spark, tmp_path):
    c = Collection(spark, str(tmp_path / "c"), "user", 16)
    c.insert_many(spark.createDataFrame(DOCS, KIND).repartition(3))
    before = _files(c.path)
    want = {r[0]: list(r) for r in DOCS}
    assert c.update_many({"user": "u3"}, {"state": "seen"}) == {
        "matched": sum(r[1] == "u3" for r in DOCS), "modified": sum(r[1] == "u3" for r in DOCS)}
    for r in want.values():
        if r[1] == "u3":
            r[2] = "seen"
    assert rows(c.read(), "id", "user", "state", "v") == sorted(map(tuple, want.values()), key=repr)
    after = _files(c.path)
    gone = {os.path.dirname(p) for p in before if p not in after}
    assert len(gone) == 1 and all(after[p] == t for p, t in before.items() if os.path.dirname(p) not in gone)
    assert c.update_many({"user": "u3"}, {"state": "seen"})["modified"] == 0
    assert c.delete_many({"user": "u5", "state": "new"})["deleted"] == sum(r[1] == "u5" for r in DOCS)
    assert c.find({"user": "u5"}).count() == 0 and c.find({"user": "u3"}).count() == sum(r[1] == "u3" for r in DOCS)
    # A document without the field stays.
    assert c.read().where("user is null").count() == sum(r[1] is None for r in DOCS)


def test_match_by_another_field_and_moved_documents(spark, tmp_path):
    c = Collection(spark, str(tmp_path / "c"), "user", 8)
    c.insert_many(spark.createDataFrame(DOCS, KIND))
    assert c.update_many({"id": 30}, {"v": -1.0}) == {"matched": 1, "modified": 1}
    assert c.find({"id": 30}).first()["v"] == -1.0
    # Setting the partition field moves documents, also onto a value with documents of its own.
    n1, n2 = (sum(r[1] == u for r in DOCS) for u in ("u1", "u2"))
    assert c.update_many({"user": "u1"}, {"user": "u2"})["matched"] == n1
    assert c.find({"user": "u2"}).count() == n1 + n2 and c.find({"user": "u1"}).count() == 0
    assert c.read().count() == 200
    assert c.update_many({"user": "nobody"}, {"v": 0.0}) == {"matched": 0, "modified": 0}
    assert c.delete_many({"state": "absent"}) == {"deleted": 0}
    # Everything goes, partition by partition; then documents come anew.
    assert c.delete_many({"state": "new"})["deleted"] == 200
    assert not _files(c.path)
    c.insert_many(spark.createDataFrame(DOCS[:3], KIND))
    assert c.read().count() == 3


# ----------------------------------------------------------------- stages


def _train(spark):
    data = [("b", 1.0, 1.0, "x"), ("a", 2.0, 0.0, "x"), ("a", 3.0, 0.0, "y"), ("c", 6.0, 1.0, "y"), (None, 0.0, 0.0, "y")]
    return spark.createDataFrame(data, "s string, v double, f double, y string")


def _pipeline():
    return Pipeline(stages=[
        RatioSelector(numericCols=["v"], binaryCols=["f"], labelCol="y", outputCol="sel", minRatio=1.2),
        FrequencyIndexer(inputCol="s", outputCol="i", unseen="keep"), OneHotByFrequency(inputCol="s", outputCol="hot"),
        Standardizer(inputCols=["v"])])


def _applied(model, spark):
    test = spark.createDataFrame([(1, "c", 3.0, 1.0), (2, "a", 0.0, 0.0), (3, "new", 1.0, 1.0), (4, None, 2.0, 0.0)],
                                 "id int, s string, v double, f double")
    out = model.transform(test)
    return sorted((r["id"], r["i"], tuple(r["h"]), tuple(r["x"]), round(r["v"], 9)) for r in out.select(
        "id", "i", "v", vector_to_array("hot").alias("h"), vector_to_array("sel").alias("x")).collect())


def test_stages_fit_save_and_load(spark, tmp_path):
    train = _train(spark)
    model = _pipeline().fit(train)
    want = _applied(model, spark)
    std = train.agg(F.stddev_samp("v")).first()[0]
    # a is most frequent, then b and c by value; ratio of v: 3 / 2.4, of f: max(1 / 1, 1 / 2) -> only v stays.
    assert want == [(1, 2.0, (0.0, 0.0, 1.0), (3.0,), round((3.0 - 2.4) / std, 9)),
                    (2, 0.0, (1.0, 0.0, 0.0), (0.0,), round(-2.4 / std, 9)),
                    (3, 3.0, (0.0, 0.0, 0.0), (1.0,), round(-1.4 / std, 9)),
                    (4, 3.0, (0.0, 0.0, 0.0), (2.0,), round(-0.4 / std, 9))]
    path = str(tmp_path / "model")
    model.write().save(path)
    again = PipelineModel.load(path)
    assert _applied(again, spark) == want
    assert [type(s).__name__ for s in again.stages] == [type(s).__name__ for s in model.stages]
    assert [s.uid for s in again.stages] == [s.uid for s in model.stages]
    again.stages[0].set(again.stages[0].minRatio, 0.5)
    assert again.stages[0].selected() == ["v", "f"]
    # The unfitted pipeline is saved and loaded too.
    _pipeline().write().save(str(tmp_path / "plain"))
    assert _applied(Pipeline.load(str(tmp_path / "plain")).fit(train), spark) == want


def test_saved_stages_in_another_session(spark, tmp_path):
    """A fresh Python process and Spark application loads and applies them."""
    path = str(tmp_path / "model")
    _pipeline().fit(_train(spark)).write().save(path)
    code = textwrap.dedent("""
        import sys
        from pyspark.ml import PipelineModel
        from sparkwright.session import get_spark
        from tests.test_stores import _applied
        spark = get_spark("local[2]", shuffle_partitions=2)
        print("GOT", _applied(PipelineModel.load(sys.argv[1]), spark))""")
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    run = subprocess.run([sys.executable, "-c", code, path], capture_output=True, text=True, timeout=180,
                         env=os.environ | {"PYTHONPATH": root}, cwd=root)
    assert f"GOT {_applied(PipelineModel.load(path), spark)}" in run.stdout, run.stderr[-2000:]


def test_unseen_policies_and_empty_columns(spark):
    train = _train(spark)
    new = spark.createDataFrame([("zz",), ("a",), (None,)], "s string")
    got = FrequencyIndexer(inputCol="s", outputCol="i").fit(train).transform(new).collect()
    assert sorted(((r["s"], r["i"]) for r in got), key=repr) == sorted([("zz", None), ("a", 0.0), (None, None)], key=repr)
    with pytest.raises(Exception, match="unseen value: zz"):
        FrequencyIndexer(inputCol="s", outputCol="i", unseen="error").fit(train).transform(new).collect()
    with pytest.raises(ValueError, match="no value"):
        OneHotByFrequency(inputCol="s", outputCol="h").fit(train.where("s is null"))
    assert {r["s"]: r["index"] for r in frequency_index(train, "s").collect()} == {"a": 0.0, "b": 1.0, "c": 2.0}


def test_one_hot_of_many_values_stays_narrow(spark):
    df = spark.range(20_000).select((F.col("id") % 5000).cast("string").alias("s"))
    model = OneHotByFrequency(inputCol="s", outputCol="h").fit(df)
    out = model.transform(df.limit(50)).select("h").collect()
    assert all(r["h"].size == 5000 and len(r["h"].indices) == 1 for r in out)


# ----------------------------------------------------------------- stream


def test_stopped_stream_goes_on_without_loss_or_doubles(spark, tmp_path):
    src, out, chk = (str(tmp_path / x) for x in ("src", "out", "chk"))
    os.mkdir(src)
    lines = []
    for k in range(5):
        mine = [f"good text {k} {i}t_end" for i in range(20)]
        lines += mine
        with open(f"{src}/part-{k}.txt", "w") as f:
            f.write("\n".join(mine))
        os.utime(f"{src}/part-{k}.txt", (1_700_000_000 + k, 1_700_000_000 + k))

    def start(after=None):
        return J.run_idempotent(J.file_line_source(spark, src, max_files_per_trigger=1), out, chk, query_name="again",
                                trigger={"availableNow": True}, after=after)
    seen = []

    def fail(batch_id):
        seen.append(batch_id)
        if batch_id == 2:
            raise RuntimeError("stop here")

    with pytest.raises(Exception, match="stop here"):
        start(fail).awaitTermination()
    assert seen == [0, 1, 2] and spark.read.parquet(out).count() == 60
    start(seen.append).awaitTermination()
    # Batch 2 was written but not committed: it is run again, onto itself.
    assert seen == [0, 1, 2, 2, 3, 4]
    got = spark.read.parquet(out)
    assert sorted(r["word"] for r in got.collect()) == sorted(x.removesuffix("t_end") for x in lines)
    files = [len(glob.glob(f"{out}/batch_id={k}/*.parquet")) for k in range(5)]
    assert files == [1] * 5
    # A third start finds nothing to do.
    start(seen.append).awaitTermination()
    assert len(seen) == 6 and spark.read.parquet(out).count() == 100


@pytest.mark.parametrize("name", ["stream_restart_sink", "stream_lexicon_table"])
def test_a_batch_is_read_and_written_by_several_tasks(spark, name, monkeypatch):
    """A larger input has more files in as many batches; each batch was one
    file, and one task wrote it."""
    from sparkwright.plans import QUERIES
    few = QUERIES[name](spark, SF_SMOKE)
    monkeypatch.setattr(J, "FILE_BYTES", 20_000)
    monkeypatch.setattr(J, "scored_by_table", lambda b, t, _f=J.scored_by_table: _f(b, t).repartition(3))
    many = QUERIES[name](spark, SF_SMOKE)
    assert sorted(map(tuple, many.collect())) == sorted(map(tuple, few.collect()))
    files = [f.split("batch_id=")[1].split("/")[0] for f in many.inputFiles()]
    batches = 4 if name == "stream_restart_sink" else 2
    assert len(set(files)) == batches and all(files.count(b) > 1 for b in set(files))
