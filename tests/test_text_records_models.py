import os
import tempfile

import numpy as np
import pytest
from pyspark.sql import functions as F

from sparkwright.functions import sentiment as SE
from sparkwright.functions import text as TX
from sparkwright.operators import models as M
from sparkwright.operators.profile import cluster_profile
from sparkwright.sources import records as RC
from sparkwright.sources.messages import message_text
from sparkwright.streaming import text_job as J
from tests.conftest import rows


def test_strict_cleaning_worked_example(spark):
    df = spark.createDataFrame([("RT @bob: see http://x.y #hit_endhttp://x.yt_endARTt_endt_end",)], "value string")
    got = [r.word for r in TX.clean_stream_text(df).collect()]
    assert got == ["  see  hi", "", "A"]


def test_non_strict_keeps_words(spark):
    df = spark.createDataFrame([("ART and RT: yes",)], "value string")
    assert [r.word for r in TX.clean_stream_text(df, strict=False).collect()] == ["ART and  yes"]


def test_sentiment_means_and_empty(spark):
    df = spark.createDataFrame([("good bad day",), ("nothing here",), ("",)], "word string")
    out = rows(SE.classify_text(df), "word", "polarity", "subjectivity")
    d = {w: (p, s) for w, p, s in out}
    assert d["good bad day"][0] == pytest.approx(0.0) and d["good bad day"][1] == pytest.approx((0.6 + 0.67) / 2)
    assert d["nothing here"] == (0.0, 0.0) and d[""] == (0.0, 0.0)
    lex = spark.createDataFrame([(k, v[0], v[1]) for k, v in SE.LEXICON.items()], "word string, polarity double, subjectivity double")
    keyed = spark.createDataFrame([(1, "good bad day"), (2, "nothing")], "k int, t string")
    t = {r.k: r.polarity for r in SE.score_with_table(keyed, "k", "t", lex).collect()}
    assert t == {1: pytest.approx(0.0), 2: 0.0}


def test_message_text_prefers_full_text_and_skips_bad(spark):
    df = spark.createDataFrame([('{"text":"short","extended_tweet":{"full_text":"long one"}}',),
                                ('{"text":"plain"}',), ('{"text":',), ('{"lang":"en"}',)], "value string")
    assert rows(message_text(df), "text") == [("long one",), ("plain",)]
    f = TX.track_filter(spark.createDataFrame([("The cat", "en"), ("the dog", "de")], "text string, lang string"),
                        "text", "lang", ["the"], ["en"])
    assert f.count() == 1


def test_stride_records_from_files(spark):
    d = tempfile.mkdtemp(prefix="sw-rec-")
    lines = ["Mars", "Terrestrial", "1.5", "0.6", "-60", "20", "0",
             "Jupiter", "Jovian", "5.2", "1898", "0", "0", "-110",
             "Broken", "Terrestrial", "x", "1", "2", "3", "4",
             "Half", "Jovian"]
    with open(os.path.join(d, "p.txt"), "w") as fh:
        fh.write("\n".join(lines) + "\n")
    recs = RC.stride_records(RC.numbered_lines(spark, d, "*.txt"), RC.PLANET_FIELDS, RC.PLANET_TYPES)
    got = {r.name: r for r in recs.collect()}
    assert set(got) == {"Mars", "Jupiter", "Broken"}                # incomplete record dropped
    assert got["Broken"].distance is None and got["Broken"].rejected
    v = {r.name: r for r in RC.render_planet(RC.planet_variant(recs)).collect()}
    assert v["Jupiter"].variant == "jovian" and v["Jupiter"].low is None and v["Jupiter"].cloud == -110
    assert v["Mars"].sentence == "Mars is 139.50 million miles from the Sun"
    assert v["Mars"].description.endswith("Surface Temperature (degrees C):-60 to 20\n")


def test_line_numbers_across_blocks_and_files(spark):
    """Small blocks: every file is split into many blocks read by different
    tasks, and several files share a task; numbering must still be exact."""
    d = tempfile.mkdtemp(prefix="sw-lines-")
    want = set()
    for f in range(3):
        with open(os.path.join(d, f"f{f}.txt"), "w") as fh:
            for i in range(3000 + 500 * f):
                line = f"{f}-{i}-" + "x" * (i % 37)
                fh.write(line + "\n")
                want.add((f"f{f}.txt", i, line))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8192")
    try:
        got = {(r.file.rsplit("/", 1)[-1], r.line_no, r.value)
               for r in RC.numbered_lines(spark, d, "*.txt").collect()}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert got == want


def test_stream_job_available_now(spark):
    src = tempfile.mkdtemp(prefix="sw-src-")
    with open(os.path.join(src, "a.txt"), "w") as fh:
        fh.write("good dayt_endRT badt_end\nhttp://x.y nice\n")
    out, chk = tempfile.mkdtemp(prefix="sw-out-"), tempfile.mkdtemp(prefix="sw-chk-")
    q = J.run_stream(J.file_line_source(spark, src), out, chk, trigger={"availableNow": True})
    q.awaitTermination()
    got = {r.word: r.polarity for r in spark.read.parquet(out).collect()}
    assert got == {"good day": 0.7, " bad": -0.7, " nice": 0.6}


# ------------------------------------------------------------------ models


@pytest.fixture(scope="module")
def planted(spark):
    rng = np.random.default_rng(7)
    x = rng.uniform(0, 1, 2000)
    noise = rng.normal(0, 1, 2000)
    data = [(i, float(a), float(b), 1.0 if a > 0.6 else 0.0) for i, (a, b) in enumerate(zip(x, noise))]
    return spark.createDataFrame(data, "id long, x double, z double, y double")


def test_forest_learns_planted_signal(spark, planted):
    v = M.assemble(planted, ["x", "z"])
    m = M.random_forest(num_trees=10, max_depth=4, label="y").fit(v)
    out = m.transform(v).withColumn("p", M.p_positive())
    acc = out.select(F.avg(((F.col("p") >= 0.5).cast("double") == F.col("y")).cast("double"))).first()[0]
    assert acc > 0.97
    ps = out.select(F.min("p"), F.max("p")).first()
    assert 0.0 <= ps[0] <= ps[1] <= 1.0


def test_pca_matches_numpy_up_to_sign(spark, planted):
    v = M.assemble(planted, ["x", "z"])
    out = M.pca(v, v, "features", 1).select("x", "z", "pc1").toPandas()
    X = out[["x", "z"]].to_numpy()
    Xc = X - X.mean(axis=0)
    _, _, vt = np.linalg.svd(Xc, full_matrices=False)
    ref = X @ vt[0]          # Spark projects uncentered data
    assert abs(abs(np.corrcoef(ref, out["pc1"])[0, 1]) - 1) < 1e-9


def test_gmm_weights_sum_to_one(spark, planted):
    v = M.assemble(planted, ["x", "z"])
    model, _ = M.gmm(v, v, "features", k=3, max_iter=10)
    p = M.gmm_params(model).groupBy("component").agg(F.first("weight").alias("w"))
    assert p.agg(F.sum("w")).first()[0] == pytest.approx(1.0)


def test_routing_table_rules(spark):
    data = ([(0, "attack")] * 26 + [(0, "normal")] * 4 + [(1, "attack")] * 25 + [(2, "normal")] * 30
            + [(3, "attack")] * 40 + [(4, "attack")] * 25 + [(4, "normal")] * 1)
    df = spark.createDataFrame(data, "c int, l string")
    r = {x.cluster: (x.route, x.score) for x in M.route_clusters(cluster_profile(df, "c", "l"), "c_l").collect()}
    assert r == {0: ("model", None), 1: ("constant", 1.0), 2: ("constant", 0.0), 3: ("constant", 1.0),
                 4: ("model", None)}


def test_cluster_scoring_scores_every_row_once(spark, planted):
    v = M.assemble(planted, ["x", "z"]).withColumn("c", (F.col("id") % 3).cast("int"))
    v = v.withColumn("l", F.when(F.col("y") == 1.0, "attack").otherwise("normal"))
    tr = v.where(F.col("c") < 2)
    routing = M.route_clusters(cluster_profile(tr, "c", "l"), "c_l")
    forests = M.fit_cluster_forests(tr, routing.collect(), "c", "features", "y", num_trees=5, max_depth=3)
    scored = M.score_clusters(v, "id", "c", routing, forests)
    assert scored.count() == 2000 and scored.select("id").distinct().count() == 2000
    assert scored.where(F.col("c") == 2).select(F.min("p"), F.max("p")).first() == (1.0, 1.0)


def test_category_detectors_single_pass(spark, planted):
    df = planted.withColumn("g", F.when(F.col("x") > 0.8, "A").when(F.col("x") > 0.6, "B").otherwise("normal"))
    det = M.category_detectors(df, df, "g", {"A": ["A"], "B": ["B"]}, {"A": ["x", "z"], "B": ["x"]},
                               num_trees=5, max_depth=3)
    assert det.columns == [*df.columns, "p_A", "p_B"] and det.count() == 2000
    plan = det._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan                      # scored without joins or shuffles
    r = det.where(F.col("g") == "A").agg(F.avg("p_A")).first()[0]
    assert r > 0.5


def test_messages_must_be_one_json_value_with_a_string(spark):
    from sparkwright.sources.messages import message_text
    good = ['{"text":"a"}', ' {"text":"b","lang":"de"} ', '{"text":"c","extended_tweet":{"full_text":"long"}}']
    bad = ['{"text":"a"} trailing', '{"text":5}', '{"text":"a"', '"x"', "{}", '{"text":"a"}}', '{"text":null}', None, "",
           '{"text":"a","extended_tweet":{}}', '{"text":"a","extended_tweet":null}', '{"text":"a"},{"text":"b"}', "[]"]
    df = spark.createDataFrame([(m,) for m in good + bad], "value string")
    assert rows(message_text(df)) == sorted([("a", None), ("b", "de"), ("long", None)], key=repr)


def test_stream_reads_every_file_and_batches(spark, tmp_path):
    from sparkwright.streaming import text_job as J
    src, out, chk = (str(tmp_path / d) for d in ("src", "out", "chk"))
    import os
    os.makedirs(src)
    for i, name in enumerate(["a.txt", "b.log", "c"]):
        with open(f"{src}/{name}", "w") as f:
            f.write(f"good day {i}t_end\n")
    source = J.file_line_source(spark, src, max_files_per_trigger=1)
    q = J.run_stream(source, out, chk, query_name="trigger_test", trigger={"processingTime": "1 second"}, repartition=2)
    try:
        q.processAllAvailable()
        assert len([p for p in q.recentProgress if p["numInputRows"]]) == 3  # a file a batch
    finally:
        q.stop()
    assert spark.read.parquet(out).where("word like '%good day%'").count() == 3
