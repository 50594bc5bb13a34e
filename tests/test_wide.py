"""Sketches, randomised PCA, and the lexicon table in batch and stream."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from sparkwright.operators import randomized_pca as R
from sparkwright.operators import sketches as K
from sparkwright.streaming import text_job as J


def test_stored_sketches_merge_without_the_rows(spark, tmp_path):
    rng = random.Random(3)
    data = [(f"d{i % 9}", "hot" if i % 3 else f"c{i % 4}", rng.gauss(0, 1), i % 777) for i in range(20_000)]
    data += [("d1", "none", None, None)]
    df = spark.createDataFrame(data, "day string, g string, v double, u int").repartition(6)
    path = str(tmp_path / "s")
    K.store(K.sketch(df, ["day", "g"], ["v"], ["u"]), path, "day")
    # Rebuilding a day replaces that day only.
    K.store(K.sketch(df.where("day = 'd1'"), ["day", "g"], ["v"], ["u"]), path, "day")
    stored = spark.read.parquet(path)
    merged = K.merge(stored, ["g"])
    probs = [0.0, 0.01, 0.5, 0.9, 1.0]
    by = {}
    for _, g, v, _ in data:
        by.setdefault(g, []).append(v)
    got = K.quantile_estimates(merged.where("g <> 'none'"), "v", probs, ["g"]).collect()
    assert len(got) == len(probs) * (len(by) - 1)
    for r in got:
        v = np.sort(by[r["g"]])
        assert r["n"] == len(v)
        assert abs(np.searchsorted(v, r["quantile"], "right") / len(v) - r["prob"]) <= 0.02
    users = {r["g"]: r["u"] for r in K.distinct_estimate(merged, "u", ["g"]).collect()}
    assert abs(users["hot"] - len({u for _, g, _, u in data if g == "hot"})) <= 0.05 * 777 and users["none"] == 0
    assert K.merge(stored).first()["rows"] == len(data)


def _table(spark, n, d, seed):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, 3)) @ (rng.normal(size=(3, d)) * np.array([[5], [3], [2]])) + rng.normal(size=(n, d)) * .1 + 50
    rows = [tuple(map(float, r)) for r in x]
    return spark.createDataFrame(rows, ", ".join(f"c{i} double" for i in range(d))).repartition(4), x


@pytest.mark.parametrize("d, scaled", [(5, False), (40, True)])
def test_components_equal_numpy(spark, d, scaled):
    df, x = _table(spark, 200, d, 1)
    model = R.fit(df, df.columns, k=3, scaled=scaled)
    c = np.corrcoef(x.T) if scaled else np.cov(x.T)
    values, vectors = np.linalg.eigh(c)
    assert np.allclose(model.variances, values[::-1][:3], rtol=1e-6)
    for j in range(3):
        v = vectors[:, -1 - j]
        v = v * (-1 if v[np.abs(v).argmax()] < 0 else 1)
        assert np.allclose(model.components[j], v, atol=1e-5)
    z = (x - x.mean(0)) / (x.std(0, ddof=1) if scaled else 1)
    got = model.transform(df.withColumn("id", F.lit("k"))).select("id", "pc1", "pc2").collect()
    assert np.allclose(sorted(r["pc1"] for r in got), sorted(z @ model.components[0]), atol=1e-6)


def test_two_thousand_columns(spark):
    df, x = _table(spark, 60, 2000, 2)
    model = R.fit(df, df.columns, k=3, passes=2)
    assert np.allclose(model.variances, np.linalg.svd(x - x.mean(0), compute_uv=False)[:3] ** 2 / 59, rtol=1e-4)


def test_nulls_constants_and_few_columns(spark):
    df = spark.createDataFrame([(1.0, 5.0, None), (2.0, 5.0, 4.0), (3.0, 5.0, None), (None, 5.0, 6.0)],
                               "a double, b double, c double")
    model = R.fit(df, ["a", "b", "c"], k=3, scaled=True)
    assert len(model.components) == 3 and model.variances[2] == pytest.approx(0, abs=1e-12)
    assert model.transform(df).where("pc1 is null").count() == 0


def test_lexicon_table_in_batch_and_stream(spark, tmp_path):
    lexicon = spark.createDataFrame([("good", 1.0, 0.5), ("bad", -1.0, 0.25), ("it's", 0.5, 1.0)],
                                    "word string, polarity double, subjectivity double")
    lines = ["good bad GOODt_endnothing here", "It's good, good!t_end", "", "good bad GOODt_end"]
    src, out, chk = (str(tmp_path / x) for x in ("src", "out", "chk"))
    spark.createDataFrame([(x,) for x in lines], "value string").repartition(2).write.text(src)
    J.run_idempotent(J.file_line_source(spark, src, max_files_per_trigger=1), out, chk, query_name="lexicon_test",
                     trigger={"availableNow": True}, lexicon=lexicon).awaitTermination()
    stream = sorted(map(tuple, spark.read.parquet(out).drop("batch_id").collect()))
    batch = J.scored_by_table(J.clean_words(spark.read.text(src)), lexicon)
    assert stream == sorted(map(tuple, batch.collect()))
    assert stream == sorted([("good bad GOOD", 1 / 3, 1.25 / 3)] * 2 + [("nothing here", 0.0, 0.0),
                                                                       ("It's good, good!", 2.5 / 3, 2.0 / 3)])


def test_many_keywords_equal_brute_force(spark):
    """50,000 keywords; texts with overlaps, other alphabets and line feeds."""
    from sparkwright.functions import text as TX
    rng = random.Random(11)
    words = sorted({"".join(rng.choice("abcdeé漢") for _ in range(rng.randint(4, 9))) for _ in range(60_000)})[:50_000]
    texts = ["".join(rng.choice("abcdeÉé漢 \n") for _ in range(rng.choice([0, 3, 50, 400]))) for _ in range(60)] + [None]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, text string").repartition(3)
    got = {(r["id"], r["keyword"]) for r in TX.keyword_matches(df, "id", "text", words).collect()}
    low = [(t or "").lower() for t in texts]
    assert got == {(i, w) for i, t in enumerate(low) for w in words if w in t} and len(got) > 50
    for few in (["ab"], ["a", "漢"], ["", "abc"], []):
        got = {(r["id"], r["keyword"]) for r in TX.keyword_matches(df, "id", "text", few).collect()}
        assert got == {(i, w) for i, t in enumerate(low) for w in few if w and w in t}
    rows = df.withColumn("lang", F.lit("en"))
    kept = TX.track_many(rows, "id", "text", "lang", words, ["en"])
    assert kept.columns == ["id", "text", "lang"]
    assert {r["id"] for r in kept.collect()} == {i for i, t in enumerate(low) if any(w in t for w in words)}


def test_too_many_values_for_columns_are_an_error(spark):
    from sparkwright.operators import features as H
    from sparkwright.operators import profile as P
    df = spark.range(10_500).select(F.col("id").cast("string").alias("a"), (F.col("id") % 2).alias("b"))
    with pytest.raises(ValueError, match="crosstab_long"):
        P.crosstab(df, "b", "a")
    with pytest.raises(ValueError, match="OneHotByFrequency"):
        H.fit_categories(df, ["a"])


def test_a_run_carries_its_piece_of_the_text(spark):
    """Keywords of any characters equal brute force; different pieces, cut at
    characters that no keyword has, are looked at once (each run of a text
    carried the whole text)."""
    from sparkwright.functions import text as TX
    words = ["a-b", "]x^", "\\d+", "x y\nz", "😀é", "-", "A&&B"]
    texts = ["a-b a-b,]X^|\\D+", "x y\nz😀É", "A&&b[^a-z]", "dd++ xyz", "", None, "q" * 500 + "]x^" + "w" * 500]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, text string")
    found = TX.keyword_matches(df, "id", "text", words)
    low = [(t or "").lower() for t in texts]
    assert {tuple(r) for r in found.collect()} == {(i, w.lower()) for i, t in enumerate(low) for w in words if w.lower() in t}
    plan = TX.keyword_matches(df, "id", "text", ["cats", "dog"])._jdf.queryExecution().optimizedPlan().toString()
    assert "array_distinct(split(lower(text" in plan
