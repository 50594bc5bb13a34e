"""Queries whose operators keep state between steps: bucketed score stores,
collections updated in place, saved pipelines, a restarted stream, and the
one-scan statistics of wide and many-class tables."""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from sparkwright.functions import sentiment as SE
from sparkwright.operators import profile as P
from sparkwright.operators import randomized_pca
from sparkwright.operators import sketches as K
from sparkwright.operators import splits as S
from sparkwright.operators.score_store import ScoreStore
from sparkwright.operators.selection import quantiles
from sparkwright.operators.stages import FrequencyIndexer, OneHotByFrequency, RatioSelector, Standardizer
from sparkwright.operators.stored_collection import Collection
from sparkwright.plans.q_features import _SEED, _hash_sql
from sparkwright.plans.q_profile import feat_once, round_doubles
from sparkwright.plans.q_text import _CLEAN_SQL, _sentiment_sql, framed_documents
from sparkwright.plans.registry import query, with_ctes
from sparkwright.session import materialize, shared_path
from sparkwright.sources.tables import FEAT_BINARY, FEAT_NUMERIC, FEAT_SQL, feat, read_table
from sparkwright.streaming import text_job as J

# ------------------------------------------------------------------ J1/J2

#: Rule scores that stand for five models' probabilities, in Spark SQL and DuckDB alike.
_SCORES = {"p_total": "score1", "p_qty": "least(qty / 400.0, 1.0)", "p_lines": "n_lines / 7.0",
           "p_return": "has_return", "p_negative": "acct_negative"}


@query("join_store_attach", with_ctes(FEAT_SQL, "SELECT id, label2, " + ", ".join(
    f"{e} AS {c}" if c != "p_return" else f"CASE WHEN n_lines > 2 THEN {e} END AS {c}"
    for c, e in _SCORES.items()) + " FROM feat"))
def join_store_attach(spark, sf):
    """Five scores attached to the stored base without an exchange; the last but
    one table misses the ids of small orders."""
    f = feat_once(spark, sf, ["id", "label2", "score1", "qty", "n_lines", "has_return", "acct_negative"])
    store = ScoreStore(spark, "id")
    store.write("base", f.select("id", "label2"))
    for c, e in _SCORES.items():
        rows = f.where("n_lines > 2") if c == "p_return" else f
        store.write(c, rows.select("id", F.expr(e).alias(c)))
    return store.attach("base", *_SCORES)


@query("join_store_counts", with_ctes(FEAT_SQL, """
SELECT count(*) AS rows, count(*) AS attached, count(*) FILTER (WHERE n_lines <= 2) AS p_return,
       CAST(0 AS BIGINT) AS p_total FROM feat"""))
def join_store_counts(spark, sf):
    """Rows before and after an attach, and rows that a table has no score for."""
    f = feat_once(spark, sf, ["id", "score1", "n_lines", "has_return"])
    store = ScoreStore(spark, "id")
    store.write("base", f.select("id"))
    store.write("p_total", f.select("id", F.col("score1").alias("p_total")))
    store.write("p_return", f.where("n_lines > 2").select("id", F.col("has_return").alias("p_return")))
    counts = store.attach_checked("all", "base", "p_total", "p_return")
    return spark.range(1).select(*[F.lit(v).cast("bigint").alias(c) for c, v in counts.items()])


# ------------------------------------------------------------------ K5/K6

_USER, _GONE = 8, 46


@query("doc_partition_update", f"""
WITH m AS (
  SELECT count(*) FILTER (WHERE user_id = {_USER}) AS user_matched,
         count(*) FILTER (WHERE user_id = {_USER} AND event_type <> 'vip') AS user_modified,
         count(*) FILTER (WHERE user_id = {_GONE}) AS user_deleted,
         count(*) FILTER (WHERE event_type = 'error' AND user_id NOT IN ({_USER}, {_GONE})) AS error_matched,
         count(*) FILTER (WHERE event_type = 'error' AND user_id NOT IN ({_USER}, {_GONE}) AND value <> 0) AS error_modified
  FROM events)
SELECT event_id, user_id, CASE WHEN user_id = {_USER} THEN 'vip' ELSE event_type END AS event_type,
       CASE WHEN event_type = 'error' AND user_id <> {_USER} THEN CAST(0 AS DOUBLE) ELSE value END AS value,
       m.* FROM events, m WHERE user_id <> {_GONE}""")
def doc_partition_update(spark, sf):
    """Update and delete by the partition field (one partition each), then
    update by another field (the partitions that hold a match)."""
    c = Collection(spark, shared_path(spark, "collection"), "user_id", 16)
    c.insert_many(read_table(spark, sf, "events").select("event_id", "user_id", "event_type", "value"))
    user = c.update_many({"user_id": _USER}, {"event_type": "vip"})
    gone = c.delete_many({"user_id": _GONE})
    error = c.update_many({"event_type": "error"}, {"value": 0.0})
    counts = {"user_matched": user["matched"], "user_modified": user["modified"], "user_deleted": gone["deleted"],
              "error_matched": error["matched"], "error_modified": error["modified"]}
    return c.read().select("*", *[F.lit(v).cast("bigint").alias(k) for k, v in counts.items()])


# ------------------------------------------------------------- X6, H2-H4, A16

_SEGMENTS = 5
_MIN_RATIO = 1.0


def _ratio_sql():
    parts = [f"SELECT '{c}' AS feature, coalesce(max(k.m / nullif(g.m, 0)), 0.0) AS ratio FROM "
             f"(SELECT avg({c}) AS m FROM tr GROUP BY label_group) k, (SELECT avg({c}) AS m FROM tr) g"
             for c in FEAT_NUMERIC]
    parts += [f"SELECT '{c}' AS feature, max(coalesce(s / nullif(n - s, 0), 1000.0)) AS ratio FROM "
              f"(SELECT sum({c}) AS s, count({c}) AS n FROM tr GROUP BY label_group)" for c in FEAT_BINARY]
    return "\nUNION ALL\n".join(parts)


_ALL_FEATURES = [*FEAT_NUMERIC, *FEAT_BINARY]


@query("feat_pipeline_saved", with_ctes(
    FEAT_SQL, f"tr AS (SELECT * FROM feat WHERE {_hash_sql()} < 'cccccccc')",
    """idx AS (SELECT segment, CAST(row_number() OVER (ORDER BY count(*) DESC, segment) - 1 AS DOUBLE) AS i
        FROM tr GROUP BY segment)""",
    f"ar AS (SELECT * FROM ({_ratio_sql()}) WHERE ratio >= {_MIN_RATIO})",
    "st AS (SELECT " + ", ".join(f"avg({c}) AS {c}_avg, stddev_samp({c}) AS {c}_std" for c in FEAT_NUMERIC) + " FROM tr)",
    "SELECT f.id, idx.i AS segment_index, "
    + ", ".join(f"CAST(coalesce(idx.i = {k}, false) AS DOUBLE) AS hot_{k}" for k in range(_SEGMENTS)) + ", "
    + "(SELECT count(*) FROM ar) AS n_selected, round("
    + " + ".join(f"CASE WHEN '{c}' IN (SELECT feature FROM ar) THEN {c} ELSE 0 END" for c in _ALL_FEATURES)
    + ", 4) AS selected_sum, "
    + ", ".join(f"round(coalesce(({c} - {c}_avg) / nullif({c}_std, 0), 0.0), 6) AS {c}" for c in FEAT_NUMERIC)
    + f" FROM feat f LEFT JOIN idx ON f.segment = idx.segment, st WHERE {_hash_sql('f.id')} >= 'cccccccc'"))
def feat_pipeline_saved(spark, sf):
    """Ratio selection, frequency index, one-hot and scaling as one Pipeline:
    fitted on the train side, saved, loaded and applied to the test side."""
    f = feat_once(spark, sf, ["id", "segment", "label_group", *_ALL_FEATURES])
    train, test = S.random_split(f, "id", [0.8, 0.2], _SEED)
    pipeline = Pipeline(stages=[
        RatioSelector(numericCols=FEAT_NUMERIC, binaryCols=FEAT_BINARY, labelCol="label_group", outputCol="selected",
                      minRatio=_MIN_RATIO),
        FrequencyIndexer(inputCol="segment", outputCol="segment_index"),
        OneHotByFrequency(inputCol="segment", outputCol="hot"),
        Standardizer(inputCols=FEAT_NUMERIC)])
    path = shared_path(spark, "pipeline-model")
    pipeline.fit(train).write().save(path)
    out = PipelineModel.load(path).transform(test)
    hot, selected = vector_to_array("hot"), vector_to_array("selected")
    return round_doubles(out.select(
        "id", "segment_index", *[hot[k].alias(f"hot_{k}") for k in range(_SEGMENTS)],
        F.size(selected).cast("bigint").alias("n_selected"),
        F.round(F.aggregate(selected, F.lit(0.0), lambda a, x: a + x), 4).alias("selected_sum"), *FEAT_NUMERIC))


# ------------------------------------------------------------ K1-K3, T-5


@query("stream_restart_sink", _sentiment_sql(f"c AS ({_CLEAN_SQL})"))
def stream_restart_sink(spark, sf):
    """The text job stopped by a failure after its second batch was written but
    not committed, and started again: that batch is replayed onto itself."""
    src, out, chk = (shared_path(spark, f"restart-{x}") for x in ("src", "out", "chk"))
    # Four batches of as many files as the input needs.
    times = J.stage_lines(framed_documents(spark, sf), src, 4)

    def fail(batch_id):
        if batch_id == 1:
            raise RuntimeError("stopped before the commit")

    def start(after=None):
        return J.run_idempotent(J.file_line_source(spark, src, max_files_per_trigger=times), out, chk,
                                query_name="restarted", trigger={"availableNow": True}, files=None, after=after)

    first = start(fail)
    try:
        first.awaitTermination()
    except Exception as e:  # noqa: BLE001  only the planned stop may pass
        if "stopped before the commit" not in str(e):
            raise
    start().awaitTermination()
    return round_doubles(spark.read.parquet(out).drop("batch_id"))


# ------------------------------------------------------- A18, A7/A8 at width

_WIDTH = 64


@query("agg_corr_wide", f"""
WITH x AS (SELECT vec_id, unnest(range({_WIDTH})) AS i, CAST(unnest(embedding[1:{_WIDTH}]) AS DOUBLE) AS x FROM embeddings),
y AS (SELECT vec_id, i, CASE WHEN (vec_id + i) % 7 = 0 THEN NULL ELSE x END AS x FROM x)
SELECT 'e' || a.i AS a, 'e' || b.i AS b, round(corr(a.x, b.x), 6) AS corr
FROM y a JOIN y b ON a.vec_id = b.vec_id AND a.i < b.i GROUP BY a.i, b.i""")
def agg_corr_wide(spark, sf):
    """All pairs of the embedding's components, each with gaps of its own."""
    e = read_table(spark, sf, "embeddings")
    cols = [F.when((F.col("vec_id") + k) % 7 != 0, F.col("embedding")[k].cast("double")).alias(f"e{k}")
            for k in range(_WIDTH)]
    return round_doubles(P.corr_pearson(e.select(*cols), [f"e{k}" for k in range(_WIDTH)]))


_PROBS = [0.0, 0.25, 0.5, 0.75, 0.99]


@query("agg_quantiles_many_classes", "\nUNION ALL\n".join(
    f"SELECT l_partkey, CAST({p} AS DOUBLE) AS prob, round(quantile_cont(l_extendedprice, {p}), 6) AS quantile "
    "FROM lineitem GROUP BY l_partkey" for p in _PROBS))
def agg_quantiles_many_classes(spark, sf):
    """Exact quantiles of thousands of classes."""
    li = read_table(spark, sf, "lineitem").select("l_partkey", "l_extendedprice")
    return round_doubles(quantiles(li, "l_extendedprice", _PROBS, ["l_partkey"]))


# ------------------------------------------------------------ A4, A7 sketches

_SKETCH_PROBS = [0.05, 0.25, 0.5, 0.75, 0.95]


@query("agg_sketches_merged", "\nUNION ALL\n".join(
    f"SELECT event_type, CAST({p} AS DOUBLE) AS prob, count(value) AS n, true AS rank_close, true AS users_close "
    "FROM events GROUP BY event_type" for p in _SKETCH_PROBS))
def agg_sketches_merged(spark, sf):
    """Daily sketches of the events, stored, and merged per type from the store
    alone: the estimates' true ranks are within 2 % of the asked ones, the
    distinct users within 5 %."""
    e = read_table(spark, sf, "events").select(F.to_date("ts").alias("day"), "event_type", "value", "user_id")
    path = shared_path(spark, "sketches")
    K.store(K.sketch(e, ["day", "event_type"], ["value"], ["user_id"]), path, "day")
    merged = materialize(K.merge(spark.read.parquet(path), ["event_type"]))
    q = K.quantile_estimates(merged, "value", _SKETCH_PROBS, ["event_type"])
    users = K.distinct_estimate(merged, "user_id", ["event_type"]).withColumnRenamed("user_id", "users")
    asked = materialize(q.join(users, "event_type"))
    exact = e.groupBy("event_type").agg(F.count_distinct("user_id").alias("true_users"))
    # Counts of the values below and up to each estimate.
    below = e.join(asked.select("event_type", "prob", "quantile"), "event_type").groupBy("event_type", "prob").agg(
        F.count_if(F.col("value") < F.col("quantile")).alias("lo"), F.count_if(F.col("value") <= F.col("quantile")).alias("hi"))
    out = asked.join(below, ["event_type", "prob"]).join(exact, "event_type")
    return out.select(
        "event_type", "prob", "n",
        ((F.col("lo") / F.col("n") <= F.col("prob") + 0.02) & (F.col("hi") / F.col("n") >= F.col("prob") - 0.02)).alias("rank_close"),
        (F.abs(F.col("users") - F.col("true_users")) <= 0.05 * F.col("true_users")).alias("users_close"))


# --------------------------------------------------------------- H12 at width


def _power_sums_sql() -> str:
    """Traces of the powers of the correlation matrix: the power sums of its
    eigenvalues, which determine them."""
    cells = "\nUNION ALL\n".join(f"SELECT {i} AS i, {j} AS j, corr({a}, {b}) AS c FROM feat"
                                 for i, a in enumerate(FEAT_NUMERIC) for j, b in enumerate(FEAT_NUMERIC))
    powers = ["m1 AS (SELECT i, j, c FROM cm)"]
    powers += [f"m{k} AS (SELECT a.i, b.j, sum(a.c * b.c) AS c FROM m{k - 1} a JOIN cm b ON a.j = b.i GROUP BY a.i, b.j)"
               for k in range(2, 6)]
    return with_ctes(FEAT_SQL, f"cm AS ({cells})", *powers, "\nUNION ALL\n".join(
        f"SELECT {k} AS power, round(sum(c), 5) AS total FROM m{k} WHERE i = j" for k in range(1, 6)))


@query("ml_pca_randomized", _power_sums_sql())
def ml_pca_randomized(spark, sf):
    """Power sums of the variances of all components of the scaled columns."""
    f = feat_once(spark, sf, list(FEAT_NUMERIC))
    model = randomized_pca.fit(f, FEAT_NUMERIC, k=len(FEAT_NUMERIC), scaled=True)
    values = F.array(*[F.lit(float(v)) for v in model.variances])
    return spark.range(1, 6).select(F.col("id").cast("int").alias("power"), F.round(F.aggregate(
        F.transform(values, lambda v: F.pow(v, F.col("id"))), F.lit(0.0), lambda a, x: a + x), 5).alias("total"))


@query("ml_pca_components_uncorrelated", f"""
SELECT 'pc1' AS a, 'pc2' AS b, count(*) AS n, CAST(0 AS DOUBLE) AS corr, true AS falling FROM embeddings""")
def ml_pca_components_uncorrelated(spark, sf):
    """Two leading components of the embeddings: uncorrelated, the first the
    wider."""
    e = materialize(read_table(spark, sf, "embeddings").select(
        *[F.col("embedding")[k].cast("double").alias(f"e{k}") for k in range(_WIDTH)]))
    rows = randomized_pca.fit(e, e.columns, k=2).transform(e)
    one = rows.agg(F.count(F.lit(1)).alias("n"), F.corr("pc1", "pc2").alias("r"),
                   (F.stddev("pc1") >= F.stddev("pc2")).alias("falling"))
    return one.select(F.lit("pc1").alias("a"), F.lit("pc2").alias("b"), "n", F.abs(F.round("r", 2)).alias("corr"), "falling")


# ----------------------------------------------------------- T-2..T-4 tables

#: Size of the lexicon table derived from the documents' words.  Scores are
#: multiples of 1/256, so that sums are exact in any order.
_LEXICON = 20_000


def _byte(h: str, at: int) -> str:
    digit = lambda k: f"(instr('0123456789abcdef', substr({h}, {k}, 1)) - 1)"
    return f"(16 * {digit(at)} + {digit(at + 1)})"


def lexicon_table(spark, sf):
    """Words of the documents with scores from their hash: a keyed table."""
    text = F.lower("text")
    words = read_table(spark, sf, "documents").select(F.explode(F.split(text, SE.TOKEN_SPLIT)).alias("word"))
    few = words.where("word <> ''").distinct().orderBy(F.md5("word"), "word").limit(_LEXICON)
    return materialize(few.select("word", F.expr(f"({_byte('md5(word)', 1)} - 128) / 128D").alias("polarity"),
                                  F.expr(f"{_byte('md5(word)', 3)} / 256D").alias("subjectivity")))


_LEXICON_SQL = with_ctes(
    f"c AS ({_CLEAN_SQL})", f"""
lex AS (SELECT word, CAST(({_byte('md5(word)', 1)} - 128) AS DOUBLE) / 128 AS polarity,
               CAST({_byte('md5(word)', 3)} AS DOUBLE) / 256 AS subjectivity
        FROM (SELECT DISTINCT unnest(regexp_split_to_array(lower(text), '[^a-z'']+')) AS word FROM documents)
        WHERE word <> '' ORDER BY md5(word), word LIMIT {_LEXICON})""",
    "r AS (SELECT row_number() OVER () AS id, word FROM c)",
    "t AS (SELECT id, unnest(regexp_split_to_array(lower(word), '[^a-z'']+')) AS tok FROM r)",
    """s AS (SELECT id, avg(polarity) AS polarity, avg(subjectivity) AS subjectivity FROM t JOIN lex ON lex.word = t.tok
         GROUP BY id)""", """
SELECT r.word, coalesce(s.polarity, 0) AS polarity, coalesce(s.subjectivity, 0) AS subjectivity
FROM r LEFT JOIN s ON s.id = r.id""")


@query("txt_lexicon_table", _LEXICON_SQL)
def txt_lexicon_table(spark, sf):
    """T-2..T-4 with 20,000 entries from a table, as a batch."""
    return J.scored_by_table(J.clean_words(framed_documents(spark, sf)), lexicon_table(spark, sf))


@query("stream_lexicon_table", _LEXICON_SQL)
def stream_lexicon_table(spark, sf):
    """The same on a stream: each micro-batch meets the table."""
    src, out, chk = (shared_path(spark, f"lexicon-{x}") for x in ("src", "out", "chk"))
    times = J.stage_lines(framed_documents(spark, sf), src, 3)
    J.run_idempotent(J.file_line_source(spark, src, max_files_per_trigger=2 * times), out, chk, query_name="lexicon",
                     trigger={"availableNow": True}, files=None, lexicon=lexicon_table(spark, sf)).awaitTermination()
    return spark.read.parquet(out).drop("batch_id")
