"""Queries for vectors, PCA, clustering, forests, detectors and stackers
(H6-H8, H12, M1-M9, M15-M17) and the chart series (G2-G5, G7).

Rows are split three ways by key hash: base models train on ``base``, stackers
on ``cv``, reports read ``test`` only.  Attribute ratios always come from the
unscaled base rows; scaled features use base statistics.  ``y`` (the planted
label) and ``category`` (normal, or one of three bands of planted rows) are what
the models learn.  Sizes are the reference's: k-means k=8, 25 init steps, up to
100 iterations; mixture k=8, 150 iterations; forests of 500 trees of depth 20,
the flags' forest 250 of depth 5.  ``forest`` arguments let tests use smaller
ones.  The scores of the five base models are computed once per session and
input and written to the shared folder; all stackers read them.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkwright.operators import attribute_ratio as AR
from sparkwright.operators import charts as G
from sparkwright.operators import evaluate as E
from sparkwright.operators import features as H
from sparkwright.operators import models as M
from sparkwright.operators import splits as S
from sparkwright.operators import votes as V
from sparkwright.operators.profile import cluster_profile
from sparkwright.operators.relational import union_all
from sparkwright.plans.q_features import ONE_HOT, _ar_sql, _hash_sql, _one_hot_sql, feat_ohe
from sparkwright.plans.q_profile import round_doubles
from sparkwright.plans.registry import query, with_ctes
from sparkwright.session import materialize
from sparkwright.sources.tables import FEAT_BINARY, FEAT_NUMERIC, FEAT_SQL, feat, read_table

SEED = 42
ALL_FEATURES = FEAT_NUMERIC + FEAT_BINARY + ONE_HOT
# The sizes of the reference pipeline.
KMEANS = {"k": 8, "max_iter": 100, "init_steps": 25, "seed": SEED}
GMM = {"k": 8, "max_iter": 150, "seed": SEED}
FOREST = {"num_trees": 500, "max_depth": 20, "seed": SEED}
FLAGS_FOREST = {"num_trees": 250, "max_depth": 5, "seed": SEED}
DEFAULT_FOREST = {"num_trees": 20, "max_depth": 5, "seed": SEED}
PARTS = {"base": 0.64, "cv": 0.16, "test": 0.2}
CATEGORY_CASE = """CASE WHEN planted = 0 THEN 'normal' WHEN total >= 400000 THEN 'A'
                       WHEN total >= 325000 THEN 'B' ELSE 'C' END"""
_GROUPS = {"A": ["A"], "B": ["B"], "C": ["C"]}
PROBS = ["p_km", "p_gm", "p_A", "p_B", "p_C"]
#: Detectors' probabilities, the flags of the five models, and the feature
#: stacker's flags (the sixth is the OR of the three detectors).
DETECTORS = ["p_A", "p_B", "p_C"]
MODEL_FLAGS = ["f_km", "f_gm", "f_A", "f_B", "f_C"]
FLAGS = [*MODEL_FLAGS, "f_sup"]
# Thresholds by model for the part the stackers learn from, and
# one for the part that is reported.
CV_THRESHOLDS = {"p_km": 0.5, "p_gm": 0.5, "p_A": 0.05, "p_B": 0.05, "p_C": 0.05}
TEST_THRESHOLD = 0.01
_LABELS = ["id", "part", "y", "planted", "category", "label2", "label_group"]


@dataclass
class Prepared:
    """All rows with scaled features, the unscaled base rows, and the ratios
    of the unscaled base rows."""
    scaled: DataFrame
    base_raw: DataFrame
    ratios: DataFrame

    def part(self, name: str) -> DataFrame:
        return self.scaled.where(F.col("part") == name)


_KEPT: dict[tuple, object] = {}


def _input_state(spark, sf) -> tuple:
    """Names, sizes and times of the files that ``feat`` reads."""
    conf, found = spark._jsc.hadoopConfiguration(), []
    for name in ("orders", "customer", "lineitem"):
        path = spark._jvm.org.apache.hadoop.fs.Path(f"{sf.rstrip('/')}/{name}.parquet")
        files = path.getFileSystem(conf).listFiles(path, True)
        while files.hasNext():
            f = files.next()
            found.append((f.getPath().toString(), f.getLen(), f.getModificationTime()))
    return tuple(sorted(found))


def _once(spark, sf, name, make):
    """What ``make`` returns, made once per application and state of the input:
    a table that is replaced at the same path is read anew."""
    key = (spark.sparkContext.applicationId, _input_state(spark, sf), name)
    if key not in _KEPT:
        _KEPT[key] = make()
    return _KEPT[key]


def split_rows(spark, sf):
    f = (feat_ohe(spark, sf).withColumn("y", F.col("planted")).withColumn("category", F.expr(CATEGORY_CASE)))
    parts = S.random_split(f, "id", list(PARTS.values()), SEED)
    return union_all([d.withColumn("part", F.lit(n)) for n, d in zip(PARTS, parts)])


def prepared(spark, sf) -> Prepared:
    def make():
        # Statistics, ratios and the iterative fits all read this table; an
        # explicit count by key keeps enough tasks for iterative fits.
        n = int(spark.conf.get("spark.sql.shuffle.partitions"))
        rows = materialize(split_rows(spark, sf).select(*_LABELS, *ALL_FEATURES).repartition(n, "id"))
        base = rows.where("part = 'base'")
        ratios = materialize(AR.attribute_ratio(base, FEAT_NUMERIC, FEAT_BINARY + ONE_HOT, "category"))
        return Prepared(H.standardize(rows, H.fit_standardizer(base, FEAT_NUMERIC), FEAT_NUMERIC), base, ratios)
    return _once(spark, sf, "prepared", make)


def _selected(ratios: DataFrame, least: float) -> list[str]:
    """Selected features in role order."""
    names = AR.selected_names(ratios, least)
    return [c for c in ALL_FEATURES if c in names]


# --------------------------------------------------------- split and features

FEAT_CAT_SQL = f"fo AS (SELECT *, {_one_hot_sql()}, {CATEGORY_CASE} AS category FROM feat)"
_BASE_END = S.hex_threshold(PARTS["base"])
_CV_END = S.hex_threshold(PARTS["base"] + PARTS["cv"])
_IN_BASE = f"{_hash_sql()} < '{_BASE_END}'"


@query("ml_split", with_ctes(FEAT_SQL, f"""
SELECT id, CASE WHEN {_hash_sql()} < '{_BASE_END}' THEN 'base' WHEN {_hash_sql()} < '{_CV_END}' THEN 'cv'
                ELSE 'test' END AS part FROM feat"""))
def ml_split(spark, sf):
    return split_rows(spark, sf).select("id", "part")


def detector_ratios(p: Prepared, members: list[str]) -> DataFrame:
    sub = p.base_raw.where(F.col("category").isin(*members, "normal"))
    return AR.attribute_ratio(sub, FEAT_NUMERIC, FEAT_BINARY + ONE_HOT, "category")


@query("ml_detector_features", with_ctes(FEAT_SQL, FEAT_CAT_SQL, "\nUNION ALL\n".join(
    f"""SELECT '{g}' AS detector, feature, ratio FROM (
{_ar_sql(FEAT_NUMERIC, FEAT_BINARY + ONE_HOT, "category", f"{_IN_BASE} AND category IN ('{g}', 'normal')")}
) WHERE ratio >= 0.05""" for g in _GROUPS)))
def ml_detector_features(spark, sf):
    p = prepared(spark, sf)
    return union_all([round_doubles(AR.select_features(detector_ratios(p, m), 0.05))
                      .select(F.lit(g).alias("detector"), "feature", "ratio") for g, m in _GROUPS.items()])


@query("ml_stack_features", with_ctes(FEAT_SQL, FEAT_CAT_SQL, f"""
SELECT feature, ratio FROM ({_ar_sql(FEAT_NUMERIC, FEAT_BINARY + ONE_HOT, "category", _IN_BASE)}) WHERE ratio >= 1.5"""))
def ml_stack_features(spark, sf):
    return round_doubles(AR.select_features(prepared(spark, sf).ratios, 1.5)).select("feature", "ratio")


# --------------------------------------------------------- vectors, PCA

_VECTOR = ["total", "qty", "acctbal", "has_return", "acct_negative", "status_F"]


def _slots(df: DataFrame, vec: str, n: int) -> DataFrame:
    a = vector_to_array(F.col(vec))
    return df.select("id", *[a[i].alias(f"v{i}") for i in range(n)])


def _raw_vectors(spark, sf):
    return M.assemble(feat_ohe(spark, sf).select("id", *_VECTOR), _VECTOR, "raw_features")


def _vector_sql(names: list[str]) -> str:
    return with_ctes(FEAT_SQL, "fo AS (SELECT *, " + _one_hot_sql() + " FROM feat)",
                     "SELECT id, " + ", ".join(f"CAST({c} AS DOUBLE) AS v{i}" for i, c in enumerate(names)) + " FROM fo")


@query("feat_assemble", _vector_sql(_VECTOR))
def feat_assemble(spark, sf):
    return _slots(_raw_vectors(spark, sf), "raw_features", len(_VECTOR))


# Two-valued slots are indexed 0 and 1, which are their values; the others stay.
@query("feat_vector_index", _vector_sql(_VECTOR))
def feat_vector_index(spark, sf):
    v = materialize(_raw_vectors(spark, sf))
    return _slots(M.fit_vector_indexer(v, "raw_features", "indexed").transform(v), "indexed", len(_VECTOR))


@query("feat_vector_slice", _vector_sql(["acctbal", "has_return"]))
def feat_vector_slice(spark, sf):
    return _slots(M.slice_vector(_raw_vectors(spark, sf), "raw_features", ["acctbal", "has_return"], "sliced"), "sliced", 2)


# The variances of two components are the eigenvalues of the covariance matrix.
@query("ml_pca_variance", with_ctes(FEAT_SQL, """
c AS (SELECT var_samp(qty) AS a, var_samp(n_lines) AS b, covar_samp(qty, n_lines) AS c FROM feat)""", """
SELECT round((a + b) / 2 + sqrt(((a - b) / 2) * ((a - b) / 2) + c * c), 4) AS var1,
       round((a + b) / 2 - sqrt(((a - b) / 2) * ((a - b) / 2) + c * c), 4) AS var2 FROM c"""))
def ml_pca_variance(spark, sf):
    v = materialize(M.assemble(feat(spark, sf).select("id", "qty", "n_lines"), ["qty", "n_lines"], "vec"))
    out = M.pca(v, v, "vec", 2)
    return out.agg(F.round(F.var_samp("pc1"), 4).alias("var1"), F.round(F.var_samp("pc2"), 4).alias("var2"))


def _pca_rows(spark, sf):
    """All rows with the two components fitted on the base part."""
    def make():
        p = prepared(spark, sf)
        rows = M.assemble(p.scaled, _selected(p.ratios, 0.05), "raw_features")
        return materialize(M.apply_pca(M.fit_pca(rows.where("part = 'base'"), "raw_features"), rows))
    return _once(spark, sf, "pca", make)


@query("ml_pca")
def ml_pca(spark, sf):
    return round_doubles(_pca_rows(spark, sf).select("id", "label2", "label_group", "pc1", "pc2"))


@query("chart_pca_scatter", with_ctes(FEAT_SQL, """
SELECT label_group, count(*) AS count FROM feat GROUP BY 1"""))
def chart_pca_scatter(spark, sf):
    """The grid of the PCA scatter holds every row of each label once."""
    grid = G.scatter_grid(_pca_rows(spark, sf), "pc1", "pc2", 20, by="label_group")
    return grid.groupBy("label_group").agg(F.sum("count").alias("count"))


@query("chart_pca_scatter_grid")
def chart_pca_scatter_grid(spark, sf):
    rows = _pca_rows(spark, sf)
    return round_doubles(union_all([
        G.scatter_grid(rows, "pc1", "pc2", 20, by=c).withColumnRenamed(c, "label").withColumn("labels", F.lit(c))
        for c in ("label2", "label_group")]))


# --------------------------------------------------------- clustering


def _kmeans(spark, sf):
    """(model, all rows with ``cluster``), fitted on the base part."""
    def make():
        p = prepared(spark, sf)
        nums = [c for c in FEAT_NUMERIC if c in AR.selected_names(p.ratios, 0.1)]
        rows = M.assemble(p.scaled, nums, "num_features")
        model, scored = M.kmeans(rows.where("part = 'base'"), rows, "num_features", **KMEANS)
        return model, materialize(scored)
    return _once(spark, sf, "kmeans", make)


@query("ml_kmeans")
def ml_kmeans(spark, sf):
    return _kmeans(spark, sf)[1].select("id", "label2", "cluster")


# Every row sits at its nearest fitted centre.
@query("ml_kmeans_nearest", with_ctes(FEAT_SQL, "SELECT count(*) AS rows, CAST(0 AS BIGINT) AS misplaced FROM feat"))
def ml_kmeans_nearest(spark, sf):
    model, rows = _kmeans(spark, sf)
    x = vector_to_array(F.col("num_features"))
    far = [F.aggregate(F.zip_with(x, F.array(*[F.lit(float(v)) for v in c]), lambda a, b: (a - b) * (a - b)),
                       F.lit(0.0), lambda s, d: s + d) for c in model.clusterCenters()]  # k centres
    d = F.array(*far)
    return rows.agg(F.count(F.lit(1)).alias("rows"),
                    F.count_if(F.element_at(d, F.col("cluster") + 1) > F.array_min(d) + 1e-9).alias("misplaced"))


def _gmm(spark, sf):
    def make():
        rows = _pca_rows(spark, sf)
        model, scored = M.gmm(rows.where("part = 'base'"), rows, "pca_features", **GMM)
        return model, materialize(scored)
    return _once(spark, sf, "gmm", make)


@query("ml_gmm")
def ml_gmm(spark, sf):
    p_max = F.array_max(vector_to_array(F.col("probability")))
    return round_doubles(_gmm(spark, sf)[1].select("id", "cluster", p_max.alias("p_max")))


@query("ml_gmm_params")
def ml_gmm_params(spark, sf):
    return round_doubles(M.gmm_params(_gmm(spark, sf)[0]))


@query("ml_gmm_covariances")
def ml_gmm_covariances(spark, sf):
    return round_doubles(M.gmm_covariances(_gmm(spark, sf)[0]))


# Weights sum to one, and the weighted component means are the mean of the rows
# that the mixture was fitted on (zero for centred components).
@query("ml_gmm_moments", """
SELECT CAST(1 AS DOUBLE) AS weight, CAST(0 AS DOUBLE) AS off_1, CAST(0 AS DOUBLE) AS off_2""")
def ml_gmm_moments(spark, sf):
    model, rows = _gmm(spark, sf)
    base = rows.where("part = 'base'").agg(F.avg("pc1").alias("m1"), F.avg("pc2").alias("m2")).first()
    p = M.gmm_params(model).groupBy("component").agg(
        F.first("weight").alias("w"), F.sum(F.when(F.col("dim") == 0, F.col("mean"))).alias("m1"),
        F.sum(F.when(F.col("dim") == 1, F.col("mean"))).alias("m2"))
    off = lambda i: F.abs(F.round(F.sum(F.col("w") * F.col(f"m{i}")) - F.lit(base[f"m{i}"]), 4))
    return p.agg(F.round(F.sum("w"), 6).alias("weight"), off(1).alias("off_1"), off(2).alias("off_2"))


# Rule clusters for the SQL-checked routing: orders banded by total price.
_BAND = 5000


@query("ml_cluster_routing", with_ctes(FEAT_SQL, f"""
p AS (SELECT CAST(floor(total / {_BAND}) AS INTEGER) AS cluster,
             count(*) FILTER (WHERE label2 = 'attack') AS attack,
             count(*) FILTER (WHERE label2 = 'normal') AS normal, count(*) AS count
      FROM feat GROUP BY 1)""", f"""
SELECT cluster, attack, normal, count,
       CASE WHEN count > {M.OUTLIER_ROWS} AND attack > 0 AND normal > 0 THEN 'model' ELSE 'constant' END AS route,
       CASE WHEN count > {M.OUTLIER_ROWS} AND attack > 0 AND normal > 0 THEN NULL
            WHEN count <= {M.OUTLIER_ROWS} THEN CAST(1 AS DOUBLE) WHEN normal = 0 THEN CAST(1 AS DOUBLE)
            ELSE CAST(0 AS DOUBLE) END AS score,
       CASE WHEN count > {M.OUTLIER_ROWS} AND attack > 0 AND normal > 0 THEN round(attack / count, 6) END AS attack_share
FROM p"""))
def ml_cluster_routing(spark, sf):
    f = feat(spark, sf).withColumn("band", F.floor(F.col("total") / _BAND).cast("int"))
    prof = cluster_profile(f, "band", "label2")
    return round_doubles(M.route_clusters(prof, "band_label2"))


# --------------------------------------------------------- base models


def _cluster_forest(spark, sf, clustered: DataFrame, forest: dict) -> DataFrame:
    """(id, cluster, p) of all rows: routing on the base part's profile, one
    forest per mixed cluster on the ratio-selected features, every row scored
    once (a cluster unseen in the base part -> 1.0)."""
    p = prepared(spark, sf)
    rows = M.assemble(clustered.select(*_LABELS, *ALL_FEATURES, "cluster"), _selected(p.ratios, 0.05), "features")
    base = rows.where("part = 'base'").withColumn(
        "attack_label", F.when(F.col("y") == 1.0, "attack").otherwise("normal"))
    routing = M.route_clusters(cluster_profile(base, "cluster", "attack_label"), "cluster_attack_label")
    forests = M.fit_cluster_forests(base, routing.collect(), "cluster", "features", "y", **forest)
    return M.score_clusters(rows, "id", "cluster", routing, forests)


def flagged(rows: DataFrame) -> DataFrame:
    """Scored rows with their flags and the detectors' and models' ORs."""
    test = F.col("part") == "test"
    rows = rows.withColumns({"f_" + c[2:]: F.when(test, V.threshold(c, TEST_THRESHOLD)).otherwise(V.threshold(c, e))
                             for c, e in CV_THRESHOLDS.items()})
    return rows.withColumns({"p_sup": V.mean_of(DETECTORS), "f_sup": V.any_flag(["f_A", "f_B", "f_C"]),
                             "f_any": V.any_flag(MODEL_FLAGS)})


def base_scores(spark, sf, forest: dict = FOREST) -> DataFrame:
    """Every row with the scores of the five base models and their flags; all
    models are fitted on the base part.  Flags go by the thresholds of the
    part (the base part has those of cv); ``p_sup`` and ``f_sup`` are mean and
    OR of the three detectors, ``f_any`` the OR of all five models."""
    def make():
        p = prepared(spark, sf)
        sets = {g: _selected(detector_ratios(p, m), 0.05) for g, m in _GROUPS.items()}
        rows = M.category_detectors(p.part("base"), p.scaled, "category", _GROUPS, sets, **forest)
        for name, clustered in (("p_km", _kmeans(spark, sf)[1]), ("p_gm", _gmm(spark, sf)[1])):
            own = _cluster_forest(spark, sf, clustered, forest)
            rows = rows.join(own.select("id", F.col("p").alias(name)), "id")
        return materialize(flagged(rows))
    return _once(spark, sf, f"scores-{sorted(forest.items())}", make)


def _checked(scores: DataFrame, probs: list[str]) -> DataFrame:
    ok = F.lit(True)
    for c in probs:
        ok = ok & F.col(c).between(0.0, 1.0)
    return scores.agg(F.count(F.lit(1)).alias("rows"), F.count_distinct("id").alias("ids"),
                      F.count_if(~F.coalesce(ok, F.lit(False))).alias("out_of_range"))


_SCORED_SQL = with_ctes(FEAT_SQL, "SELECT count(*) AS rows, count(DISTINCT id) AS ids, CAST(0 AS BIGINT) AS out_of_range FROM feat")


# Every id is scored exactly once by every base model, with a probability.
@query("ml_base_scores_once", _SCORED_SQL)
def ml_base_scores_once(spark, sf, forest: dict = FOREST):
    return _checked(base_scores(spark, sf, forest), PROBS)


@query("ml_cluster_forest")
def ml_cluster_forest(spark, sf, forest: dict = FOREST):
    return round_doubles(base_scores(spark, sf, forest).select("id", "part", F.col("p_km").alias("p")))


@query("ml_gmm_cluster_forest")
def ml_gmm_cluster_forest(spark, sf, forest: dict = FOREST):
    return round_doubles(base_scores(spark, sf, forest).select("id", "part", F.col("p_gm").alias("p")))


@query("ml_category_detectors")
def ml_category_detectors(spark, sf, forest: dict = FOREST):
    return round_doubles(base_scores(spark, sf, forest).select("id", "part", "p_A", "p_B", "p_C"))


# The weighted vote of all five models on the test part.
@query("ml_vote_five")
def ml_vote_five(spark, sf, forest: dict = FOREST):
    test = base_scores(spark, sf, forest).where("part = 'test'")
    vote = V.weighted_vote({"p_km": 3, "p_gm": 1, "p_A": 1, "p_B": 1, "p_C": 1})
    return round_doubles(E.threshold_report(test.withColumn("vote", vote), "y", "vote", 0.005))


def _forest_report(spark, sf, forest):
    p = prepared(spark, sf)
    base = M.assemble(p.part("base"), ALL_FEATURES)
    model = M.fit_forest(base, base.count(), features="features", label="y", **forest)
    return model.transform(M.assemble(p.part("test"), ALL_FEATURES).select("y", "features")).withColumn("p", M.p_positive())


@query("ml_random_forest")
def ml_random_forest(spark, sf, forest: dict = DEFAULT_FOREST):
    """The default-sized forest; report on the test part."""
    return round_doubles(E.threshold_report(_forest_report(spark, sf, forest), "y", "p", 0.5))


# A forest of the reference's size learns the planted threshold rule.
@query("ml_forest_agrees", with_ctes(FEAT_SQL, f"""
SELECT count(*) AS rows, true AS learned FROM feat WHERE {_hash_sql()} >= '{_CV_END}'"""))
def ml_forest_agrees(spark, sf, forest: dict = FOREST):
    scored = _forest_report(spark, sf, forest)
    same = F.count_if((F.col("p") >= 0.5) == (F.col("y") == 1.0))
    return scored.agg(F.count(F.lit(1)).alias("rows"), (same >= 0.95 * F.count(F.lit(1))).alias("learned"))


# --------------------------------------------------------- stackers


def _stack_parts(spark, sf, forest):
    """Fitted on cv, reported on test: neither was seen by a base model."""
    s = base_scores(spark, sf, forest)
    return s.where("part = 'cv'"), s.where("part = 'test'")


# No stacker row comes from base training, and every row has one part.
@query("ml_stack_rows", with_ctes(FEAT_SQL, f"""
SELECT count(*) FILTER ({_hash_sql()} >= '{_BASE_END}' AND {_hash_sql()} < '{_CV_END}') AS fitted,
       count(*) FILTER ({_hash_sql()} >= '{_CV_END}') AS reported FROM feat"""))
def ml_stack_rows(spark, sf, forest: dict = FOREST):
    cv, test = _stack_parts(spark, sf, forest)
    sides = union_all([cv.select("id", F.lit(1).alias("c")), test.select("id", F.lit(0).alias("c"))])
    return sides.agg(F.sum("c").alias("fitted"), F.sum(1 - F.col("c")).alias("reported"))


def _logistic(cv: DataFrame):
    weighted = V.class_weights(cv, "category", {"normal": 1.0, "A": 100.0, "B": 100.0, "C": 100.0}, "w")
    return weighted, M.stack_logistic(weighted, PROBS, "y", weight="w")


@query("ml_stack_logistic")
def ml_stack_logistic(spark, sf, forest: dict = FOREST):
    cv, test = _stack_parts(spark, sf, forest)
    scored = _logistic(cv)[1].transform(test).withColumn("p", M.p_positive())
    return round_doubles(E.threshold_report(scored, "y", "p", 0.01))


@query("ml_stack_flags_forest")
def ml_stack_flags_forest(spark, sf, forest: dict = FOREST, flags_forest: dict = FLAGS_FOREST):
    cv, test = _stack_parts(spark, sf, forest)
    m = M.stack_forest(cv, MODEL_FLAGS, "y", **flags_forest)
    return round_doubles(E.threshold_report(m.transform(test).withColumn("p", M.p_positive()), "y", "p", 0.01))


@query("ml_stack_features_forest")
def ml_stack_features_forest(spark, sf, forest: dict = FOREST):
    cv, test = _stack_parts(spark, sf, forest)
    strong = _selected(prepared(spark, sf).ratios, 1.5)
    m = M.stack_forest(cv, strong + FLAGS, "y", **forest)
    return round_doubles(E.threshold_report(m.transform(test).withColumn("p", M.p_positive()), "y", "p", 0.01))


# --------------------------------------------------------- ensembles


def _stacked_test(spark, sf, forest, flags_forest) -> DataFrame:
    """The test part with the probabilities and flags of both stackers."""
    def make():
        cv, test = _stack_parts(spark, sf, forest)
        first = _logistic(cv)[1].transform(test).withColumn("p_lr", M.p_positive())
        first = first.drop("features", "rawPrediction", "probability", "prediction")
        out = M.stack_forest(cv, MODEL_FLAGS, "y", **flags_forest).transform(first.select(
            *test.columns, "p_lr")).withColumn("p_rf", M.p_positive())
        return materialize(out.select(*test.columns, "p_lr", "p_rf", V.threshold("p_lr", TEST_THRESHOLD).alias("f_lr"),
                                      V.threshold("p_rf", TEST_THRESHOLD).alias("f_rf")))
    return _once(spark, sf, f"stacked-{sorted(forest.items())}-{sorted(flags_forest.items())}", make)


#: name -> (part, score of the library, the same in SQL, threshold or None for hard labels)
ENSEMBLES = {
    "best_single": ("test", F.col, "f_km", None),
    "detectors_mean_cv": ("cv", lambda _: V.mean_of(DETECTORS), "(p_A + p_B + p_C) / 3", 0.05),
    "detectors_or_cv": ("cv", lambda _: V.any_flag(["f_A", "f_B", "f_C"]), "greatest(f_A, f_B, f_C)", None),
    "detectors_mean": ("test", lambda _: V.mean_of(DETECTORS), "(p_A + p_B + p_C) / 3", 0.005),
    "detectors_or": ("test", lambda _: V.any_flag(["f_A", "f_B", "f_C"]), "greatest(f_A, f_B, f_C)", None),
    "vote_five": ("test", lambda _: V.weighted_vote({"p_km": 3, "p_gm": 1, "p_A": 1, "p_B": 1, "p_C": 1}),
                  "(3 * p_km + p_gm + p_A + p_B + p_C) / 7", 0.005),
    "vote_three": ("test", lambda _: V.weighted_vote({"p_km": 2, "p_gm": 1, "p_sup": 1}),
                   "(2 * p_km + p_gm + (p_A + p_B + p_C) / 3) / 4", 0.005),
    "models_or": ("test", lambda _: V.any_flag(["f_km", "f_gm", "f_sup"]), "greatest(f_km, f_gm, f_A, f_B, f_C)", None),
    "stackers_mean": ("test", lambda _: V.mean_of(["p_lr", "p_rf"]), "(p_lr + p_rf) / 2", 0.01),
    "stackers_or": ("test", lambda _: V.any_flag(["f_lr", "f_rf"]), "greatest(f_lr, f_rf)", None),
}


def _ensemble_rows(spark, sf, forest, flags_forest) -> dict[str, DataFrame]:
    cv, _ = _stack_parts(spark, sf, forest)
    return {"cv": cv, "test": _stacked_test(spark, sf, forest, flags_forest)}


def ensemble_reports(rows: dict[str, DataFrame]) -> DataFrame:
    """The report of every ensemble (ensemble, cells and metrics)."""
    out = []
    for name, (part, score, sql, e) in ENSEMBLES.items():
        scored = rows[part].withColumn("_score", score(sql))
        out.append(E.threshold_report(scored, "y", "_score", e).withColumn("ensemble", F.lit(name)))
    return union_all(out)


@query("ml_ensemble_reports")
def ml_ensemble_reports(spark, sf, forest: dict = FOREST, flags_forest: dict = FLAGS_FOREST):
    return round_doubles(ensemble_reports(_ensemble_rows(spark, sf, forest, flags_forest)))


# The cells of every report, counted again in SQL over the stored scores; the
# parts' sizes come from the given tables.
@query("ml_ensemble_cells", with_ctes(FEAT_SQL, "\nUNION ALL\n".join(
    f"SELECT '{name}' AS ensemble, count(*) AS rows, count(*) FILTER (WHERE planted = 1) AS positives, "
    f"CAST(0 AS BIGINT) AS differing_cells FROM feat WHERE "
    + (f"{_hash_sql()} >= '{_CV_END}'" if part == "test" else f"{_hash_sql()} >= '{_BASE_END}' AND {_hash_sql()} < '{_CV_END}'")
    for name, (part, *_) in ENSEMBLES.items())))
def ml_ensemble_cells(spark, sf, forest: dict = FOREST, flags_forest: dict = FLAGS_FOREST):
    rows = _ensemble_rows(spark, sf, forest, flags_forest)
    reports = materialize(ensemble_reports(rows).select("ensemble", "tn", "fp", "fn", "tp"))
    again = union_all([rows[part].selectExpr(
        f"'{name}' AS ensemble", "y", f"({sql}) {'>= ' + str(e) if e is not None else '= 1'} AS hit")
        for name, (part, _, sql, e) in ENSEMBLES.items()])
    again = again.groupBy("ensemble").agg(
        F.expr("count_if(y = 0 AND NOT hit) AS tn2"), F.expr("count_if(y = 0 AND hit) AS fp2"),
        F.expr("count_if(y = 1 AND NOT hit) AS fn2"), F.expr("count_if(y = 1 AND hit) AS tp2"))
    return reports.join(again, "ensemble").selectExpr(
        "ensemble", "tn + fp + fn + tp AS rows", "fn + tp AS positives",
        "cast(int(tn <> tn2) + int(fp <> fp2) + int(fn <> fn2) + int(tp <> tp2) AS bigint) AS differing_cells")


# Flags and their ORs, recomputed in SQL from the stored scores.
@query("ml_flags_agree", with_ctes(FEAT_SQL, f"""
SELECT CASE WHEN {_hash_sql()} < '{_BASE_END}' THEN 'base' WHEN {_hash_sql()} < '{_CV_END}' THEN 'cv' ELSE 'test' END AS part,
       count(*) AS rows, CAST(0 AS BIGINT) AS wrong_flags, CAST(0 AS BIGINT) AS wrong_ors FROM feat GROUP BY 1"""))
def ml_flags_agree(spark, sf, forest: dict = FOREST):
    wrong = " OR ".join(f"f_{c[2:]} <> CASE WHEN {c} >= CASE WHEN part = 'test' THEN {TEST_THRESHOLD} ELSE {e} END "
                        "THEN 1 ELSE 0 END" for c, e in CV_THRESHOLDS.items())
    ors = "f_sup <> greatest(f_A, f_B, f_C) OR f_any <> greatest(f_km, f_gm, f_sup)"
    return base_scores(spark, sf, forest).groupBy("part").agg(
        F.count(F.lit(1)).alias("rows"), F.expr(f"count_if({wrong}) AS wrong_flags"), F.expr(f"count_if({ors}) AS wrong_ors"))


# Each detector on the rows of its own category and the normal ones.
@query("ml_detector_reports", with_ctes(FEAT_SQL, f"""
f AS (SELECT *, {CATEGORY_CASE} AS category FROM feat WHERE {_hash_sql()} >= '{_BASE_END}')""", "\nUNION ALL\n".join(
    f"SELECT '{g}' AS detector, CASE WHEN {_hash_sql()} < '{_CV_END}' THEN 'cv' ELSE 'test' END AS part, "
    f"count(*) AS rows, count(*) FILTER (WHERE category = '{g}') AS positives, true AS learned "
    f"FROM f WHERE category IN ('{g}', 'normal') GROUP BY ALL" for g in _GROUPS)))
def ml_detector_reports(spark, sf, forest: dict = FOREST):
    """Rows and positives of each report, and whether the detector is right on
    at least nine rows in ten (its bands follow from one feature)."""
    scores, out = base_scores(spark, sf, forest), []
    for g in _GROUPS:
        for part in ("cv", "test"):
            own = scores.where((F.col("part") == part) & F.col("category").isin(g, "normal"))
            report = E.threshold_report(own.withColumn("_y", (F.col("category") == g).cast("double")), "_y", f"p_{g}", 0.5)
            out.append(report.select(F.lit(g).alias("detector"), F.lit(part).alias("part"),
                                     F.expr("tn + fp + fn + tp AS rows"), F.expr("fn + tp AS positives"),
                                     (F.col("accuracy") >= 0.9).alias("learned")))
    return union_all(out)


# Both forest stackers, the logistic one and the default forest do better on
# the test part than the more frequent class.
@query("ml_stackers_learn", with_ctes(FEAT_SQL, "\nUNION ALL\n".join(
    f"SELECT '{m}' AS model, count(*) AS rows, count(*) FILTER (WHERE planted = 1) AS positives, true AS learned "
    f"FROM feat WHERE {_hash_sql()} >= '{_CV_END}'" for m in ("logistic", "flags_forest", "features_forest", "default_forest"))))
def ml_stackers_learn(spark, sf, forest: dict = FOREST, flags_forest: dict = FLAGS_FOREST):
    stacked = _stacked_test(spark, sf, forest, flags_forest)
    cv, test = _stack_parts(spark, sf, forest)
    strong = M.stack_forest(cv, _selected(prepared(spark, sf).ratios, 1.5) + FLAGS, "y", **flags_forest)
    scored = {"logistic": (stacked, "p_lr"), "flags_forest": (stacked, "p_rf"),
              "features_forest": (strong.transform(test).withColumn("p", M.p_positive()), "p"),
              "default_forest": (_forest_report(spark, sf, DEFAULT_FOREST), "p")}
    out = []
    for name, (rows, p) in scored.items():
        # Class weights move the logistic scores, so the best cut of a sweep counts.
        sweep = E.threshold_sweep(rows, "y", p, [0.01, 0.05, 0.1, 0.25, 0.5, 0.75, 0.9, 0.95, 0.99])
        out.append(sweep.agg(F.first(F.expr("tn + fp + fn + tp")).alias("rows"), F.first(F.expr("fn + tp")).alias("positives"),
                             F.max(F.expr("(tn + tp) > greatest(tn + fp, fn + tp)")).alias("learned"))
                   .select(F.lit(name).alias("model"), "rows", "positives", "learned"))
    return union_all(out)


# The mixture's covariance, within and between its components, is the sample
# covariance of the rows it was fitted on.
@query("ml_gmm_covariance_total", with_ctes(FEAT_SQL, f"""
SELECT count(*) AS rows, CAST(0 AS DOUBLE) AS off_11, CAST(0 AS DOUBLE) AS off_12, CAST(0 AS DOUBLE) AS off_22
FROM feat WHERE {_hash_sql()} < '{_BASE_END}'"""))
def ml_gmm_covariance_total(spark, sf):
    model, rows = _gmm(spark, sf)
    base = rows.where("part = 'base'").agg(
        F.count(F.lit(1)).alias("rows"),
        *[F.covar_pop(f"pc{i}", f"pc{j}").alias(f"s{i}{j}") for i, j in ((1, 1), (1, 2), (2, 2))]).first()
    means = M.gmm_params(model).groupBy("component").agg(
        F.first("weight").alias("w"), F.sum(F.when(F.col("dim") == 0, F.col("mean"))).alias("c1"),
        F.sum(F.when(F.col("dim") == 1, F.col("mean"))).alias("c2"))
    cov = M.gmm_covariances(model).groupBy("component").agg(*[
        F.sum(F.when((F.col("i") == i - 1) & (F.col("j") == j - 1), F.col("cov"))).alias(f"v{i}{j}")
        for i, j in ((1, 1), (1, 2), (2, 2))])
    total = [F.sum(F.expr(f"w * (v{i}{j} + c{i} * c{j})")).alias(f"t{i}{j}") for i, j in ((1, 1), (1, 2), (2, 2))]
    mixed = means.join(cov, "component").agg(*total, F.sum(F.expr("w * c1")).alias("g1"), F.sum(F.expr("w * c2")).alias("g2"))
    off = [F.abs(F.round(F.expr(f"t{i}{j} - g{i} * g{j}") - F.lit(base[f"s{i}{j}"]), 2)).alias(f"off_{i}{j}")
           for i, j in ((1, 1), (1, 2), (2, 2))]
    return mixed.select(F.lit(base["rows"]).cast("bigint").alias("rows"), *off)


# The weighted logistic fit is at its optimum: the weighted residuals sum to
# zero, against the sum of the weights.
@query("ml_logistic_residuals", with_ctes(FEAT_SQL, f"""
SELECT count(*) AS rows, CAST(0 AS DOUBLE) AS residual FROM feat
WHERE {_hash_sql()} >= '{_BASE_END}' AND {_hash_sql()} < '{_CV_END}'"""))
def ml_logistic_residuals(spark, sf, forest: dict = FOREST):
    cv, _ = _stack_parts(spark, sf, forest)
    weighted, model = _logistic(cv)
    scored = model.transform(weighted).withColumn("p", M.p_positive())
    gap = F.sum(F.col("w") * (F.col("y") - F.col("p"))) / F.sum("w")
    return scored.agg(F.count(F.lit(1)).alias("rows"), F.abs(F.round(gap, 3)).alias("residual"))


# ------------------------------------------------------------- charts


@query("chart_scatter_grid", with_ctes(FEAT_SQL, """
r AS (SELECT min(total) AS x0, max(total) AS x1, min(acctbal) AS y0, max(acctbal) AS y1 FROM feat)""", """
b AS (SELECT least(CAST(floor((total - x0) * 20 / (x1 - x0)) AS BIGINT) + 1, 20) AS bin_x,
             least(CAST(floor((acctbal - y0) * 20 / (y1 - y0)) AS BIGINT) + 1, 20) AS bin_y, x0, x1, y0, y1
      FROM feat, r)""", """
SELECT CAST(bin_x AS INTEGER) AS bin_x, CAST(bin_y AS INTEGER) AS bin_y,
       round(x0 + (bin_x - 1) * ((x1 - x0) / 20), 6) AS x_lo,
       round(y0 + (bin_y - 1) * ((y1 - y0) / 20), 6) AS y_lo, count(*) AS count
FROM b GROUP BY ALL"""))
def chart_scatter_grid(spark, sf):
    return round_doubles(G.scatter_grid(feat(spark, sf), "total", "acctbal", 20))


@query("chart_line", """
SELECT strftime(o_orderdate, '%Y-%m') AS month, round(avg(o_totalprice), 6) AS y_mean, count(*) AS n
FROM orders GROUP BY 1""")
def chart_line(spark, sf):
    o = read_table(spark, sf, "orders").select(F.date_format("o_orderdate", "yyyy-MM").alias("month"), "o_totalprice")
    return round_doubles(G.line_series(o, "month", "o_totalprice"))


# Money is summed exactly (2-decimal amounts as decimals), then reported as double.
@query("chart_pie", """
SELECT l_returnflag, CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS total,
       round(CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE)
             / (SELECT CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) FROM lineitem), 6) AS share
FROM lineitem GROUP BY l_returnflag""")
def chart_pie(spark, sf):
    li = read_table(spark, sf, "lineitem").select("l_returnflag", F.col("l_extendedprice").cast("decimal(18,2)"))
    p = G.pie_series(li, "l_returnflag", "l_extendedprice")
    return p.select("l_returnflag", F.col("total").cast("double").alias("total"), F.round("share", 6).alias("share"))


@query("chart_bar", """
SELECT o_orderpriority, o_orderstatus, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total
FROM orders GROUP BY ALL""")
def chart_bar(spark, sf):
    o = read_table(spark, sf, "orders").select("o_orderpriority", "o_orderstatus",
                                                F.col("o_totalprice").cast("decimal(18,2)"))
    b = G.bar_series(o, "o_orderpriority", "o_totalprice", "o_orderstatus")
    return b.withColumn("total", F.col("total").cast("double"))
