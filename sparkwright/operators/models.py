"""Vectors and Spark ML models.

Labels are numeric with a fixed meaning (attack = 1.0), so the positive-class
probability is always ``probability[1]``; no per-model label indexer has to be
undone.  Fitted models are the only state that reaches the driver (large forests
stay in the shared folder, ``block_forest``); scores stay
in DataFrames and are attached by key.
"""

from __future__ import annotations

import math
import threading
import uuid
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager

import numpy as np
from pyspark import inheritable_thread_target
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression, RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.clustering import GaussianMixture, GaussianMixtureModel, KMeans
from pyspark.ml.feature import PCA, VectorAssembler, VectorIndexer, VectorSlicer
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkwright.functions.exprs import local_table
from sparkwright.operators.block_forest import BlockForestModel, fit_block_forest, with_probabilities
from sparkwright.operators.profile import cluster_profile
from sparkwright.operators.relational import union_all
from sparkwright.session import materialize

# ------------------------------------------------------------ H6 - H8


def assemble(df: DataFrame, cols: list[str], out: str = "features", handle_invalid: str = "error") -> DataFrame:
    """H6: columns -> one vector column."""
    return VectorAssembler(inputCols=cols, outputCol=out, handleInvalid=handle_invalid).transform(df)


def fit_vector_indexer(train: DataFrame, in_col: str, out: str, max_categories: int = 2,
                       handle_invalid: str = "keep"):
    """H7: treat vector slots with <= max_categories values as categorical."""
    return VectorIndexer(inputCol=in_col, outputCol=out, maxCategories=max_categories,
                         handleInvalid=handle_invalid).fit(train)


def slice_vector(df: DataFrame, in_col: str, names: list[str], out: str) -> DataFrame:
    """H8: keep the named slots (names come from the assembler's metadata)."""
    return VectorSlicer(inputCol=in_col, outputCol=out, names=names).transform(df)


def p_positive(col: str = "probability", index: int = 1):
    """one slot of a probability vector, natively (no Python UDF)."""
    return vector_to_array(F.col(col))[index]


# --------------------------------------------------------------- H12


def fit_pca(train: DataFrame, vec: str, k: int = 2):
    """PCA fitted on ``train``; ``apply_pca`` uses it on any rows."""
    return PCA(k=k, inputCol=vec, outputCol="_pca").fit(train)


def apply_pca(model, df: DataFrame, prefix: str = "pc") -> DataFrame:
    """Adds pc1..pck (doubles) and the vector ``pca_features`` of the same
    values; each component's sign is fixed so that its largest-magnitude loading
    is positive (deterministic output)."""
    loadings = model.pc.toArray()                  # d x k (small)
    k = loadings.shape[1]
    signs = [1.0 if loadings[abs(loadings[:, j]).argmax(), j] >= 0 else -1.0 for j in range(k)]
    arr = vector_to_array(F.col("_pca"))
    out = model.transform(df).withColumns({f"{prefix}{j + 1}": arr[j] * F.lit(signs[j]) for j in range(k)})
    return out.withColumn("pca_features", array_to_vector(F.array(*[F.col(f"{prefix}{j + 1}") for j in range(k)]))).drop("_pca")


def pca(train: DataFrame, df: DataFrame, vec: str, k: int = 2, prefix: str = "pc") -> DataFrame:
    """Fit on ``train``, apply to ``df``."""
    return apply_pca(fit_pca(train, vec, k), df, prefix)


# --------------------------------------------------------- M1 - M3


def kmeans(train: DataFrame, df: DataFrame, vec: str, k: int = 8, seed: int = 42, max_iter: int = 100,
           init_steps: int = 25, out: str = "cluster") -> tuple[object, DataFrame]:
    """M1: k-means fitted on ``train``, applied to ``df``."""
    model = KMeans(k=k, seed=seed, maxIter=max_iter, initSteps=init_steps, featuresCol=vec,
                   predictionCol=out).fit(train)
    return model, model.transform(df)


def gmm(train: DataFrame, df: DataFrame, vec: str, k: int = 8, seed: int = 42, max_iter: int = 150,
        out: str = "cluster") -> tuple[object, DataFrame]:
    """M2: Gaussian mixture with soft probabilities (``probability`` vector).
    Spark's estimator draws the start; its iterations are sums over
    cached blocks of rows (``_expectation``), up to ``max_iter`` or until
    the likelihood changes by no more than the estimator's tolerance."""
    est = GaussianMixture(k=k, seed=seed, maxIter=0, featuresCol=vec, predictionCol=out, probabilityCol="probability")
    start = est.fit(train)
    weights = np.array(start.weights)
    found = start.gaussiansDF.collect()
    means, covs = np.array([g["mean"].toArray() for g in found]), np.array([g["cov"].toArray() for g in found])
    x, d = vector_to_array(F.col(vec)), means.shape[1]
    blocks = train.select(*[x[i].alias(f"x{i}") for i in range(d)]).mapInArrow(_blocks(), "block binary").persist()
    try:
        before, now, step = 0.0, -np.finfo(float).max, 0
        while step < max_iter and abs(now - before) > est.getTol():
            task = _expectation(weights, means, *_density_constants(covs))
            found = np.sum([r["sums"] for r in blocks.mapInArrow(task, "sums array<double>").collect()], axis=0)
            sums, before, now, step = found[1:].reshape(k, -1), now, found[0], step + 1
            own = sums[:, 0]
            means = sums[:, 1:1 + d] / own[:, None]
            covs = sums[:, 1 + d:].reshape(k, d, d) / own[:, None, None] - means[:, :, None] * means[:, None, :]
            weights = own / own.sum()
    finally:
        blocks.unpersist()
    model = _mixture_model(train.sparkSession, weights, means, covs)
    model.setFeaturesCol(vec).setPredictionCol(out).setProbabilityCol("probability")
    return model, model.transform(df)


def _density_constants(covs):
    """(roots, heights) of the components: a log density is height - |root (x - mean)|^2 / 2,
    with the pseudo-inverse where a covariance is singular."""
    roots, heights = [], []
    for cov in covs:
        values, vectors = np.linalg.eigh(cov)
        real = values > np.finfo(float).eps * values.max() * len(values)
        if not real.any():
            raise ValueError("Covariance matrix has no non-zero singular values")
        scale = np.where(real, 1.0 / np.sqrt(np.where(real, values, 1.0)), 0.0)
        roots.append(scale[:, None] * vectors.T)
        heights.append(-0.5 * (len(values) * np.log(2 * np.pi) + np.log(values[real]).sum()))
    return np.array(roots), np.array(heights)


def _blocks():
    """A task that packs an Arrow batch of d columns into one binary value, d x rows doubles."""
    def task(batches):
        import numpy as np
        import pyarrow as pa
        for batch in batches:
            x = np.array([c.to_numpy(zero_copy_only=False) for c in batch.columns], dtype=float)
            yield pa.RecordBatch.from_arrays([pa.array([x.tobytes()], pa.binary())], ["block"])
    return task


def _expectation(weights, means, roots, heights):
    """A task's sums over its blocks: log likelihood, and per component the
    shares, shares times x, and shares times x x'."""
    def task(batches):
        import numpy as np
        import pyarrow as pa
        k, d = means.shape
        flat = roots.reshape(k * d, d)
        centre = np.einsum("kij,kj->ki", roots, means).reshape(k * d, 1)
        like, sums = 0.0, np.zeros((k, 1 + d + d * d))
        for batch in batches:
            for block in batch.column(0):
                x = np.frombuffer(block.as_buffer()).reshape(d, -1)
                y = flat @ x
                y -= centre
                y *= y
                share = y.reshape(k, d, -1).sum(axis=1)
                share *= -0.5
                share += heights[:, None]
                np.exp(share, out=share)
                share *= weights[:, None]
                share += np.finfo(float).eps
                total = share.sum(axis=0)
                like += np.log(total).sum()
                share /= total
                terms = np.concatenate([np.ones((1, x.shape[1])), x, *(x[i] * x for i in range(d))])
                sums += share @ terms.T
        yield pa.RecordBatch.from_arrays([pa.array([[like, *sums.ravel()]], pa.list_(pa.float64()))], ["sums"])
    return task


def _mixture_model(spark: SparkSession, weights, means, covs) -> GaussianMixtureModel:
    """Spark's model of the given parameters."""
    jvm, array = spark._jvm, spark.sparkContext._gateway.new_array
    ml = jvm.org.apache.spark.ml

    def doubles(values):
        out = array(jvm.double, len(values))
        for i, v in enumerate(values):
            out[i] = float(v)
        return out
    gaussian, d = ml.stat.distribution.MultivariateGaussian, means.shape[1]
    parts = array(gaussian, len(weights))
    for i, (m, c) in enumerate(zip(means, covs)):
        parts[i] = gaussian(ml.linalg.DenseVector(doubles(m)), ml.linalg.DenseMatrix(d, d, doubles(c.ravel())))
    return GaussianMixtureModel(ml.clustering.GaussianMixtureModel(f"GaussianMixture_{uuid.uuid4().hex[:12]}", doubles(weights), parts))


def gmm_params(model) -> DataFrame:
    """M3: (component, dim, mean, variance, weight) per component and
    dimension; the parameters are k x d numbers of the fitted model."""
    rows = []
    for comp, (r, w) in enumerate(zip(model.gaussiansDF.collect(), model.weights)):
        cov = r["cov"].toArray()
        for d, m in enumerate(r["mean"].toArray()):
            rows.append((comp, d, float(m), float(cov[d, d]), float(w)))
    spark = model.gaussiansDF.sparkSession
    return local_table(spark, rows, "component int, dim int, mean double, variance double, weight double")


def gmm_covariances(model) -> DataFrame:
    """M3: (component, i, j, cov), the full covariance of every component."""
    rows = []
    for comp, r in enumerate(model.gaussiansDF.collect()):
        cov = r["cov"].toArray()
        rows += [(comp, i, j, float(cov[i, j])) for i in range(len(cov)) for j in range(len(cov))]
    return local_table(model.gaussiansDF.sparkSession, rows, "component int, i int, j int, cov double")


# --------------------------------------------------------- M4 - M6

# Fixed value: clusters with at most this many rows are treated as outliers.
OUTLIER_ROWS = 25


def route_clusters(profile: DataFrame, cluster_col: str, min_rows: int = OUTLIER_ROWS) -> DataFrame:
    """M4: per cluster ``route`` = 'model' when mixed and larger than
    ``min_rows`` (with its attack share), else 'constant' with score 1.0
    (small or no normals) or 0.0 (no attacks)."""
    n, a, m = F.col("count"), F.col("attack"), F.col("normal")
    model = (n > min_rows) & (a > 0) & (m > 0)
    const = F.when(n <= min_rows, 1.0).when(m == 0, 1.0).otherwise(0.0)
    return profile.select(
        F.col(cluster_col).alias("cluster"), "attack", "normal", "count",
        F.when(model, "model").otherwise("constant").alias("route"),
        F.when(model, F.lit(None).cast("double")).otherwise(const).alias("score"),
        F.when(model, a / n).alias("attack_share"))


class _NoSummary:
    """Models without a training summary: that holds the session, and scoring
    sends the model to the tasks, which fails once the session has an
    ``Observation`` (Spark 4.1)."""

    def _create_model(self, java_model):
        java_model.setSummary(SparkSession.active()._jvm.scala.Option.empty())
        return super()._create_model(java_model)


class Forest(_NoSummary, RandomForestClassifier):
    pass


class Logistic(_NoSummary, LogisticRegression):
    pass


def random_forest(num_trees: int = 20, max_depth: int = 5, seed: int = 42, features: str = "features",
                  label: str = "label", subset: str = "sqrt", weight: str | None = None) -> RandomForestClassifier:
    """M7/M8: the forest (reference sizes: 500 trees, depth 20)."""
    # Deep forests: rows remember their nodes instead of walking every tree
    # again in each pass.
    rf = Forest(numTrees=num_trees, maxDepth=max_depth, seed=seed, featuresCol=features, labelCol=label,
                featureSubsetStrategy=subset, cacheNodeIds=True)
    if weight:
        rf.setWeightCol(weight)
    return rf


#: Model fits that run at the same time, at most.
FITS_AT_ONCE = 8
#: Bytes of the driver's heap per node of a forest that is being grown.
NODE_BYTES = 320
#: Bytes of a partition of a fit, and of its row besides what its trees take.
FIT_BYTES = 256_000_000
ROW_BYTES = 200
#: Partitions of a fit per core, at most, and trees of a fit that keeps to it,
#: at least: each pass sends the sums of every node once per partition.
PARTS_PER_CORE = 2
LEAST_TREES = 25
#: Rows times trees from which a forest is grown on blocks of rows
#: (``block_forest``); Spark's estimator looks each of them up in each pass.
BLOCK_CELLS = 10_000_000
#: Forests on blocks that are grown at the same time, at most: each fills the executors, and
#: each level's splits and jobs pass through the driver.
BLOCK_FITS = 2
#: Trees that tell a forest's nodes beforehand (trees differ by chance only).
PILOT_TREES = 8
PILOT_MARGIN = 1.5


class Admission:
    """Lets fits run side by side as long as their estimated memory together
    stays within ``budget``; one that is larger runs alone."""

    def __init__(self, budget: float):
        self.budget, self.used, self.running = budget, 0.0, 0
        self.free = threading.Condition()

    @contextmanager
    def room(self, cost: float):
        with self.free:
            self.free.wait_for(lambda: not self.running or self.used + cost <= self.budget)
            self.used, self.running = self.used + cost, self.running + 1
        try:
            yield
        finally:
            with self.free:
                self.used, self.running = self.used - cost, self.running - 1
                self.free.notify_all()


def forest_bytes(rows: int, num_trees: int = 20, max_depth: int = 5, **_) -> int:
    """What a forest on so many rows may hold on the driver while it grows: a
    tree has no more nodes than twice its rows, or than its depth allows."""
    return num_trees * min(2 * max(rows, 1), 2 << max_depth) * NODE_BYTES


def on_blocks(count: int, num_trees: int = 20, **rf_args) -> bool:
    return count * num_trees >= BLOCK_CELLS and not rf_args.keys() - {"max_depth", "features", "label", "seed"}


def _budget(spark: SparkSession) -> float:
    return spark._jvm.java.lang.Runtime.getRuntime().maxMemory() / 2


def _jobs(spark: SparkSession, counts: dict, **rf_args) -> tuple[list, set]:
    """(jobs for ``_side_by_side``, names of those without a pilot).  Forests on blocks don't
    live in the driver's heap; ``BLOCK_FITS`` of them share its budget."""
    sure = {name for name, n in counts.items() if on_blocks(n, **rf_args)}
    own = _budget(spark) / BLOCK_FITS if sure else 0
    return [(name, own if name in sure else forest_bytes(n, **rf_args)) for name, n in counts.items()], sure


def spread(rows: DataFrame, count: int, num_trees: int = 20, **_) -> DataFrame:
    """``rows`` (``count`` of them) in enough partitions that what a forest
    keeps of one, with a weight and a node per row and tree, stays within
    ``FIT_BYTES``; unchanged if there are enough."""
    parts = math.ceil(count * (12 * num_trees + ROW_BYTES) / FIT_BYTES)
    return rows.repartition(parts) if parts > rows.rdd.getNumPartitions() else rows


def tree_batches(count: int, num_trees: int, cores: int) -> list[int]:
    """Trees of the fits that make up a forest on ``count`` rows: one fit, or as
    many as keep the partitions that ``spread`` makes within ``PARTS_PER_CORE``."""
    most = (PARTS_PER_CORE * cores * FIT_BYTES / max(count, 1) - ROW_BYTES) / 12
    n = math.ceil(num_trees / max(most, min(LEAST_TREES, num_trees)))
    return [num_trees // n + (i < num_trees % n) for i in range(n)]


def fit_forest(rows: DataFrame, count: int, num_trees: int = 20, seed: int = 42, **rf_args) -> RandomForestClassificationModel | BlockForestModel:
    """A forest on all ``rows`` (``count`` of them).  Its trees are independent, so
    a forest that needs many partitions is fitted in batches of trees, each with
    a seed of its own, and the model holds the trees of all.  One of many rows and
    trees is grown on blocks of rows, without a look-up per row, tree and pass."""
    if on_blocks(count, num_trees, **rf_args):
        return fit_block_forest(rows, count, num_trees=num_trees, seed=seed, **rf_args)
    sizes = tree_batches(count, num_trees, rows.sparkSession.sparkContext.defaultParallelism)
    fits = [random_forest(num_trees=n, seed=seed + i, **rf_args).fit(spread(rows, count, num_trees=n))
            for i, n in enumerate(sizes)]
    return fits[0] if len(fits) == 1 else _one_forest(rows.sparkSession, fits)


def _one_forest(spark: SparkSession, fits: list) -> RandomForestClassificationModel:
    """Spark's model of the trees of several forests on the same rows."""
    classes = spark._jvm.org.apache.spark.ml.classification
    trees = [t for m in fits for t in m._java_obj.trees()]
    array = spark.sparkContext._gateway.new_array(classes.DecisionTreeClassificationModel, len(trees))
    for i, t in enumerate(trees):
        array[i] = t
    java = classes.RandomForestClassificationModel(
        f"RandomForest_{uuid.uuid4().hex[:12]}", array, fits[0].numFeatures, fits[0].numClasses)
    java.set(java.numTrees(), len(trees))
    return RandomForestClassificationModel(java).setFeaturesCol(fits[0].getFeaturesCol())


def pilot_bytes(fit, num_trees: int = 20, sure: set = frozenset(), **rf_args):
    """``pilot(arg)`` for ``_side_by_side``: a forest's bytes by the nodes of
    ``PILOT_TREES`` trees on the same rows, with ``PILOT_MARGIN`` to spare, and
    the bytes that the pilot itself may hold as a share of the forest's bound.
    ``fit(arg, **sizes)`` returns the forest's model; jobs in ``sure`` keep their bytes."""
    few = min(PILOT_TREES, num_trees)

    def run(arg):
        if arg in sure:
            return math.inf
        nodes = fit(arg, **rf_args | {"num_trees": few}).totalNumNodes
        return PILOT_MARGIN * nodes / few * num_trees * NODE_BYTES
    return run, few / num_trees


def _side_by_side(spark: SparkSession, fit, jobs: list[tuple], budget: float | None = None, pilot: tuple | None = None) -> list:
    """Results of ``fit(arg)`` for jobs (arg, bytes), in order.  Each fit has a
    thread with the caller's local properties and a scheduler pool of its own
    (in FAIR mode the pools share the executors); half of the driver's heap
    bounds what runs together.  The bytes are a bound; where the bounds leave
    no room for all, ``pilot`` (``pilot_bytes``) says what a job needs."""
    budget = budget or _budget(spark)
    if pilot and len(jobs) > 1 and sum(c for _, c in jobs) > budget:
        need, share = pilot
        found = _side_by_side(spark, need, [(arg, share * cost) for arg, cost in jobs], budget)
        jobs = [(arg, min(cost, n)) for (arg, cost), n in zip(jobs, found)]
    gate = Admission(budget)

    def run(job, pool):
        arg, cost = job
        with gate.room(cost):
            spark.sparkContext.setLocalProperty("spark.scheduler.pool", pool)
            return fit(arg)

    with ThreadPoolExecutor(max(1, min(FITS_AT_ONCE, len(jobs)))) as pool:
        tasks = [pool.submit(inheritable_thread_target(spark)(run), job, f"fit-{i}") for i, job in enumerate(jobs)]
        return [t.result() for t in tasks]


def fit_cluster_forests(train: DataFrame, routing_rows: list, cluster_col: str, features: str, label: str,
                        **rf_args) -> dict:
    """M5: one forest per mixed cluster (at most k); each fit is a distributed
    Spark job, and independent fits run side by side."""
    own = [r for r in routing_rows if r["route"] == "model"]
    counts = {r["cluster"]: r["count"] for r in own}

    def fit(cluster, **sizes):
        part = train.where(F.col(cluster_col) == cluster).drop("probability", "rawPrediction", "prediction")
        return fit_forest(part, counts[cluster], features=features, label=label, **rf_args | sizes)
    jobs, sure = _jobs(train.sparkSession, counts, **rf_args)
    return dict(zip(counts, _side_by_side(train.sparkSession, fit, jobs, pilot=pilot_bytes(fit, sure=sure, **rf_args))))


def score_clusters(df: DataFrame, key: str, cluster_col: str, routing: DataFrame, models: dict,
                   features: str = "features", default: float = 1.0) -> DataFrame:
    """M6: (key, cluster, p): constant clusters by a join with the routing
    table, model clusters by their forest's P(attack), clusters unseen in
    training get ``default``.  Every row is scored exactly once.  With forests
    the input is read once per model cluster, so it is materialised first (one
    write to the shared checkpoint folder instead of k recomputations)."""
    if models:
        df = materialize(df.select(key, cluster_col, features))
    base = df.select(key, cluster_col)
    consts = routing.where(F.col("route") == "constant").select(F.col("cluster").alias(cluster_col), "score")
    const_part = (base.where(~F.col(cluster_col).isin(list(models)) if models else F.lit(True))
                  .join(F.broadcast(consts), cluster_col, "left")
                  .select(key, cluster_col, F.coalesce("score", F.lit(default)).alias("p")))
    parts = [const_part]
    for c, m in models.items():
        sub = df.where(F.col(cluster_col) == c).select(key, cluster_col, features)
        parts.append(m.transform(sub).select(key, cluster_col, p_positive().alias("p")))
    return union_all(parts)


# --------------------------------------------------------------- M9


def category_detectors(train: DataFrame, df: DataFrame, label5: str, groups: dict[str, list],
                       feature_sets: dict[str, list[str]], normal: str = "normal", **rf_args) -> DataFrame:
    """M9: ``df`` with a column ``p_<name>`` per category: one forest per
    category vs normal, each on its own features, fitted on the category's rows.  Scoring chains the fitted models over ``df``
    in a single pass (each adds its ``p_<name>`` column, its temporary columns
    are dropped; forests on blocks score together), so no score table is joined back and nothing is shuffled."""
    def fit(name, **sizes):
        sub = train.where(F.col(label5).isin(*groups[name], normal))
        sub = sub.withColumn("_y", F.when(F.col(label5) == normal, 0.0).otherwise(1.0))
        vectors = VectorAssembler(inputCols=feature_sets[name], outputCol="_f")
        return PipelineModel([vectors, fit_forest(vectors.transform(sub), counts[name], features="_f", label="_y",
                                                  **rf_args | sizes)])

    found = train.select(*[F.count_if(F.col(label5).isin(*groups[g], normal)).alias(f"n{i}")
                           for i, g in enumerate(groups)]).first() if groups else []
    counts = dict(zip(groups, found))
    jobs, sure = _jobs(train.sparkSession, counts, **rf_args)
    scored, together = df, []
    pilot = pilot_bytes(lambda name, **sizes: fit(name, **sizes).stages[-1], sure=sure, **rf_args)
    for name, m in zip(groups, _side_by_side(train.sparkSession, fit, jobs, pilot=pilot)):
        if isinstance(m.stages[-1], BlockForestModel):
            together.append((m.stages[-1], m.stages[0], f"p_{name}"))
            continue
        scored = (m.transform(scored).withColumn(f"p_{name}", p_positive())
                  .drop("_f", "rawPrediction", "probability", "prediction"))
    if together:
        for i, (_, vectors, _) in enumerate(together):
            scored = vectors.transform(scored).withColumnRenamed("_f", f"_f{i}")
        names = [f"_f{i}" for i in range(len(together))]
        scored = with_probabilities(scored, [(m, f, p) for (m, _, p), f in zip(together, names)], spare=names)
        scored = scored.withColumns({p: F.col(p)[1] for _, _, p in together})
        scored = scored.select(*[c for c in scored.columns if c not in {f"p_{g}" for g in groups}], *[f"p_{g}" for g in groups])
    return scored


# --------------------------------------------------------- M15 - M17


def stack_logistic(train: DataFrame, inputs: list[str], label: str, weight: str | None = None,
                   max_iter: int = 100):
    """Weighted logistic regression over model probabilities."""
    lr = Logistic(featuresCol="_sf", labelCol=label, maxIter=max_iter, standardization=False)
    if weight:
        lr.setWeightCol(weight)
    return Pipeline(stages=[VectorAssembler(inputCols=inputs, outputCol="_sf"), lr]).fit(train)


def stack_forest(train: DataFrame, inputs: list[str], label: str, index_flags: bool = True, **rf_args):
    """Forest over model flags (and strong features); flags are
    indexed as categorical (<= 2 values) and the forest trains on the
    indexed vector."""
    stages = [VectorAssembler(inputCols=inputs, outputCol="_raw")]
    feat_col = "_raw"
    if index_flags:
        stages.append(VectorIndexer(inputCol="_raw", outputCol="_idx", maxCategories=2, handleInvalid="keep"))
        feat_col = "_idx"
    before = Pipeline(stages=stages).fit(train)
    forest = fit_forest(before.transform(train), train.count(), features=feat_col, label=label, **rf_args)
    return PipelineModel([*before.stages, forest])


__all__ = ["assemble", "fit_vector_indexer", "slice_vector", "pca", "kmeans", "gmm", "gmm_params",
           "route_clusters", "random_forest", "fit_cluster_forests", "score_clusters", "category_detectors",
           "stack_logistic", "stack_forest", "p_positive", "cluster_profile",
           "fit_pca", "apply_pca", "gmm_covariances"]
