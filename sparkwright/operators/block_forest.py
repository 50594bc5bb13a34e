"""M5, M7-M9: a classification forest of many rows and trees, grown level by level.

The same forest as Spark's estimator grows (bins from a sample of at least
10,000 rows, at most 32 a feature; Poisson weights per tree; sqrt of the features per
node; Gini gain; subtrees of one prediction merged), with draws of its own.
Rows are kept as blocks of binned features, each with the rows
of every tree that are still in a node to split: a pass takes rows that have
reached a leaf no further, where the estimator looks up a node for every row and tree.
A pass is one job: blocks move their rows down a level and count classes per
node, feature and bin; the counts meet per tree, whose best splits stay on the
executors.  The driver passes on a few bytes of each node of a level; finished trees lie in the
shared folder, and rows are scored by slices of them, so no forest is held by the driver.
"""

from __future__ import annotations

import gc
import json
import math
import uuid

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.ml import Model
from pyspark.ml.classification import RandomForestClassificationModel
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, StructType

from sparkwright.session import shared_path

#: Bins of a feature and rows they are drawn from, at least (the estimator's).
BINS = 32
SAMPLE_ROWS = 10_000
#: Rows times trees of a partition, about, and partitions a core in one batch of trees.
PART_CELLS = 8_000_000
PARTS_PER_CORE = 4
#: Trees of one record of a block, and of a batch at least.
RECORD_TREES = 25
#: Nodes of a tree whose splits are looked at together.
NODES_AT_ONCE = 2048
#: Bytes of the trees that are sent to the tasks at once, and that a task keeps.
SLICE_BYTES = 8_000_000
HELD_BYTES = 64_000_000
#: Rows that are scored at once, and if their task can't keep the trees.
ROWS_AT_ONCE = 65_536
MORE_ROWS = 262_144
#: A forest's trees in the shared folder; the nodes' values as bytes, level by level.
TREES = "tree int, nodes int, feature binary, cut binary, kid binary, gain binary, classes binary"


def bin_edges(values: np.ndarray, bins: int = BINS) -> np.ndarray:
    """Thresholds between the bins of a feature: all midpoints of its values
    if few, else midpoints nearest to equal counts (the estimator's rule)."""
    found, n = np.unique(values, return_counts=True)
    middle = (found[:-1] + found[1:]) / 2
    if len(middle) < bins:
        return middle
    stride, ends, edges, target = n.sum() / bins, np.cumsum(n), [], n.sum() / bins
    for i in range(1, len(found)):
        if abs(ends[i - 1] - target) < abs(ends[i] - target):
            edges.append(middle[i - 1])
            target += stride
    return np.array(edges[:bins - 1])


def _bins(edges: list):
    """A task that packs its rows into one block, features and label by rows, as bytes."""
    def task(batches):
        import numpy as np
        import pyarrow as pa
        found = []
        for batch in batches:
            if batch.num_rows:
                x = batch.column(0).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
                found.append(np.stack([np.searchsorted(e, x[:, i]) for i, e in enumerate(edges)]
                                      + [batch.column(1).to_numpy(zero_copy_only=False)]).astype(np.uint8))
        if found:
            yield pa.RecordBatch.from_arrays([pa.array([np.concatenate(found, axis=1).tobytes()], pa.binary())], ["block"])
    return task


def _roots(chunks: list, height: int, seed: int):
    """A task that draws each tree's weights: per chunk of trees, the block and
    the (rows, nodes, weights) of every tree."""
    # P(a weight is at most k), Poisson with mean 1.
    below = np.cumsum([math.exp(-1) / math.factorial(k) for k in range(11)]).astype(np.float32)

    def task(part, blocks):
        for record in blocks:
            block = np.frombuffer(record["block"], np.uint8).reshape(height, -1)
            for c, trees in enumerate(chunks):
                kept = []
                for t in trees:
                    drawn = np.random.default_rng([seed, t, part]).random(block.shape[1], np.float32)
                    w = np.searchsorted(below, drawn, "right").astype(np.uint8)
                    rows = np.flatnonzero(w)
                    kept.append((rows.astype(np.uint32), np.zeros(len(rows), np.uint32), w[rows]))
                yield None, (c, block, kept)
    return task


def _drawing(seed: int, wide: int, own: int):
    """The features drawn for the nodes of a tree's level."""
    def draw(tree, level, n):
        return np.random.default_rng([seed, tree, level, 1]).random((n, wide)).argsort(axis=1)[:, :own]
    return draw


def _descend(tables: dict, chunks: list, height: int, classes: int):
    """A task that moves a block's rows to their nodes of the next level and
    counts there, (tree, (cells, counts)); rows in leaves are dropped.  ``tables`` has per tree
    which nodes are split, the features and bins of those, which ways go on, and the features drawn for the next nodes."""
    def whole(split, feature, cut, going, drawn):
        every, cuts = np.zeros(len(split), np.int64), np.zeros(len(split), np.uint8)
        every[split], cuts[split] = feature, cut
        # Per node and way, the next node (numbered in order) or -1.
        child = np.full((len(split), 2), -1)
        child[split] = np.where(going, (np.cumsum(going) - 1).reshape(-1, 2), -1)
        return every, cuts, child.ravel(), drawn.astype(np.int64)

    def task(records):
        known = {}
        for tree_of_counts, state in records:
            if tree_of_counts is not None:
                continue
            chunk, block, before = state
            flat, width, kept = block.ravel(), block.shape[1], []
            places = np.uint16 if width <= 65536 else np.uint32
            for tree, (r, node, w) in zip(chunks[chunk], before):
                if tree not in tables or not len(r):
                    kept.append((r[:0], node[:0], w[:0]))
                    continue
                if tree not in known:
                    known[tree] = whole(*tables[tree])
                feature, cut, child, drawn = known[tree]
                r, node = r.astype(np.int64), node.astype(np.int64)
                node = child[2 * node + (flat[feature[node] * width + r] > cut[node])]
                stay = np.flatnonzero(node >= 0)
                r, node, w = r[stay], node[stay], w[stay]
                kept.append((r.astype(places), node.astype(np.uint16 if len(drawn) <= 65536 else np.uint32), w))
                if not len(r):
                    continue
                own = drawn.shape[1]
                first = node * (own * BINS * classes) + flat[(height - 1) * width + r]
                keys = np.concatenate([first + (j * BINS + flat[drawn[node, j] * width + r].astype(np.int64)) * classes
                                       for j in range(own)])
                ws, size = np.tile(w, own), len(drawn) * own * BINS * classes
                if size <= 4 * len(keys):
                    counts = np.bincount(keys, ws, size)
                    cells = np.flatnonzero(counts)
                    counts = counts[cells]
                else:
                    order = np.argsort(keys, kind="stable")
                    keys = keys[order]
                    starts = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
                    cells, counts = keys[starts], np.add.reduceat(ws[order].astype(np.int64), starts)
                yield tree, (cells, counts.astype(np.uint32))
            if any(len(r) for r, _, _ in kept):
                yield None, (chunk, block, kept)
    return task


def _best_splits(nodes: dict, own: int, classes: int):
    """For a tree's counts: its nodes' classes, and those left of their
    best splits with the splits' places and gains."""
    def best(grouped):
        tree, parts = grouped[0], list(grouped[1])
        span, found = own * BINS * classes, []
        for lo in range(0, nodes[tree], NODES_AT_ONCE):
            n = min(NODES_AT_ONCE, nodes[tree] - lo)
            h = np.zeros(n * span)
            for cells, counts in parts:
                a, b = np.searchsorted(cells, [lo * span, (lo + n) * span])
                h[cells[a:b] - lo * span] += counts[a:b]      # a part has each cell once
            h = h.reshape(n, own, BINS, classes)
            total = h[:, 0].sum(axis=1)
            left = np.cumsum(h, axis=2)[:, :, :-1]
            right = total[:, None, None] - left
            nl, nr, every = left.sum(axis=-1), right.sum(axis=-1), total.sum(axis=-1)[:, None, None]
            with np.errstate(divide="ignore", invalid="ignore"):
                mixed = lambda c, m: 1.0 - ((c / m[..., None]) ** 2).sum(axis=-1)
                gain = mixed(total, every[:, 0, 0])[:, None, None] - nl / every * mixed(left, nl) - nr / every * mixed(right, nr)
            gain = np.where((nl > 0) & (nr > 0), gain, -np.inf).reshape(n, -1)
            at = gain.argmax(axis=1)
            found.append((at, gain[np.arange(n), at], left.reshape(n, -1, classes)[np.arange(n), at], total))
        return tree, [np.concatenate(c) for c in zip(*found)]
    return best


def _decided(draw, level: int, last: bool):
    """For a tree's best splits: (tree, (level, its nodes' classes, which are split, and of those the
    features, bins, gains, both sides' classes, and which sides are split further))."""
    def task(found):
        tree, (place, gain, left, total) = found
        split = gain > 0
        at = np.flatnonzero(split)
        kids = np.stack([left[at], total[at] - left[at]], axis=1)
        going = ((kids > 0).sum(axis=2) > 1) & (not last)
        feature = draw(tree, level, len(place))[at, place[at] // (BINS - 1)].astype(np.uint16)
        return tree, (level, total, split, feature, (place[at] % (BINS - 1)).astype(np.uint8), gain[at], kids, going)
    return task


def _passed_on(draw):
    """What the rows need of it, some bytes a node (``_descend``), with the features drawn for the next nodes."""
    def task(decided):
        tree, (level, _, split, feature, cut, _, _, going) = decided
        return tree, (split, feature, cut, going, draw(tree, level + 1, int(going.sum())).astype(np.uint16))
    return task


def _tree(classes: int):
    """A task that puts a tree's levels together, as a row of ``TREES``.  Inner nodes over leaves of one
    prediction become leaves, as in the estimator; a right child follows its left one, and a leaf's ``kid`` is 0."""
    def task(grouped):
        tree, found = grouped[0], sorted(grouped[1], key=lambda r: r[0])
        levels, own, active = [], found[0][1], np.ones(1, bool)
        for _, _, split, feature, cut, gain, kids, going in found:
            at, n = np.flatnonzero(active)[split], len(own)
            now = {"classes": own, "inner": np.zeros(n, bool), "feature": np.zeros(n, np.uint16), "cut": np.zeros(n, np.uint8),
                   "gain": np.full(n, -1.0), "left": np.full(n, -1)}
            now["inner"][at], now["feature"][at], now["cut"][at], now["gain"][at], now["left"][at] = True, feature, cut, gain, 2 * np.arange(len(at))
            levels.append(now)
            own, active = kids.reshape(-1, classes), going.ravel()
        n = len(own)
        levels.append({"classes": own, "inner": np.zeros(n, bool), "feature": np.zeros(n, np.uint16), "cut": np.zeros(n, np.uint8),
                       "gain": np.full(n, -1.0), "left": np.full(n, -1)})
        for now in levels:
            now["predicted"] = now["classes"].argmax(axis=1)
        for now, below in zip(levels[-2::-1], levels[:0:-1]):
            at = np.flatnonzero(now["inner"])
            kid = now["left"][at]
            same = ~below["inner"][kid] & ~below["inner"][kid + 1] & (below["predicted"][kid] == below["predicted"][kid + 1])
            now["inner"][at[same]] = False
        reached, starts = [np.ones(1, bool)], np.cumsum([0] + [len(v["left"]) for v in levels])
        for now, below in zip(levels, levels[1:]):
            kid = now["left"][now["inner"] & reached[-1]]
            there = np.zeros(len(below["left"]), bool)
            there[kid] = there[kid + 1] = True
            reached.append(there)
        use = np.flatnonzero(np.concatenate(reached))
        every = {c: np.concatenate([v[c] for v in levels])[use] for c in ("inner", "feature", "cut", "gain", "classes")}
        left = np.concatenate([np.where(v["inner"], v["left"] + s, 0) for v, s in zip(levels, starts[1:])])
        ids = np.zeros(starts[-1], np.int32)
        ids[use] = np.arange(len(use))
        inner = every["inner"]
        return (tree, len(use), np.where(inner, every["feature"], 0).astype(np.uint16).tobytes(), np.where(inner, every["cut"], 0).astype(np.uint8).tobytes(),
                np.where(inner, ids[left[use]], 0).astype(np.int32).tobytes(), np.where(inner, every["gain"], -1.0).tobytes(),
                every["classes"].astype(float).tobytes())
    return task


def _grow(spark: SparkSession, blocks, trees: range, wide: int, classes: int, max_depth: int, seed: int, path: str) -> None:
    """Grows ``trees`` on the blocks of ``wide`` features and appends them to the folder ``path``."""
    parts, own = blocks.getNumPartitions(), math.ceil(math.sqrt(wide))
    chunks = [list(trees[i:i + RECORD_TREES]) for i in range(0, len(trees), RECORD_TREES)]
    draw = _drawing(seed, wide, own)
    state = blocks.mapPartitionsWithIndex(_roots(chunks, wide + 1, seed))
    # Before the root there is one node, whose rows all go on to it.
    tables = {t: (np.ones(1, bool), np.zeros(1, np.uint16), np.full(1, 255, np.uint8), np.array([[True, False]]), draw(t, 0, 1)) for t in trees}
    levels = []
    try:
        for level in range(max_depth):
            after = state.mapPartitions(_descend(tables, chunks, wide + 1, classes)).persist(StorageLevel.MEMORY_AND_DISK)
            held, state = state, after
            active = {t: len(table[4]) for t, table in tables.items()}
            found = (after.filter(lambda r: r[0] is not None).groupByKey(min(parts, len(active)))
                     .map(_best_splits(active, own, classes)).map(_decided(draw, level, level + 1 == max_depth))
                     .persist(StorageLevel.MEMORY_AND_DISK))
            levels.append(found)
            tables = {t: table for t, table in found.map(_passed_on(draw)).collect() if len(table[4])}
            if level:
                held.unpersist()
            if not tables:
                break
        # A row of bytes per tree, each of them written by a task.
        grown = spark.sparkContext.union(levels).coalesce(parts).groupByKey(min(parts, len(trees))).map(_tree(classes))
        spark.createDataFrame(grown, TREES, verifySchema=False).write.mode("append").parquet(path)
    finally:
        state.unpersist()
        for found in levels:
            found.unpersist()


def _scoring(forests: list, names: list):
    """A task that appends the classes' probabilities by each of ``forests`` (edges, classes, trees, slices, column) to its rows,
    without those columns; rows are gathered so that many meet a slice at once."""
    def walk(tree: tuple, flat: np.ndarray, width: int) -> np.ndarray:
        """The leaves that the rows of a block reach."""
        feature, cut, kid, _ = tree
        end = np.zeros(width, np.int32)
        if not kid[0]:
            return end
        first, at, node = feature.astype(np.int64) * width, np.arange(width), np.zeros(width, np.int32)
        while len(at):
            node = kid[node] + (flat[first[node] + at] > cut[node])
            end[at] = node
            go = np.flatnonzero(kid[node])
            at, node = at[go], node[go]
        return end

    def probabilities(batches, edges, classes, num_trees, slices, column, keep):
        height, found = len(edges), []
        for batch in batches:
            x = batch.column(batch.schema.get_field_index(column)).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, height)
            found.append(np.stack([np.searchsorted(e, x[:, i]) for i, e in enumerate(edges)]).astype(np.uint8))
        block = np.concatenate(found, axis=1)
        votes = np.zeros((block.shape[1], classes))
        for part in slices:
            for tree in part.value:
                share = tree[3] / tree[3].sum(axis=1, keepdims=True)
                votes += share[walk(tree, block.ravel(), block.shape[1])]
            if not keep:
                del part._value
        return votes / num_trees

    def scored(batches, keep):
        got = [probabilities(batches, *forest, keep) for forest in forests]
        lo = 0
        for batch in batches:
            hi = lo + batch.num_rows
            columns = [batch.column(batch.schema.get_field_index(n)) for n in names]
            for p in got:
                ends = pa.array(np.arange(batch.num_rows + 1, dtype=np.int32) * p.shape[1])
                columns.append(pa.ListArray.from_arrays(ends, pa.array(p[lo:hi].ravel())))
            yield pa.RecordBatch.from_arrays(columns, [*names, *(f"_p{i}" for i in range(len(got)))])
            lo = hi

    keep = sum(len(f[3]) for f in forests) * SLICE_BYTES <= HELD_BYTES
    most = ROWS_AT_ONCE if keep else MORE_ROWS

    def task(batches):
        waiting, n = [], 0
        for batch in batches:
            if batch.num_rows:
                waiting.append(batch)
                n += batch.num_rows
            if n >= most:
                yield from scored(waiting, keep)
                waiting, n = [], 0
        if waiting:
            yield from scored(waiting, keep)
    return task


def with_probabilities(df: DataFrame, forests: list[tuple], spare: list[str] | None = None) -> DataFrame:
    """``df`` with the classes' probabilities by each of ``forests`` (model, vector column, name) as an
    array of that name, without the columns in ``spare``; one pass in Python for all."""
    kept = [f for f in df.schema.fields if f.name not in (spare or [])]
    vectors = {f.name: f.metadata for f in kept if isinstance(f.dataType, VectorUDT)}
    own = [f"_x{i}" for i in range(len(forests))]
    plain = df.select(*[vector_to_array(F.col(f"`{f.name}`")).alias(f.name) if f.name in vectors else F.col(f"`{f.name}`") for f in kept],
                      *[vector_to_array(F.col(vec)).alias(x) for x, (_, vec, _) in zip(own, forests)])
    names = [f.name for f in kept]
    out = StructType(list(plain.schema.fields[:len(kept)]))
    for i in range(len(forests)):
        out = out.add(f"_p{i}", ArrayType(DoubleType()))
    task = _scoring([(m.edges, m.numClasses, m.getNumTrees, m.slices(), x) for x, (m, _, _) in zip(own, forests)], names)
    # Scoring takes far longer than a shuffle, so that every core gets as many rows.
    spark = df.sparkSession
    parts = max(2 * spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    got = plain.repartition(parts).mapInArrow(task, out)
    return got.select(*[array_to_vector(F.col(f"`{n}`")).alias(n, metadata=vectors[n]) if n in vectors else F.col(f"`{n}`") for n in names],
                      *[F.col(f"_p{i}").alias(name) for i, (_, _, name) in enumerate(forests)])


class BlockForestModel(Model):
    """A forest whose trees are rows of ``TREES`` in the shared folder; scores as Spark's model of the same trees does."""

    def __init__(self, spark: SparkSession, path: str, edges: list, num_trees: int, classes: int, params: dict):
        super().__init__()
        self.spark, self.path, self.edges, self.params_of_fit = spark, path, edges, params
        self.getNumTrees, self.numFeatures, self.numClasses = num_trees, len(edges), classes
        self.sizes = sorted(map(tuple, self._rows().select("tree", "nodes").collect()))
        if [t for t, _ in self.sizes] != list(range(num_trees)):
            raise RuntimeError(f"{len(self.sizes)} trees of {num_trees} were found in {path}")
        self.totalNumNodes = sum(n for _, n in self.sizes)
        self._slices, self._spark_model = None, None

    def _rows(self) -> DataFrame:
        return self.spark.read.schema(TREES).parquet(self.path)

    def slices(self) -> list:
        """The trees as broadcasts of about ``SLICE_BYTES`` each, made one after the other."""
        if self._slices is None:
            cuts, room = [0], 0
            for tree, nodes in self.sizes:
                size = nodes * (7 + 4 * self.numClasses)
                if room and room + size > SLICE_BYTES:
                    cuts.append(tree)
                    room = 0
                room += size
            self._slices = []
            for a, b in zip(cuts, [*cuts[1:], self.getNumTrees]):
                found = []
                for r in sorted(self._rows().where(F.col("tree").between(a, b - 1)).drop("gain").collect(), key=lambda r: r["tree"]):
                    classes = np.frombuffer(r["classes"]).reshape(-1, self.numClasses)
                    found.append((np.frombuffer(r["feature"], np.uint16), np.frombuffer(r["cut"], np.uint8), np.frombuffer(r["kid"], np.int32),
                                  classes.astype(np.uint32)))      # counts of weighted rows
                self._slices.append(self.spark.sparkContext.broadcast(found))
        return self._slices

    def _transform(self, dataset: DataFrame) -> DataFrame:
        out = with_probabilities(dataset, [(self, self.params_of_fit["featuresCol"], "_p")])
        p = F.col("_p")
        return out.withColumns({"rawPrediction": array_to_vector(F.transform(p, lambda v: v * self.getNumTrees)), "probability": array_to_vector(p),
                                "prediction": (F.array_position(p, F.array_max(p)) - 1).cast("double")}).drop("_p")

    def to_spark(self) -> RandomForestClassificationModel:
        """Spark's model, which the driver holds as a whole."""
        if self._spark_model is None:
            nodes = self._rows().mapInArrow(_saved_nodes(self.edges, self.numClasses), NODES)
            self._spark_model = _load(self.spark, nodes, self.getNumTrees, self.numFeatures, self.numClasses, **self.params_of_fit)
        return self._spark_model

    @property
    def trees(self) -> list:
        return self.to_spark().trees


#: The nodes of a tree in the layout of Spark's saved models.
NODES = """treeID int, nodeData struct<id int, prediction double, impurity double, impurityStats array<double>, rawCount bigint, gain double,
           leftChild int, rightChild int, split struct<featureIndex int, leftCategoriesOrThreshold array<double>, numCategories int>>"""


def _saved_nodes(edges: list, classes: int):
    """A task that unfolds trees to their ``NODES``."""
    def one(r):
        feature, cut = np.frombuffer(r["feature"], np.uint16), np.frombuffer(r["cut"], np.uint8)
        kid, gain, own = np.frombuffer(r["kid"], np.int32), np.frombuffer(r["gain"]), np.frombuffer(r["classes"]).reshape(-1, classes)
        inner, total, n = kid > 0, own.sum(axis=1), len(kid)
        threshold = np.array([edges[f][c] for f, c in zip(feature[inner], cut[inner])], dtype=float)
        ints = lambda a: pa.array(a.astype(np.int32), pa.int32())
        cuts = pa.ListArray.from_arrays(ints(np.concatenate([[0], np.cumsum(inner)])), pa.array(threshold))
        split = pa.StructArray.from_arrays([ints(np.where(inner, feature, -1)), cuts, ints(np.full(n, -1))],
                                           ["featureIndex", "leftCategoriesOrThreshold", "numCategories"])
        stats = pa.ListArray.from_arrays(ints(np.arange(n + 1) * classes), pa.array(own.ravel()))
        node = pa.StructArray.from_arrays(
            [ints(np.arange(n)), pa.array(own.argmax(axis=1).astype(float)), pa.array(1.0 - ((own / total[:, None]) ** 2).sum(axis=1)),
             stats, pa.array(total.astype(np.int64)), pa.array(gain), ints(np.where(inner, kid, -1)), ints(np.where(inner, kid + 1, -1)), split],
            ["id", "prediction", "impurity", "impurityStats", "rawCount", "gain", "leftChild", "rightChild", "split"])
        return pa.RecordBatch.from_arrays([ints(np.full(n, r["tree"])), node], ["treeID", "nodeData"])

    def task(batches):
        for batch in batches:
            yield from map(one, batch.to_pylist())
    return task


def _load(spark: SparkSession, nodes: DataFrame, num_trees: int, features: int, classes: int, **params) -> RandomForestClassificationModel:
    """Spark's model of the nodes, by way of its saved form."""
    path, kind = shared_path(spark, "forest"), "org.apache.spark.ml.classification."

    def metadata(name, prefix, **more):
        return json.dumps({"class": kind + name, "timestamp": 0, "sparkVersion": spark.version, "defaultParamMap": {},
                           "uid": f"{prefix}_{uuid.uuid4().hex[:12]}"} | more)
    forest = metadata("RandomForestClassificationModel", "RandomForest", paramMap=params | {"numTrees": num_trees},
                      numFeatures=features, numClasses=classes, numTrees=num_trees)
    spark.createDataFrame([(forest,)], "value string").coalesce(1).write.text(f"{path}/metadata")
    one = [(t, metadata("DecisionTreeClassificationModel", "dtc", paramMap=params, numFeatures=features, numClasses=classes), 1.0)
           for t in range(num_trees)]
    spark.createDataFrame(one, "_1 int, _2 string, _3 double").coalesce(1).write.parquet(f"{path}/treesMetadata")
    nodes.write.parquet(f"{path}/data")
    return RandomForestClassificationModel.load(path)


def fit_block_forest(rows: DataFrame, count: int, num_trees: int = 20, max_depth: int = 5, seed: int = 42,
                     features: str = "features", label: str = "label") -> BlockForestModel:
    """A forest on all ``rows`` (``count`` of them), in batches of trees whose rows
    make about ``PARTS_PER_CORE`` partitions a core."""
    spark = rows.sparkSession
    rows = rows.select(vector_to_array(F.col(features)).alias("x"), F.col(label).cast("double").alias("y"))
    top = rows.agg(F.max("y").alias("top"), F.count_if((F.col("y") < 0) | (F.col("y") != F.floor("y")) | F.col("y").isNull())
                   .alias("wrong")).first()
    if top["top"] is None or top["wrong"] or top["top"] > 99:
        raise ValueError(f"labels must be integers from 0 to 99; {top['wrong']} rows have others, the largest is {top['top']}")
    sample = rows.select("x").sample(False, min(1.0, SAMPLE_ROWS / count), seed) if count > SAMPLE_ROWS else rows.select("x")
    values = np.array([r["x"] for r in sample.collect()])
    edges, classes = [bin_edges(v) for v in values.T], max(int(top["top"]) + 1, 2)
    cores = spark.sparkContext.defaultParallelism
    most = max(RECORD_TREES, int(PARTS_PER_CORE * cores * PART_CELLS / count))
    batches = math.ceil(num_trees / most)
    ends = [num_trees * (i + 1) // batches for i in range(batches)]
    path = shared_path(spark, "trees")
    cells = count * math.ceil(num_trees / batches)
    parts = max(math.ceil(cells / PART_CELLS), min(cores, math.ceil(4 * cells / PART_CELLS)))
    blocks = rows.repartition(parts).mapInArrow(_bins(edges), "block binary").rdd.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        for a, b in zip([0, *ends], ends):
            _grow(spark, blocks, range(a, b), len(edges), classes, max_depth, seed, path)
    finally:
        blocks.unpersist()
        # A forest takes some hundred small jobs.  Their broadcasts, shuffles and buffers outside the heap go with the
        # driver's garbage, which it would gather only once its heap is full, after many forests.
        gc.collect()
        spark.sparkContext._jvm.System.gc()
    return BlockForestModel(spark, path, edges, num_trees, classes, {
        "featuresCol": features, "labelCol": label, "impurity": "gini", "maxDepth": max_depth, "seed": seed})


__all__ = ["fit_block_forest", "bin_edges", "BlockForestModel", "with_probabilities"]
