"""Toxicity by cumulative-link ordinal regression.

A text has the set of its words and of their beginnings as sparse features.  One weight vector serves
all grades 0 < 1 < 2 < 3; ordered thresholds t1 < t2 < t3 turn the weighted sum
s into P(grade >= g) = logistic(s - t_g), and the expected severity is the sum
of these probabilities.

``labels`` marks texts as toxic or not, so the training grades are made from
the training texts themselves: a word's evidence is its smoothed log odds
between toxic and other texts, and a toxic text is of grade 1, 2 or 3 by how
many strongly toxic words it holds.  Features are the words whose evidence is
significant.  The fit reads a bounded sample of labelled texts (``max_rows``,
the smallest id hashes), one of each group of near copies so that a copied text
does not turn its words into evidence; its word counts are added up in Spark."""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkwright.llm.shared import query, slices, stage, table
from sparkwright.llm.words import words_of

GRADES = 3
#: Labelled texts that a fit reads at most, and features that it keeps at most
#: (the most significant); both bound what the driver holds.
MAX_ROWS = 20_000
MAX_FEATURES = 5_000
#: Least z score of a word's log odds, and least texts with it.
SIGNIFICANT, LEAST_TEXTS = 3.5, 4
#: Log odds of a strongly toxic word, and how many make grades 2 and 3.
STRONG, STEPS = 2.0, (2, 4)
RIDGE = 0.05
#: Predicted toxic at this probability of grade 1 or more.
CUT = 0.5


#: Bytes of the beginnings that are features.
PREFIXES = (4, 5)


def features_of(text: str | None) -> set[bytes]:
    """Distinct words of a whole text, and their beginnings marked by ``^``."""
    words = set(words_of((text or "").lower()))
    out = set(words)
    for n in PREFIXES:
        out.update([b"^" + w[:n] for w in words if len(w) > n])
    return out


def copy_key(text: str | None) -> int:
    """The least hash of the word trigrams: near copies mostly share it."""
    words = words_of((text or "").lower())
    if not words:
        return 0
    grams = zip(words, words[1:], words[2:]) if len(words) > 2 else [words]
    return min(xxhash.xxh64_intdigest(b" ".join(g)) for g in grams) >> 1


def _copy_keys(batches):
    for b in slices(batches):
        key = [copy_key(t) for t in b.column("text").to_pylist()]
        yield pa.RecordBatch.from_arrays([*b.columns, pa.array(key, pa.int64())], names=[*b.schema.names, "copy"])


@dataclass
class Ordinal:
    """Weights of the words and the ordered thresholds."""
    weights: dict[bytes, float]
    thresholds: np.ndarray

    def sums(self, texts: list[str | None]) -> np.ndarray:
        known, get = self.weights.keys(), self.weights.__getitem__
        return np.array([sum(map(get, sorted(features_of(t) & known))) for t in texts])

    def at_least(self, texts: list[str | None]) -> np.ndarray:
        """P(grade >= 1..3), a row per text."""
        s = self.sums(texts)[:, None] - self.thresholds
        return 1 / (1 + np.exp(-np.clip(s, -50, 50)))


def ordinal_fit(rows: list[tuple[list[int], int]], n_features: int, ridge: float = RIDGE, rounds: int = 300,
                rate: float = 0.3) -> tuple[np.ndarray, np.ndarray]:
    """Weights and thresholds that minimise the cumulative-link loss with a
    ridge, by full gradients with per-coordinate step sizes (Adam).  rows: the
    feature numbers and the grade of each text; the gaps between thresholds
    are kept positive by fitting their logarithms."""
    col = np.array([f for x, _ in rows for f in x], np.int64)
    row = np.repeat(np.arange(len(rows)), [len(x) for x, _ in rows])
    grade = np.array([g for _, g in rows])
    cut = np.arange(1, GRADES + 1)
    # Parameters: weights, first threshold, log gaps.
    p = np.concatenate([np.zeros(n_features), [2.0], np.zeros(GRADES - 1)])
    m, v = np.zeros_like(p), np.zeros_like(p)
    for k in range(1, rounds + 1):
        w, t0, gaps = p[:n_features], p[n_features], np.exp(p[n_features + 1:])
        t = t0 + np.concatenate([[0.0], np.cumsum(gaps)])
        s = np.bincount(row, weights=w[col], minlength=len(rows))
        up = 1 / (1 + np.exp(-np.clip(s[:, None] - t, -50, 50)))
        edge = np.concatenate([np.ones((len(rows), 1)), up, np.zeros((len(rows), 1))], axis=1)
        i = np.arange(len(rows))
        mass = np.maximum(edge[i, grade] - edge[i, grade + 1], 1e-9)
        slope = up * (1 - up)
        # d(-log mass)/d(s - t_g): the upper edge of the grade's interval, less the lower.
        d = (slope * (cut == grade[:, None] + 1) - slope * (cut == grade[:, None])) / mass[:, None]
        ds, dt = d.sum(axis=1), -d.sum(axis=0)
        g = np.concatenate([
            np.bincount(col, weights=ds[row], minlength=n_features) / len(rows) + ridge * w / max(1, len(rows)) ** 0.5,
            [dt.sum() / len(rows)], [dt[j + 1:].sum() * gaps[j] / len(rows) for j in range(GRADES - 1)]])
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        p = p - rate * (m / (1 - 0.9 ** k)) / (np.sqrt(v / (1 - 0.999 ** k)) + 1e-8) / math.sqrt(1 + k / 50)
    gaps = np.exp(p[n_features + 1:])
    return p[:n_features], p[n_features] + np.concatenate([[0.0], np.cumsum(gaps)])


#: Distinct words and beginnings that a task counts before it sends them on.
COUNTED = 300_000


def _words(batches):
    """(word, y, n): texts of each kind with each feature."""
    out = {0: {}, 1: {}}

    def send():
        for y, count in out.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(count), pa.binary()), pa.array(np.full(len(count), y), pa.int32()),
                 pa.array(list(count.values()), pa.int64())], names=["word", "y", "n"])
            count.clear()

    for b in slices(batches):
        for y, t in zip(b.column("y").to_pylist(), b.column("text").to_pylist()):
            count = out[y]
            for w in features_of(t):
                count[w] = count.get(w, 0) + 1
        if len(out[0]) + len(out[1]) > COUNTED:
            yield from send()
    yield from send()


def _known(words: list[bytes]):
    """(y, features): the numbers of a text's known words."""
    number = {w: i for i, w in enumerate(words)}

    def run(batches):
        for b in slices(batches):
            found = [sorted(number[w] for w in features_of(t) & number.keys()) for t in b.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("y"), pa.array(found, pa.list_(pa.int32()))],
                                             names=["y", "features"])
    return run


def fit(docs: DataFrame, labels: DataFrame, label_col: str = "toxic", id_col: str = "doc_id", text_col: str = "text",
        max_rows: int = MAX_ROWS, max_features: int = MAX_FEATURES) -> Ordinal:
    """Learn from the rows of ``labels`` (id, 0 or 1) that ``docs`` has.  Other
    labels and null ids are ignored; a document labelled twice counts as toxic
    if any label says so.  Without toxic examples nothing is toxic."""
    marked = (labels.select(F.col(id_col).cast("bigint").alias("id"), F.col(label_col).cast("int").alias("y"))
              .where("id is not null and y in (0, 1)").groupBy("id").agg(F.max("y").alias("y")))
    sample = marked.orderBy(F.xxhash64("id"), "id").limit(max_rows)
    # Bounded by max_rows.
    texts = (docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).alias("text"))
             .join(F.broadcast(sample), "id").mapInArrow(_copy_keys, "id bigint, text string, y int, copy bigint"))
    texts = stage(texts.groupBy("copy", "y").agg(F.min(F.struct("id", "text"))["text"].alias("text"))
                  .select("y", "text"), "toxicity-sample")
    total = {r["y"]: r["count"] for r in texts.groupBy("y").count().collect()}
    bad, good = total.get(1, 0), total.get(0, 0)
    counts = (texts.mapInArrow(_words, "word binary, y int, n bigint").groupBy("word")
              .agg(F.sum(F.when(F.col("y") == 1, F.col("n")).otherwise(0)).alias("bad"),
                   F.sum(F.when(F.col("y") == 0, F.col("n")).otherwise(0)).alias("good")))
    # Smoothed log odds of a word between the two kinds of texts, and its z score.
    a, c = F.col("bad") + 0.5, F.col("good") + 0.5
    odds = F.log(a / (bad + 1 - a)) - F.log(c / (good + 1 - c))
    z = odds / F.sqrt(1 / a + 1 / c)
    kept = (counts.where(F.col("bad") + F.col("good") >= LEAST_TEXTS).withColumn("odds", odds).withColumn("z", z)
            .where(F.abs("z") >= SIGNIFICANT).orderBy(F.desc(F.abs("z")), "word").limit(max_features)
            .select("word", "odds").collect()) if bad and good else []
    words = [bytes(r["word"]) for r in kept]
    strong = np.array([r["odds"] >= STRONG and r["word"][:1] != b"^" for r in kept], bool)
    rows = []
    # Bounded by max_rows texts with max_features numbers each.
    for r in texts.mapInArrow(_known(words), "y int, features array<int>").collect() if words else []:
        hard = int(strong[r["features"]].sum()) if r["features"] else 0
        rows.append((r["features"], r["y"] * (1 + sum(hard >= s for s in STEPS))))
    if not words:
        return Ordinal({}, np.array([20.0, 21.0, 22.0]))
    weights, thresholds = ordinal_fit(rows, len(words))
    return Ordinal(dict(zip(words, weights.tolist())), thresholds)


def _scores(model: Ordinal):
    def run(batches):
        for b in slices(batches):
            up = model.at_least(b.column("text").to_pylist())
            sums = up.sum(axis=1)
            cols = [b.column(0), pa.array(sums), pa.array(np.rint(sums).astype(np.int32)), pa.array(up[:, 0])]
            yield pa.RecordBatch.from_arrays(cols, names=["doc_id", "severity", "grade", "toxic_score"])
    return run


def severity(docs: DataFrame, model: Ordinal, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, severity, grade, toxic_score): the expected grade (0 to 3), the
    nearest grade and P(grade >= 1); one row per row of ``docs``, also for
    null and empty texts (no words) and repeated rows; extra columns are
    ignored."""
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(_scores(model), "doc_id bigint, severity double, grade int, toxic_score double")


@query("op8_toxicity")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = severity(docs, fit(docs, table(spark, sf_dir, "labels")))
    return found.withColumn("toxic", (F.col("toxic_score") >= CUT).cast("int"))
