"""Quality classifier: regularised quadratic discriminant.

Every whole text becomes a short vector of transformed statistics (log counts,
log shares).  Both classes are Gaussian with a mean and a covariance; each
covariance is shrunk towards the pooled one and towards a multiple of the
identity, and its Cholesky factor is computed once.  A text's score is the
logistic of the difference of the two log densities, each a Mahalanobis
distance through the cached factor, plus the log prior odds.

The fit reads a bounded sample of the labelled texts (``max_rows``, the
smallest id hashes); the class sums are added up in Spark, and only sums of the
size of the covariance reach the driver."""

from __future__ import annotations

from dataclasses import dataclass
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkwright.llm.shared import query, slices, table

FEATURES = ("words", "word_length", "upper", "symbols", "marks", "digits", "stops", "distinct", "adjacent",
            "line_length", "line_repeats", "short_words")
UPPER = bytes(range(65, 91))
LETTERS = UPPER + bytes(range(97, 123))
DIGITS = bytes(range(48, 58))
SYMBOLS = b"#$%&*|<>{}[]~^=_+\\/@"
MARKS = b"!?"
#: Labelled texts that a fit reads at most.
MAX_ROWS = 20_000
#: Shrinkage towards the pooled covariance, and towards the identity.
POOL, RIDGE = 0.3, 0.1
#: Predicted class 1 at this score.
CUT = 0.3


def statistics(text: str | None) -> np.ndarray:
    """Transformed statistics of one text; an empty one has the values of no
    words at all."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    words = raw.split()
    n, size = len(words), max(1, len(raw))
    count = lambda chars: len(raw) - len(raw.translate(None, chars))
    letters = count(LETTERS)
    share = lambda part, whole: np.log(part / max(1, whole) + 1e-3)
    lines = raw.split(b"\n")
    short = sum(1 for w in words if len(w) < 3)
    return np.array([
        np.log1p(n), np.log1p(len(raw) / max(1, n)), share(count(UPPER), letters), share(count(SYMBOLS), size),
        share(count(MARKS), size), share(count(DIGITS), size), share(raw.count(b"."), n),
        np.log1p(len(set(words))) - np.log1p(n), share(sum(map(eq, words, words[1:])), n),
        np.log1p(n / len(lines)), share(len(lines) - len(set(lines)), len(lines)), share(short, n)])


def _vectors(batches):
    """Statistics of the texts in the column ``text``, with the other columns."""
    for b in slices(batches):
        rows = [statistics(t) for t in b.column("text").to_pylist()]
        at = b.schema.get_field_index("text")
        flat = pa.array(np.concatenate(rows) if rows else np.zeros(0))
        x = pa.ListArray.from_arrays(pa.array(np.arange(len(rows) + 1, dtype=np.int32) * len(FEATURES)), flat)
        yield pa.RecordBatch.from_arrays([x if i == at else c for i, c in enumerate(b.columns)],
                                         names=[f if f != "text" else "x" for f in b.schema.names])


@dataclass
class Gaussian:
    """One class: mean, inverse Cholesky factor and log density constant."""
    mean: np.ndarray
    whiten: np.ndarray
    constant: float

    @classmethod
    def of(cls, mean: np.ndarray, cov: np.ndarray, log_prior: float) -> Gaussian:
        factor = np.linalg.cholesky(cov)
        return cls(mean, np.linalg.inv(factor), log_prior - float(np.log(np.diag(factor)).sum()))

    def log_density(self, x: np.ndarray) -> np.ndarray:
        z = (x - self.mean) @ self.whiten.T
        return self.constant - 0.5 * np.einsum("ij,ij->i", z, z)


@dataclass
class Discriminant:
    """The fitted pair of classes."""
    low: Gaussian
    high: Gaussian

    def score(self, x: np.ndarray) -> np.ndarray:
        gap = np.clip(self.high.log_density(x) - self.low.log_density(x), -50, 50)
        return 1 / (1 + np.exp(-gap))


def discriminant(counts: dict, sums: dict, squares: dict, pool: float = POOL, ridge: float = RIDGE) -> Discriminant:
    """From the count, sum and outer-product sum of each class (0 and 1).  A
    class without rows takes the other's moments, so the prior decides."""
    d = len(next(iter(sums.values())))
    n = {c: counts.get(c, 0) for c in (0, 1)}
    mean = {c: sums[c] / n[c] if n[c] else None for c in (0, 1)}
    cov = {c: squares[c] / n[c] - np.outer(mean[c], mean[c]) if n[c] else None for c in (0, 1)}
    for c in (0, 1):
        if not n[c]:
            mean[c], cov[c] = mean[1 - c], cov[1 - c]
    total = sum(n.values())
    pooled = sum(n[c] * cov[c] for c in (0, 1)) / total
    floor = ridge * max(float(np.trace(pooled)) / d, 1e-6)
    out = {}
    for c in (0, 1):
        shrunk = (1 - pool) * cov[c] + pool * pooled
        out[c] = Gaussian.of(mean[c], shrunk + floor * np.eye(d), float(np.log((n[c] + 1) / (total + 2))))
    return Discriminant(out[0], out[1])


def fit(docs: DataFrame, labels: DataFrame, label_col: str = "quality", id_col: str = "doc_id",
        text_col: str = "text", max_rows: int = MAX_ROWS, pool: float = POOL, ridge: float = RIDGE) -> Discriminant:
    """Learn from the rows of ``labels`` (id, label) that ``docs`` has.

    Labels other than 0 and 1 and null ids are ignored; a document labelled
    twice counts as 1 only if all its labels are.  At most ``max_rows`` labels
    are used, those with the smallest id hashes.  Without any labelled text a
    neutral model comes back, with score 0.5 for every text."""
    marked = (labels.select(F.col(id_col).cast("bigint").alias("id"), F.col(label_col).cast("int").alias("y"))
              .where("id is not null and y in (0, 1)").groupBy("id").agg(F.min("y").alias("y")))
    sample = marked.orderBy(F.xxhash64("id"), "id").limit(max_rows)
    # Bounded by max_rows.
    texts = docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).alias("text"))
    chosen = texts.join(F.broadcast(sample), "id").select("y", "text")
    x = chosen.mapInArrow(_vectors, "y int, x array<double>")
    d = len(FEATURES)
    cells = [(i, j) for i in range(d) for j in range(i, d)]
    rows = x.groupBy("y").agg(
        F.count("*").alias("n"), F.array(*[F.sum(F.col("x")[i]) for i in range(d)]).alias("s"),
        F.array(*[F.sum(F.col("x")[i] * F.col("x")[j]) for i, j in cells]).alias("q")).collect()
    counts, sums, squares = {}, {0: np.zeros(d), 1: np.zeros(d)}, {0: np.zeros((d, d)), 1: np.zeros((d, d))}
    for r in rows:
        counts[r["y"]], sums[r["y"]] = r["n"], np.array(r["s"])
        for (i, j), v in zip(cells, r["q"]):
            squares[r["y"]][i, j] = squares[r["y"]][j, i] = v
    if not counts:
        flat = Gaussian(np.zeros(d), np.eye(d), 0.0)
        return Discriminant(flat, flat)
    return discriminant(counts, sums, squares, pool, ridge)


def _scores(model: Discriminant):
    def run(batches):
        for b in slices(batches):
            rows = [statistics(t) for t in b.column("text").to_pylist()]
            score = model.score(np.array(rows)) if rows else np.zeros(0)
            yield pa.RecordBatch.from_arrays(
                [pa.array(score) if f == "text" else c for f, c in zip(b.schema.names, b.columns)],
                names=["score" if f == "text" else f for f in b.schema.names])
    return run


def score(docs: DataFrame, model: Discriminant, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, score): one row per row of ``docs``, also for null and empty
    texts (scored as no words) and repeated rows; extra columns are ignored."""
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(_scores(model), "doc_id bigint, score double")


def keep_good(docs: DataFrame, model: Discriminant, cut: float = CUT, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that score at least ``cut``, all columns unchanged."""
    def run(batches):
        for b in slices(batches):
            rows = [statistics(t) for t in b.column(text_col).to_pylist()]
            if rows:
                yield b.filter(pa.array(model.score(np.array(rows)) >= cut))
    return docs.mapInArrow(run, docs.schema)


def held_out(id_col: str = "doc_id"):
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % 5 == 0


def training_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "labels").where(~held_out())


@query("op2_quality_classifier")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = fit(docs, training_labels(spark, sf_dir))
    return score(docs, model).select(
        "doc_id", F.coalesce(held_out(), F.lit(False)).alias("held_out"), "score",
        (F.col("score") >= CUT).cast("int").alias("predicted"))
