"""PCA of wide tables by a distributed randomised range finder.

The covariance of d columns is never formed: a pass multiplies it with a d x l
matrix (l = components + oversampling) as a sum of small products per batch,
merged in Spark by blocks of columns.  The driver holds d x l numbers, takes
their QR decomposition, and a few passes turn it into the leading subspace.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

OVERSAMPLING = 10
PASSES = 6
BLOCK = 256
ROWS_AT_ONCE = 4096
#: Tasks' shares are merged in so many groups before they meet.
SALTS = 64
SHARE = "block int, salt int, part binary"


@dataclass
class PCAModel:
    """Means and scales of the columns, components (a row each, the largest
    loading positive) and their variances, descending."""
    columns: list[str]
    mean: np.ndarray
    scale: np.ndarray
    components: np.ndarray
    variances: np.ndarray

    def transform(self, df: DataFrame, prefix: str = "pc") -> DataFrame:
        """``df`` with pc1, pc2, ...; a null counts as the column's mean."""
        k = len(self.components)
        names = [f"{prefix}{j + 1}" for j in range(k)]
        kept = [f for f in df.schema.fields if f.name not in names]
        schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in kept] + [f"{n} double" for n in names])
        x = [F.col(f"`{c}`").cast("double").alias(f"_x{i}") for i, c in enumerate(self.columns)]
        width = len(kept)
        own = df.select(*[F.col(f"`{f.name}`") for f in kept], *x)
        return own.mapInArrow(_project(self, width, [f.name for f in kept] + names), schema)


def _matrix(b: pa.RecordBatch, first: int, mean: np.ndarray, scale: np.ndarray) -> np.ndarray:
    """Centred and scaled columns from ``first`` on; nulls are 0."""
    cols = b.columns[first:]
    x = np.stack([c.fill_null(0.0).to_numpy(zero_copy_only=False) for c in cols], 1)
    there = np.stack([c.is_valid().to_numpy(zero_copy_only=False) for c in cols], 1)
    return np.where(there, (x - mean) / scale, 0.0)


def _project(model: PCAModel, width: int, names: list[str]):
    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS_AT_ONCE):
                b = batch.slice(at, ROWS_AT_ONCE)
                y = _matrix(b, width, model.mean, model.scale) @ model.components.T
                yield pa.RecordBatch.from_arrays([*b.columns[:width], *[pa.array(c) for c in y.T]], names=names)
    return run


def _product(mean: np.ndarray, scale: np.ndarray, q: np.ndarray):
    """Task's share of X'XQ, in blocks of columns."""
    def run(batches):
        total = np.zeros_like(q)
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS_AT_ONCE):
                x = _matrix(batch.slice(at, ROWS_AT_ONCE), 0, mean, scale)
                total += x.T @ (x @ q)
        for k in range(0, len(total), BLOCK):
            yield _share(k // BLOCK, total[k: k + BLOCK])
    return run


def _describe(width: int):
    """Task's count, mean and sum of squared deviations of every column."""
    def run(batches):
        held = np.zeros((3, width))
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS_AT_ONCE):
                b = batch.slice(at, ROWS_AT_ONCE)
                x = np.stack([c.fill_null(0.0).to_numpy(zero_copy_only=False) for c in b.columns], 1)
                there = np.stack([c.is_valid().to_numpy(zero_copy_only=False) for c in b.columns], 1)
                n = there.sum(0).astype(float)
                first = x[there.argmax(0), np.arange(width)]
                off = np.where(there, x - first, 0.0)
                mean = np.divide(off.sum(0), n, out=np.zeros(width), where=n > 0)
                held = _together(held, np.stack([n, mean + first, (np.where(there, off - mean, 0.0) ** 2).sum(0)]))
        yield _share(0, held)
    return run


def _share(block: int, part: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([block], pa.int32()), pa.array([TaskContext.get().partitionId() % SALTS], pa.int32()),
         pa.array([part.tobytes()], pa.binary())], names=["block", "salt", "part"])


def _whole(shares: DataFrame, merge) -> dict[int, np.ndarray]:
    """The shares of each block, merged in two steps."""
    rows = shares.groupBy("block", "salt").applyInArrow(merge, SHARE).groupBy("block").applyInArrow(merge, SHARE)
    return {r["block"]: np.frombuffer(r["part"]) for r in rows.collect()}


def _together(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    n = x[0] + y[0]
    share = np.divide(y[0], n, out=np.zeros_like(n), where=n > 0)
    by = y[1] - x[1]
    return np.stack([n, x[1] + by * share, x[2] + y[2] + by * by * x[0] * share])


def _merged(t: pa.Table) -> pa.Table:
    out = np.zeros_like(np.frombuffer(t["part"][0].as_py())).reshape(3, -1)
    for blob in t["part"].to_pylist():
        out = _together(out, np.frombuffer(blob).reshape(3, -1))
    return pa.table({"block": t["block"].slice(0, 1), "salt": t["salt"].slice(0, 1),
                     "part": pa.array([out.tobytes()], pa.binary())})


def _statistics(x: DataFrame, width: int) -> tuple[int, np.ndarray, np.ndarray]:
    """Rows (of the fullest column), means and sample standard deviations."""
    found = _whole(x.mapInArrow(_describe(width), SHARE), _merged)
    if not found:
        return 0, np.zeros(width), np.zeros(width)
    n, mean, square = found[0].reshape(3, -1)
    return int(n.max(initial=0)), mean, np.sqrt(square / np.maximum(n - 1, 1))


def _added(t: pa.Table) -> pa.Table:
    out = sum(np.frombuffer(x) for x in t["part"].to_pylist())
    return pa.table({"block": t["block"].slice(0, 1), "salt": t["salt"].slice(0, 1),
                     "part": pa.array([out.tobytes()], pa.binary())})


def _times(x: DataFrame, mean: np.ndarray, scale: np.ndarray, q: np.ndarray) -> np.ndarray:
    blocks = _whole(x.mapInArrow(_product(mean, scale, q), SHARE), _added)
    out = np.concatenate([blocks[k] for k in sorted(blocks)]) if blocks else np.zeros(q.size)
    return out.reshape(q.shape)


def fit(train: DataFrame, columns: list[str], k: int = 2, scaled: bool = False, passes: int = PASSES,
        seed: int = 42) -> PCAModel:
    """Leading ``k`` components of the sample covariance of ``columns`` (of
    their correlation, if ``scaled``).  ``train`` is read once for the means and
    ``passes`` + 1 times for the products, so it should be a stored table.
    Nulls count as the mean (the divisor is the count of the fullest column); a constant column has no part in a component."""
    d = len(columns)
    x = train.select(*[F.col(f"`{c}`").cast("double").alias(f"_x{i}") for i, c in enumerate(columns)])
    n, mean, spread = _statistics(x, d)
    scale = np.where(spread > 0, spread, 1.0) if scaled else np.ones(d)
    wide = min(d, k + OVERSAMPLING)
    q = np.linalg.qr(np.random.default_rng(seed).normal(size=(d, wide)))[0]
    for _ in range(passes):
        q = np.linalg.qr(_times(x, mean, scale, q))[0]
    small = q.T @ _times(x, mean, scale, q) / max(1, n - 1)
    values, vectors = np.linalg.eigh((small + small.T) / 2)
    order = np.argsort(values)[::-1][:k]
    components = (q @ vectors[:, order]).T
    largest = np.abs(components).argmax(1)
    components *= np.where(components[np.arange(len(order)), largest] < 0, -1.0, 1.0)[:, None]
    return PCAModel(list(columns), mean, scale, components, np.maximum(values[order], 0.0))
