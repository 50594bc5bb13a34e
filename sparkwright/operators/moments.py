"""Pairwise-complete second moments of wide tables in one scan.

Columns are taken in blocks of ``SIDE``.  A task turns its batches into matrix
products per pair of blocks (values and presence masks) and merges them into
one accumulator a pair of blocks; the accumulators of all tasks are merged in
Spark, first within salted groups, then per pair of blocks.  What is kept per
pair of columns (a, b), over the rows where both are present: count, both
means, both sums of squared deviations and of their product.  Merging takes
the exact update for shifted means, so no precision is lost to large sums.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SIDE = 128
ROWS_AT_ONCE = 4096
#: Accumulators of a pair of blocks are merged in so many groups first.
SALTS = 32
_PARTS = 6
_KIND = "i int, j int, salt int, moments binary"
#: Deviations below this share of the mean are rounding errors.
_FLAT = 1e-14


def _merged(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Moments of two disjoint sets of rows together."""
    n = x[0] + y[0]
    share = np.divide(y[0], n, out=np.zeros_like(n), where=n > 0)
    da, db, w = y[1] - x[1], y[2] - x[2], x[0] * share
    return np.stack([n, x[1] + da * share, x[2] + db * share, x[3] + y[3] + da * da * w, x[4] + y[4] + db * db * w,
                     x[5] + y[5] + da * db * w])


def _block(x: np.ndarray, there: np.ndarray, bad: np.ndarray, shift: np.ndarray, a: slice, b: slice) -> np.ndarray:
    """Moments of the columns of two blocks over some rows."""
    xa, xb, ma, mb = x[:, a], x[:, b], there[:, a], there[:, b]
    n = ma.T @ mb
    sa, sb = xa.T @ mb, ma.T @ xb
    qa, qb, c = (xa * xa).T @ mb, ma.T @ (xb * xb), xa.T @ xb
    inv = np.divide(1.0, n, out=np.zeros_like(n), where=n > 0)
    c = c - sa * sb * inv
    if bad[:, a].any() or bad[:, b].any():
        c[(bad[:, a].T @ mb + ma.T @ bad[:, b]) > 0] = np.nan
    seen = n > 0
    return np.stack([n, np.where(seen, sa * inv + shift[a][:, None], 0), np.where(seen, sb * inv + shift[b][None, :], 0),
                     np.maximum(qa - sa * sa * inv, 0), np.maximum(qb - sb * sb * inv, 0), c])


def _accumulate(width: int):
    blocks = [slice(k, min(k + SIDE, width)) for k in range(0, width, SIDE)]

    def run(batches):
        held: dict[tuple[int, int], np.ndarray] = {}
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS_AT_ONCE):
                b = batch.slice(at, ROWS_AT_ONCE)
                x = np.stack([c.fill_null(0.0).to_numpy(zero_copy_only=False) for c in b.columns], 1)
                there = np.stack([c.is_valid().to_numpy(zero_copy_only=False) for c in b.columns], 1)
                bad = ~np.isfinite(x)
                x[bad] = 0.0
                ok = there & ~bad
                # Any shift is right; the first value keeps constant columns exact.
                first = x[ok.argmax(0), np.arange(width)]
                n = np.maximum(ok.sum(0), 1)
                mean = np.where(((x == first) | ~ok).all(0), first, (x * ok).sum(0) / n)
                x = np.where(ok, x - mean, 0.0)
                there, bad = there.astype(float), bad.astype(float)
                for i, a in enumerate(blocks):
                    for j in range(i, len(blocks)):
                        m = _block(x, there, bad, mean, a, blocks[j])
                        held[i, j] = _merged(held[i, j], m) if (i, j) in held else m
        yield from _rows(held, TaskContext.get().partitionId() % SALTS)
    return run


def _rows(held: dict, salt: int):
    for (i, j), m in held.items():
        yield pa.RecordBatch.from_arrays(
            [pa.array([i], pa.int32()), pa.array([j], pa.int32()), pa.array([salt], pa.int32()),
             pa.array([m.tobytes()], pa.binary())], names=["i", "j", "salt", "moments"])


def _nothing(width: int):
    """Accumulators of no rows, so that every pair of blocks has one."""
    size = [min(SIDE, width - k) for k in range(0, width, SIDE)]

    def run(batches):
        for b in batches:
            if b.num_rows:
                yield from _rows({(i, j): np.zeros((_PARTS, size[i], size[j]))
                                  for i in range(len(size)) for j in range(i, len(size))}, 0)
    return run


def _shape(blob: bytes, i: int, j: int, width: int) -> np.ndarray:
    a, b = min(SIDE, width - i * SIDE), min(SIDE, width - j * SIDE)
    return np.frombuffer(blob).reshape(_PARTS, a, b)


def _combine(width: int):
    """Merge rows that come sorted by (i, j)."""
    def run(batches):
        here, held = None, None
        for b in batches:
            for i, j, salt, blob in zip(*[c.to_pylist() for c in b.columns]):
                m = _shape(blob, i, j, width)
                if here and here[:2] == (i, j):
                    held = _merged(held, m)
                    continue
                if here:
                    yield from _rows({here[:2]: held}, here[2])
                here, held = (i, j, salt), m
        if here:
            yield from _rows({here[:2]: held}, here[2])
    return run


def pair_moments(df: DataFrame, columns: list[str]) -> DataFrame:
    """(i, j, salt, moments): a row per pair of column blocks, i <= j."""
    width = len(columns)
    x = df.select(*[F.col(f"`{c}`").cast("double").alias(f"c{k}") for k, c in enumerate(columns)])
    parts = x.mapInArrow(_accumulate(width), _KIND).unionAll(
        df.sparkSession.range(1).mapInArrow(_nothing(width), _KIND))
    parts = parts.repartition("i", "j", "salt").sortWithinPartitions("i", "j", "salt").mapInArrow(_combine(width), _KIND)
    return parts.repartition("i", "j").sortWithinPartitions("i", "j").mapInArrow(_combine(width), _KIND)


def _correlations(columns: list[str]):
    width = len(columns)
    names = np.array(columns, object)

    def run(batches):
        for b in batches:
            for i, j, _, blob in zip(*[c.to_pylist() for c in b.columns]):
                n, ma, mb, qa, qb, c = _shape(blob, i, j, width)
                flat = (qa <= n * (_FLAT * np.abs(ma)) ** 2) | (qb <= n * (_FLAT * np.abs(mb)) ** 2)
                with np.errstate(all="ignore"):
                    r = np.clip(c / np.sqrt(qa) / np.sqrt(qb), -1, 1)
                r[flat | ~np.isfinite(r)] = np.nan
                rows, cols = np.nonzero(np.triu(np.ones(r.shape), 1) if i == j else np.ones(r.shape))
                v = r[rows, cols]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(names[rows + i * SIDE], pa.string()), pa.array(names[cols + j * SIDE], pa.string()),
                     pa.array(v, pa.float64(), mask=np.isnan(v))], names=["a", "b", "corr"])
    return run


def correlations(df: DataFrame, columns: list[str]) -> DataFrame:
    """(a, b, corr) for a before b in ``columns``: Pearson over the rows where
    both are present; null for no variance and where a value isn't finite."""
    return pair_moments(df, columns).mapInArrow(_correlations(columns), "a string, b string, corr double")
