"""Connected components of a link table, by alternating star contraction.

Links are pairs of node ids.  Every round points each node's larger
neighbours, then its smaller ones, at the smallest node of its neighbourhood
(large-star, small-star); the table converges to one star per component.  The
minimum per node is a partial aggregate, so a hub node costs no single task;
each round is written to the shared folder."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkwright.llm.shared import stage


def forest(u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Star links with the same components as the links (u, v): every node but
    the smallest of its component, with that smallest node."""
    nodes, idx = np.unique(np.concatenate([u, v]), return_inverse=True)
    a, b = idx[: len(u)], idx[len(u):]
    parent = np.arange(len(nodes))
    while True:
        pa_, pb = parent[a], parent[b]
        differ = pa_ != pb
        if not differ.any():
            break
        a, b, pa_, pb = a[differ], b[differ], pa_[differ], pb[differ]
        low = np.minimum(pa_, pb)
        np.minimum.at(parent, pa_, low)
        np.minimum.at(parent, pb, low)
        while True:
            up = parent[parent]
            if (up == parent).all():
                break
            parent = up
    moved = parent != np.arange(len(nodes))
    return nodes[moved], nodes[parent[moved]]


def _local_forest(batches):
    """Contract the links of each batch; the result has the same components."""
    for b in batches:
        u, v = b.column(0).to_numpy(), b.column(1).to_numpy()
        if len(u):
            x, y = forest(u, v)
            yield pa.RecordBatch.from_arrays([pa.array(x), pa.array(y)], names=["u", "v"])


def _both(e: DataFrame) -> DataFrame:
    return e.select("u", "v").unionAll(e.select(F.col("v").alias("u"), F.col("u").alias("v")))


def _state(e: DataFrame) -> tuple:
    """Row count and an order-free hash sum: equal for equal link tables."""
    r = e.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)")).alias("h")).first()
    return r["n"], r["h"]


def components(links: DataFrame, u: str = "u", v: str = "v") -> DataFrame:
    """(node, root): every node of ``links`` (two bigint columns) with the
    smallest node that it reaches.  Self links and repeats are allowed; a null
    end drops the link.  An empty table gives an empty table."""
    raw = links.select(F.col(u).alias("u"), F.col(v).alias("v")).where("u != v")
    e = stage(raw.mapInArrow(_local_forest, "u bigint, v bigint").distinct(), "links")
    before = _state(e)
    while before[0]:
        # Large star: neighbours above u point at the smallest node around u.
        n = _both(e)
        m = n.groupBy("u").agg(F.min("v").alias("m"))
        big = (n.where("v > u").join(m, "u")
               .select(F.col("v").alias("u"), F.least("u", "m").alias("v")).distinct())
        big = stage(big, "large-star")
        # Small star: u and its neighbours below point at the smallest of them.
        m = big.groupBy("u").agg(F.min("v").alias("m"))
        small = big.join(m, "u")
        e = stage(small.where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                  .unionAll(m.select("u", F.col("m").alias("v"))).distinct(), "small-star")
        after = _state(e)
        if after == before:
            break
        before = after
    return (e.select(F.col("u").alias("node"), F.col("v").alias("root"))
            .unionAll(e.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()))
