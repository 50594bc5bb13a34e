"""Embedding near-dedup against brute force."""

import math

import numpy as np
import pytest

from sparkwright.llm import embedding_dedup
from tests.llm.helpers import clash


def vectors(n=500, dim=16, seed=4):
    rng = np.random.default_rng(seed)
    base = rng.standard_normal((40, dim))
    x = base[rng.integers(0, 40, n)] + 0.12 * rng.standard_normal((n, dim))
    return x.astype(np.float32)


def slow(ids, x, cosine=0.9):
    u = x.astype(float) / np.linalg.norm(x.astype(float), axis=1, keepdims=True)
    link = u @ u.T >= cosine
    np.fill_diagonal(link, False)
    return link


@pytest.mark.parametrize("block", [2048, 5])
def test_recall_and_components(spark, block):
    x = vectors()
    x[50] = x[51] = x[52]
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id bigint, embedding array<float>")
    got = {r["vec_id"]: r for r in embedding_dedup.near_duplicates(clash(df), block=block).collect()}
    link = slow(range(len(x)), x)
    found, there = sum(r["n_links"] for r in got.values()), int(link.sum())
    assert 0.95 * there <= found <= there
    assert all(got[i]["n_links"] <= link[i].sum() for i in got)
    assert all(got[i]["kept"] == (got[i]["component_id"] == i) for i in got)
    assert got[51]["component_id"] == got[50]["component_id"] <= 50 and got[51]["n_links"] >= 2
    # Dense groups: missing a link doesn't break a component.
    low = list(range(len(x)))
    for _ in range(20):
        low = [min([low[i], *(low[j] for j in np.flatnonzero(link[i]))]) for i in range(len(x))]
    same = sum(got[i]["component_id"] == low[i] for i in got)
    assert same >= 0.97 * len(x)


def test_blocks_find_the_same_links(spark):
    x = vectors(200)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id bigint, embedding array<float>")
    a, b = (sorted(tuple(r) for r in embedding_dedup.near_duplicates(df, bits=6, block=k).collect()) for k in (4, 500))
    assert a == b


def test_cases(spark):
    rows = [(1, [1.0, 0.0]), (2, [2.0, 0.0]), (3, [0.0, 1.0]), (4, None), (5, []), (6, [0.0, 0.0]), (7, [math.nan, 1.0]),
            (8, [math.inf, 1.0]), (9, [None, 1.0]), (10, [1.0, 0.0, 0.0]), (None, [1.0, 0.0]), (1, [1.0, 0.0]),
            (11, [-0.0, 5.0]), (12, [1e-300, 1e-300]), (13, [1e300, 1e300])]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    got = sorted((tuple(r) for r in embedding_dedup.near_duplicates(df).collect()), key=repr)
    want = [(1, 2, 1, True), (1, 2, 1, True), (2, 2, 1, False), (3, 1, 3, True), (11, 1, 3, False), (10, 0, 10, True),
            (None, 0, None, None), (12, 1, 12, True), (13, 1, 12, False)] + [(i, 0, i, True) for i in range(4, 10)]
    assert got == sorted(want, key=repr)
    assert embedding_dedup.near_duplicates(df.where("false")).count() == 0


def test_tables_for_recall():
    for bits in (4, 8, 12):
        p = (1 - math.acos(0.9) / math.pi) ** bits
        assert 1 - (1 - p) ** embedding_dedup.tables_for(bits) >= embedding_dedup.RECALL
