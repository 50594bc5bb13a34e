"""Suffix-array dedup against all windows of all texts, and its sort against Python's."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from sparkwright.llm import suffix_dedup as sd

from .helpers import DOC, clash, docs, prose


def plain(rows):
    """(doc_id, n_bytes, removed spans, kept) for (id, text) rows in order."""
    seen, out = set(), []
    for doc, text in rows:
        raw = (text or "").encode()
        gone = np.zeros(len(raw), bool)
        mine = [raw[s:s + 100] for s in range(len(raw) - 99)]
        for s, w in enumerate(mine):
            if w in seen:
                gone[s:s + 100] = True
            seen.add(w)
        edge = np.flatnonzero(np.diff(np.r_[0, gone.astype(int), 0]))
        kept = bytes(np.frombuffer(raw, np.uint8)[~gone])
        out.append((doc, len(raw), [tuple(map(int, x)) for x in edge.reshape(-1, 2)], kept))
    return sorted(out, key=repr)


def got(frame, hot=None):
    return sorted(((r["doc_id"], r["n_bytes"], [tuple(s) for s in r["removed"]], bytes(r["kept"]))
                   for r in sd.dedup(frame, hot=hot).collect()), key=repr)


def corpus(seed, n=60):
    """Texts with copies, near copies, shared passages and texts that repeat themselves."""
    rng, out = random.Random(seed), []
    shared = [prose(rng.randint(10, 60), seed * 10 + k) for k in range(4)]
    for i in range(n):
        t = prose(rng.randint(0, 90), seed * 1000 + i)
        kind = rng.random()
        if kind < .3 and out:
            words = rng.choice(out).split(" ")
            for _ in range(rng.randint(0, 2)):
                words[rng.randrange(len(words))] = "changé"
            t = " ".join(words)
        elif kind < .7:
            cut = rng.randint(0, len(t))
            p = rng.choice(shared)
            t = t[:cut] + p[rng.randint(0, 40):len(p) - rng.randint(0, 40)] + t[cut:]
        elif kind < .8:
            t = t + t
        out.append(t)
    return out


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_equals_all_windows(spark, seed):
    texts = corpus(seed)
    frame = docs(spark, texts).repartition(4)
    want = plain(enumerate(texts))
    assert any(r[2] for r in want)
    assert got(frame) == want


def test_hot_grams_change_nothing(spark):
    line = prose(30, 5)
    texts = [prose(20, 100 + i) + line + prose(20, 200 + i) for i in range(80)]
    frame = docs(spark, texts).repartition(4)
    rows = frame.select(F.col("doc_id").alias("k_id"), F.lit(0).alias("k_h2"), F.lit(0).cast("bigint").alias("tie"), "text")
    hot = sd.hot_grams(rows, sample=1, spans=40)
    assert hot
    want = plain(enumerate(texts))
    assert got(frame, hot) == want and got(frame, []) == want


def test_runs_long_texts_and_pieces(spark, monkeypatch):
    texts = ["a" * 350, "b" * 99, "c" * 100, "c" * 101, "ab" * 200, "", None, "é" * 90, "x" + "é" * 90, "abc" * 300]
    assert got(docs(spark, texts)) == plain(enumerate(texts))
    long = prose(30_000, 9)
    texts = [" " * 300_000, long, long[50_000:150_000] + "!" + long[:1000], "\n" * 250_000 + "x"]
    assert len(long) > 150_000
    assert got(docs(spark, texts)) == plain(enumerate(texts))
    # Texts cut into pieces inside one task.
    raw = [t.encode() for t in (long, long[700:1900])]
    whole = sd.PIECE
    try:
        sd.PIECE = 700
        import pyarrow as pa
        batch = pa.RecordBatch.from_arrays([pa.array([0, 1]), pa.array([0, 0]), pa.array([long, long[700:1900]])],
                                           names=["k_id", "tie", "text"])
        blocks = list(sd._blocks([batch]))
    finally:
        sd.PIECE = whole
    starts = sorted((int(d), int(s) + k) for data, ends, doc, _, shift in blocks
                    for d, s, a, b in zip(doc, shift, np.r_[0, ends[:-1]], ends) for k in range(int(b - a) - 99))
    assert starts == [(d, k) for d in (0, 1) for k in range(len(raw[d]) - 99)]


def test_null_and_repeated_ids(spark):
    a, b = prose(60, 1), prose(60, 2)
    rows = [(None, a), (1, a), (1, a), (2, b), (2, b), (2, b), (3, "x" + b), (4, "short"), (4, "short")]
    frame = docs(spark, rows)
    found = got(frame)
    # The text without an id is first; of rows alike one keeps its text.
    assert sorted((r[0], r[3]) for r in found if r[0] is not None) == sorted(
        [(1, b""), (1, b""), (2, b.encode()), (2, b""), (2, b""), (3, b"x"), (4, b"short"), (4, b"short")])
    assert [r[3] for r in found if r[0] is None] == [a.encode()]
    # Different texts under one id: one of them is first.
    two = got(docs(spark, [(7, a + "1"), (7, a + "2")]))
    assert sorted(len(r[3]) for r in two) == [1, len(a) + 1]


def test_empty_table_and_clashing_names(spark):
    assert got(spark.createDataFrame([], DOC)) == []
    texts = corpus(4, 30)
    frame = clash(docs(spark, texts)).withColumns(
        {c: F.lit(9) for c in ("g", "h", "doc", "place", "lo", "hi", "kind", "tie", "data", "gone", "items", "end")})
    assert got(frame) == plain(enumerate(texts))


@pytest.mark.parametrize("seed", range(4))
def test_merge_sort_orders_suffixes(seed):
    rng = np.random.default_rng(seed)
    data = rng.integers(97, 99 + seed, 400).astype(np.uint8)
    start = np.sort(rng.integers(0, 400, 90))
    end = np.minimum(start + rng.integers(0, 40, 90), 400)
    group = np.sort(rng.integers(0, 5, 90))
    s = sd.Sorted(data, start, end, group)
    raw = [data[a:b].tobytes() for a, b in zip(start, end)]
    assert s.order.tolist() == sorted(range(90), key=lambda i: (group[i], raw[i]))
    for k in range(89):
        i, j = s.order[k], s.order[k + 1]
        same = group[i] == group[j]
        assert s.common[k] == (sd._plain_extension(raw[i], raw[j]) if same else -1)


def test_colliding_hashes_are_found(monkeypatch):
    """With a hash that says everything is equal, the bytes decide."""
    monkeypatch.setattr(sd.Prefixes, "of", lambda self, a, b: np.zeros(len(a), np.uint64))
    data = np.frombuffer(b"banana", np.uint8)
    start = np.arange(6)
    s = sd.Sorted(data, start, np.full(6, 6), np.zeros(6, np.int64))
    assert s.order.tolist() == [5, 3, 1, 0, 4, 2] and s.common.tolist() == [1, 3, 0, 0, 2]
