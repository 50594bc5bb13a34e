"""Collocations against plain counting of all word windows."""

import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from sparkwright.llm import collocations

from .helpers import DOC, clash

LOW = {c: c + 32 for c in range(65, 91)}


def plain(rows, least, longest=5, top=2000, covered=100):
    f, n = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\x0a-\x0d]", (text or "").translate(LOW)):
            w = re.findall("[^\x20\x09]+", piece)
            n[lang] += len(w)
            f.update((lang, tuple(w[i:i + k])) for i in range(len(w)) for k in range(1, longest + 1) if i + k <= len(w))
    frequent = {p: c for p, c in f.items() if c >= least}
    out = {}
    for (lang, w), a in frequent.items():
        if len(w) < 2:
            continue
        inside = any(g == lang and len(v) > len(w) and 100 * b >= covered * a
                     and any(v[i:i + len(w)] == w for i in range(len(v))) for (g, v), b in frequent.items())
        if not inside:
            cuts = [(1000 * a * n[lang] // (f[lang, w[:k]] * f[lang, w[k:]]), k) for k in range(1, len(w))]
            score, k = min(cuts)
            out.setdefault(lang, []).append((-score, -a, " ".join(w).encode(), f[lang, w[:k]], f[lang, w[k:]]))
    return sorted((lang, rank, p.decode(), -a, l, r, n[lang], -s) for lang, found in out.items()
                  for rank, (s, a, p, l, r) in enumerate(sorted(found)[:top], 1))


def got(docs, least, sheet=1 << 21, top=2000):
    found = collocations.best(collocations.collocations(docs, least=least, sheet=sheet), top)
    return sorted(tuple(r) for r in found.select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect())


def corpus(seed, n=120):
    rng = random.Random(seed)
    words = ["the", "New", "York", "of", "a", "bé", "x1", "city", "100%", "_", "z\\"]
    rows = []
    for i in range(n):
        parts = [rng.choice(words) if rng.random() < .7 else "New York City of\tx1" for _ in range(rng.randint(0, 60))]
        text = "".join(p + rng.choice([" ", " ", " ", "  ", ". ", "\n", ",", "\x0b"]) for p in parts)
        rows.append((i, None if i % 17 == 3 else text, rng.choice(["en", "en", "fr", None, "und"]), "s", 0))
    return rows


@pytest.mark.parametrize("seed, sheet", [(1, 1 << 21), (2, 40), (3, 1)])
def test_equals_plain_counts(spark, seed, sheet):
    rows = corpus(seed)
    docs = spark.createDataFrame(rows, DOC).repartition(3)
    want = plain([(r[2], r[1]) for r in rows], 5)
    assert want and got(docs, 5, sheet) == want


def test_top_and_ties(spark):
    rows = [(i, f"p{i % 9} q{i % 9}. r s", "en", "s", 0) for i in range(90)]
    docs = spark.createDataFrame(rows, DOC)
    assert got(docs, 10, top=4) == plain([(r[2], r[1]) for r in rows], 10, top=4)


def test_overlaps_borders_and_long_texts(spark):
    rows = [(0, "a " * 50_000, "en", "s", 0), (1, "a.a a!a", "en", "s", 0), (2, "", "en", "s", 0), (3, None, None, "s", 0),
            (4, ". , ;", "de", "s", 0), (5, "b " * 20_000 + "c", "en", "s", 0)]
    docs = spark.createDataFrame(rows, DOC)
    assert got(docs, 100, sheet=1000) == plain([(r[2], r[1]) for r in rows], 100)


def test_empty_and_clashing_names(spark):
    assert got(spark.createDataFrame([], DOC), 1) == []
    assert got(spark.createDataFrame([(1, "only. one. words", "en", "s", 0)], DOC), 1) == []
    rows = corpus(7, 60)
    docs = clash(spark.createDataFrame(rows, DOC)).withColumns(
        {c: F.lit(9) for c in ("sheet", "blob", "no", "word", "n", "gid", "phrase", "a", "b", "f", "l", "r")})
    assert got(docs, 4) == plain([(r[2], r[1]) for r in rows], 4)


def test_packed_numbers_round_trip():
    import numpy as np
    rng = np.random.default_rng(1)
    for n in (0, 1, 2, 1000):
        for kind in ("<i4", "<i8"):
            x = rng.integers(-(1 << 30), 1 << 30, n).astype(kind)
            assert (collocations._unpack(collocations._pack(x), kind) == x).all()
        x = np.sort(rng.integers(0, 1 << 62, n))
        assert (collocations._risen(collocations._rising(x)) == x).all()
