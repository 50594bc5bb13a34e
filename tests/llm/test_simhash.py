"""SimHash near-dedup against brute force."""

import random

import numpy as np
import pytest
import xxhash

from sparkwright.llm import simhash
from sparkwright.llm.components import components, forest
from tests.llm.helpers import clash, docs, prose


def slow_fingerprint(text, shingle=4):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    grams = [b" ".join(words[i:i + shingle]) for i in range(max(1, len(words) - shingle + 1))]
    h = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def slow_components(ids, prints, bits=4):
    parent = list(range(len(prints)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for i in range(len(prints)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= bits:
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
    low = {}
    for i, d in enumerate(ids):
        if d is not None:
            low[find(i)] = min(low.get(find(i), d), d)
    return [low.get(find(i)) for i in range(len(ids))]


def test_fingerprint_matches_definition():
    for t in [None, "", " \t\n", "One", "a B c", "a b c d", "É É x y z", prose(300), "a\x1cb c d e f", "x " * 70]:
        assert simhash.fingerprint(t) == slow_fingerprint(t)


def test_spark_hash_is_the_same(spark):
    from pyspark.sql import functions as F
    h = spark.range(1).select(F.xxhash64(F.lit("a b c d"))).first()[0]
    assert h % (1 << 64) == xxhash.xxh64_intdigest(b"a b c d", 42)


@pytest.mark.parametrize("block", [4096, 3])
def test_links_match_brute_force(spark, block):
    rng = random.Random(5)
    base = [rng.getrandbits(64) for _ in range(6)]
    prints = {0, (1 << 64) - 1}
    for b in base:
        for _ in range(25):
            x = b
            for k in rng.sample(range(64), rng.randint(0, 6)):
                x ^= 1 << k
            prints.add(x)
    prints = sorted(prints)
    signed = np.array(prints, np.uint64).view(np.int64).tolist()
    df = spark.createDataFrame([(x,) for x in signed], "fp bigint")
    got = components(simhash.near_links(df, 4, block)).collect()
    root = {r["node"]: r["root"] for r in got}
    groups = {}
    for x in signed:
        groups.setdefault(root.get(x, x), set()).add(x)
    want = {}
    for x, c in zip(signed, slow_components(range(len(prints)), prints)):
        want.setdefault(c, set()).add(x)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, want.values()))


def test_near_duplicates_cases(spark):
    t = prose(400, 1)
    near = t.replace(t.split()[7], "zzz", 1)
    texts = [t, near, prose(400, 2), None, "", " ", t, (0, t), (None, t), (None, prose(90, 9)), "one", "A b"]
    df = clash(docs(spark, texts))
    got = simhash.near_duplicates(df).collect()
    ids = [x[0] if isinstance(x, tuple) else i for i, x in enumerate(texts)]
    prints = [slow_fingerprint(x[1] if isinstance(x, tuple) else x) for x in texts]
    want = [(i, f"{p:016x}", c) for i, p, c in zip(ids, prints, slow_components(ids, prints))]
    key = lambda r: tuple((x is None, x) for x in r)
    assert sorted(((r["doc_id"], r["fingerprint"], r["component_id"]) for r in got), key=key) == sorted(want, key=key)


def test_empty_table(spark):
    e = docs(spark, [])
    assert simhash.near_duplicates(e).count() == 0
    assert simhash.keep_one(e).columns == e.columns


def test_keep_one(spark):
    t = prose(300, 3)
    df = clash(docs(spark, [(5, t), (3, t), (3, t), (None, "x y z"), (8, prose(300, 4))]))
    out = simhash.keep_one(df)
    assert out.columns == df.columns
    assert sorted((r["doc_id"] for r in out.collect()), key=str) == [3, 8, None]


def test_forest_and_components(spark):
    rng = random.Random(1)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)] + [(i, i + 1) for i in range(400, 470)]
    parent = {x: x for e in edges for x in e}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for a, b in edges:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    want = {x: find(x) for x in parent}
    u, v = forest(np.array([a for a, _ in edges]), np.array([b for _, b in edges]))
    got = dict(zip(u.tolist(), v.tolist()))
    assert all(got.get(x, x) == want[x] for x in want)
    df = spark.createDataFrame(edges + [(None, 3)], "u bigint, v bigint").repartition(7)
    slow = {r["node"]: r["root"] for r in components(df).collect()}
    assert all(slow.get(x, x) == want[x] for x in want)


def test_bits_out_of_range(spark):
    with pytest.raises(ValueError):
        simhash.near_links(spark.createDataFrame([], "fp bigint"), bits=5)


def test_keep_one_keeps_every_text_once(spark):
    """Ids 1, 1, 2, 3, 3 and two rows without one; five texts."""
    a, b, c, d, e = (prose(300, s) for s in (31, 32, 33, 34, 35))
    rows = [(1, a), (1, b), (2, a), (3, c), (3, d), (None, e), (None, e)]
    for df in (docs(spark, rows), clash(docs(spark, rows)).repartition(5)):
        out = simhash.keep_one(df)
        assert out.columns == df.columns
        assert sorted(((r["doc_id"], r["text"]) for r in out.collect()), key=repr) == sorted(
            [(1, a), (1, b), (3, c), (3, d), (None, e)], key=repr)


def test_keep_one_near_copies_and_ids(spark):
    a = prose(400, 41)
    near = a + " end"
    assert (simhash.fingerprint(a) ^ simhash.fingerprint(near)).bit_count() <= 4
    got = simhash.keep_one(docs(spark, [(None, a), (9, near), (4, prose(300, 42)), (9, near), (4, "")])).collect()
    # An id comes before none; the texts under id 4 differ.
    assert sorted((r["doc_id"], len(r["text"])) for r in got) == sorted([(9, len(near)), (4, len(prose(300, 42))), (4, 0)])
