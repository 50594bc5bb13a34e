"""Merkle manifest: against a plain version of the tree, its proofs and folds."""

import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from sparkwright.llm import merkle

from .helpers import DOC, clash

H = lambda s: hashlib.sha256(s.encode()).hexdigest()


def leaf(r, text=None):
    vals = [r[0], r[3], r[2], r[4], r[1] if text is None else text]
    return H("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in vals))


def levels_of(nodes):
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([H("".join(out[-1][i:i + 16])) for i in range(0, len(out[-1]), 16)])
    return out


def siblings(levels, i):
    out = []
    for here in levels[:-1]:
        first = i // 16 * 16
        out += [h for k, h in enumerate(here[first:first + 16], first) if k != i]
        i //= 16
    return out


def fold(levels, i, node):
    for here in levels[:-1]:
        first = i // 16 * 16
        run = here[first:first + 16]
        run[i - first] = node
        node, i = H("".join(run)), i // 16
    return node


def plain(rows):
    """doc, leaf, subroot, root, proof, folded, verified by the definition."""
    low = {ord(c): c.lower() for c in merkle.UPPER}
    groups = {}
    for r in rows:
        groups.setdefault(r[3], []).append(r)
    names = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for s in names:
        groups[s].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
        trees[s] = levels_of([leaf(r) for r in groups[s]])
    top = levels_of([trees[s][-1][0] for s in names])
    root, out = top[-1][0], []
    for k, s in enumerate(names):
        for i, r in enumerate(groups[s]):
            node = leaf(r)
            if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 5 == 0 and r[1] is not None:
                node = leaf(r, r[1].translate(low))
            folded = fold(top, k, fold(trees[s], i, node))
            proof = "".join(siblings(trees[s], i) + siblings(top, k))
            out.append((r[0], leaf(r), trees[s][-1][0], root, proof, folded, folded == root))
    return sorted(out, key=repr)


def found(docs, part_size):
    chosen = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    got = merkle.multiproofs(merkle.leaves(docs, tamper=chosen), part_size)
    return sorted((tuple(r) for r in got.collect()), key=repr)


def table(n, sources):
    return [(i * 7 % n, f"Text {i} É" if i % 11 else None, "en" if i % 3 else None, sources[i % len(sources)],
             i if i % 5 else None) for i in range(n)]


@pytest.mark.parametrize("n, sources, part_size", [
    (1, ["a"], 4), (16, ["a"], 5), (17, ["a"], 16), (300, ["b", "a", "b", "b"], 7), (300, ["a"], 1),
    (90, [f"s{i}" for i in range(40)] + [None, "", "é", "Z"], 3), (600, ["hot"] * 9 + ["x", "y"], 64)])
def test_equals_the_plain_version(spark, n, sources, part_size):
    rows = table(n, sources)
    assert found(spark.createDataFrame(rows, DOC).repartition(5), part_size) == plain(rows)


def test_null_ids_repeats_empty_and_long_texts(spark):
    rows = [(None, "A", "en", "s", 1), (None, "A", "en", "s", 1), (3, "", "en", "s", 0), (3, "", "en", "s", 0),
            (3, "B", None, None, None), (5, "Long " * 100_000, "en", "s", 5), (5, "x", "en", "t", -5)] * 3
    assert found(spark.createDataFrame(rows, DOC), 4) == plain(rows)


def test_empty_table_and_clashing_names(spark):
    assert found(spark.createDataFrame([], DOC), 4) == []
    rows = table(60, ["a", "b"])
    extra = clash(spark.createDataFrame(rows, DOC)).withColumns(
        {c: F.lit("9") for c in ("part", "run", "seq", "g", "idx", "n", "a", "b", "leaf", "tampered", "level", "h")})
    assert found(extra, 8) == plain(rows)


def test_a_part_asks_for_brothers_of_its_ends_only(spark):
    rows = table(2000, ["a"])
    placed = merkle.placed_leaves(merkle.leaves(spark.createDataFrame(rows, DOC)), 100)
    runs = placed.select("part", "g", "a", "b", "n").distinct()
    asked = merkle._missing(runs, 3).groupBy("part", "level").count().collect()
    assert max(r["count"] for r in asked) <= 30
