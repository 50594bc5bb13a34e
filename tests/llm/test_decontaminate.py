"""Benchmark decontamination: exact and paraphrased leaks, clean texts, parts."""

import random

import numpy as np
import pyarrow as pa

from sparkwright.llm import decontaminate as D
from sparkwright.llm.words import words_of
from tests.conftest import SF_ORACLE
from tests.llm.helpers import clash, docs, prose


def slow_lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        new = [0]
        for j, y in enumerate(b):
            new.append(row[j] + 1 if x == y else max(row[j + 1], new[-1]))
        row = new
    return row[-1]


def test_common_subsequence():
    rng = np.random.default_rng(1)
    for _ in range(200):
        a, b = rng.integers(1, 6, rng.integers(1, 40)), rng.integers(0, 6, rng.integers(0, 60))
        assert D.common(a, b) == slow_lcs(a.tolist(), b.tolist())


def corpus(seed=0):
    rng = random.Random(seed)
    words = prose(4000, seed, 3000).split()
    items = [" ".join(rng.choice(words) for _ in range(rng.randint(15, 50))) for _ in range(30)]
    texts = [" ".join(rng.choice(words) for _ in range(rng.randint(1, 400))) for _ in range(120)]
    return rng, words, items, texts


def test_leaks_and_clean_texts(spark):
    rng, words, items, texts = corpus()
    want = set()
    for k, item in enumerate(items):
        # Exact, recased with punctuation, and a paraphrase with a word in eight changed.
        w = item.split()
        edited = [x if i % 8 != 3 else rng.choice(words) for i, x in enumerate(w)]
        for version in (item, ", ".join(w).upper() + ".", " ".join(edited)):
            want.add((len(texts), k))
            texts.append(f"{texts[k]} {version} {texts[k + 40]}")
    df = clash(docs(spark, texts + [None, "", " ", "word"]))
    bench = spark.createDataFrame([*enumerate(items), (90, None), (91, ""), (None, "lost item"), (92, items[0])],
                                  "item_id bigint, text string")
    got = {(r["k_id"], r["item_id"]): r for r in D.leaks(df, bench).collect()}
    assert not set(got) - want  # clean texts stay clean
    missed = want - set(got)
    assert len(missed) <= 3 and all((d - 120) % 3 == 2 for d, _ in missed)  # of 30 paraphrases
    clean = D.without_leaks(df, bench)
    assert clean.dtypes == df.dtypes
    assert {r["doc_id"] for r in clean.collect()} == set(range(len(texts) + 4)) - {d for d, _ in got}
    # The benchmark in parts gives the same.
    parts = {(r["k_id"], r["item_id"]) for r in D.leaks(df, bench, items_at_once=8).collect()}
    assert len(parts ^ set(got)) <= 3


def finder_of(items, texts):
    """Word codes, a finder with weights of the texts and their code arrays."""
    vocab = D.vocabulary(items)
    code = [np.array([vocab.get(w, 0) for w in words_of(t.lower())], "<i4") for t in items + texts]
    seen = np.bincount(np.concatenate(code[len(items):]), minlength=len(vocab) + 1)
    idf = np.log((len(texts) * 10 + 1) / (seen + 1)) + 1
    directions = np.linalg.qr(np.random.default_rng(5).standard_normal((len(vocab) + 1, 40)))[0]
    return D.Retriever([D.Item(k, c.astype(np.int64)) for k, c in enumerate(code[:len(items)])], idf, directions), code[len(items):]


def every_alignment(finder, codes):
    """Items and starts by all windows against all windows, no bound used."""
    out = set()
    for k, item in enumerate(finder.items):
        size = min(D.WINDOW, len(item.codes))
        text, query = finder._windows(codes, size), finder._windows(item.codes, size)
        for at, offset in zip(*np.nonzero(text @ query.T >= D.COSINE)):
            cover, answer = finder.verify(item, codes, at - offset)
            if cover >= D.WHOLE or (cover >= D.COVER and answer >= D.ANSWER):
                out.add((k, int(at - offset)))
    return out


def test_no_alignment_is_left_out():
    """A word in three changed: everything that cosine, cover and answer
    accept is found, with the same starts."""
    rng, words, items, texts = corpus(4)
    for k, item in enumerate(items):
        edited = [x if rng.random() > 1 / 3 else rng.choice(words + ["other", "new"]) for x in item.split()]
        texts[k] = f"{texts[k]} {' '.join(edited)} {texts[k + 40]}"
    finder, codes = finder_of(items, texts)
    sizes = np.array([len(c) for c in codes])
    got = {}
    for t, k, low, high in finder.regions(np.concatenate(codes), sizes):
        for start, *_ in finder.matches(codes[t], k, low, high):
            got.setdefault(t, set()).add((k, start))
    want = {t: found for t, c in enumerate(codes) if (found := every_alignment(finder, c))}
    assert got == want
    assert sum(any(k == t for k, _ in got.get(t, ())) for t in range(30)) >= 18


def test_short_items_inside_long_texts(spark):
    """Word-for-word copies of items of 1 to 12 words, the item's words rare
    or common in the corpus, at both ends and in the middle of a text."""
    rng = random.Random(8)
    fill = [f"f{i}" for i in range(300)]
    common = [f"c{i}" for i in range(400)]
    items = [" ".join(rng.sample(common, n)) if k % 2 else " ".join(f"r{n}x{k}x{i}" for i in range(n))
             for n in range(1, 13) for k in range(4)]
    texts, want = [" ".join(rng.choice(fill + common) for _ in range(100)) for _ in range(40)], set()
    for k, item in enumerate(items):
        left, right = (" ".join(rng.choice(fill) for _ in range(250)) for _ in range(2))
        for text in (f"{left} {item} {right}", f"{left} {item}", f"{item} {right}", item):
            want.add((len(texts), k))
            texts.append(text)
    bench = spark.createDataFrame(list(enumerate(items)), "item_id bigint, text string")
    found = D.leaks(docs(spark, texts), bench).collect()
    assert want <= {(r["k_id"], r["item_id"]) for r in found}


def test_light_and_partly_known_windows_are_verified(spark):
    """An item of common words, beside items of rare ones, with every third
    word changed to an unknown one: no weight of words keeps it out."""
    common = [f"w{i}" for i in range(60)]
    rng = random.Random(6)
    fill = [" ".join(rng.choice(common) for _ in range(200)) for _ in range(60)]
    item = " ".join(rng.sample(common, 30))
    rare = " ".join(f"rare{i}" for i in range(30))
    edited = " ".join(w if i % 3 != 1 else f"odd{i}" for i, w in enumerate(item.split()))
    df = docs(spark, [*fill, " ".join(f"new{i}" for i in range(100)) + " " + edited])
    bench = spark.createDataFrame([(0, item), (1, rare)], "item_id bigint, text string")
    assert (60, 0) in {(r["k_id"], r["item_id"]) for r in D.leaks(df, bench).collect()}


def test_repeated_and_unnamed_rows(spark):
    item = prose(30, 2)
    df = docs(spark, [(1, item), (1, item), (None, item + " tail"), (2, prose(80, 3))])
    bench = spark.createDataFrame([(5, item)], "item_id bigint, text string")
    assert sorted((r["k_id"] for r in D.leaks(df, bench).collect()), key=str) == [1, 1, None]
    assert [r["doc_id"] for r in D.without_leaks(df, bench).collect()] == [2]


def test_empty_tables(spark):
    none = docs(spark, [])
    bench = spark.createDataFrame([(5, prose(30))], "item_id bigint, text string")
    assert D.leaks(none, bench).count() == 0
    assert D.leaks(docs(spark, ["a b"]), bench.where("false")).count() == 0
    assert D.without_leaks(docs(spark, ["a b"]), bench.where("false")).count() == 1


def test_randomised_decomposition_spans_the_leading_directions(spark):
    rng = np.random.default_rng(3)
    topics = [list(range(1 + 20 * t, 21 + 20 * t)) for t in range(3)]
    rows = []
    for i in range(300):
        rows.append((i, rng.choice(topics[i % 3], 40).astype("<i4").tobytes()))
    df = spark.createDataFrame(rows, "k_id bigint, codes binary").repartition(3)
    idf, u = D.latent_directions(df, 60, sketch=12, rank=3)
    assert np.allclose(u.T @ u, np.eye(3), atol=1e-4)
    # Exact right singular vectors of the same weighted matrix.
    a = np.zeros((300, 61))
    for i, c in rows:
        code, n = np.unique(np.frombuffer(c, "<i4"), return_counts=True)
        a[i, code] = (1 + np.log(n)) * idf[code]
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    v = np.linalg.svd(a)[2][:3]
    assert np.linalg.svd(v @ u)[1].min() > 0.95


def test_all_planted_items_are_found(spark):
    """Every document that holds a benchmark text word for word is found."""
    t = spark.read.parquet(f"{SF_ORACLE}/documents.parquet")
    b = spark.read.parquet(f"{SF_ORACLE}/benchmark.parquet")
    items = {r["item_id"]: b" ".join(words_of(r["text"].lower())) for r in b.collect()}
    want = set()
    for r in t.collect():
        flat = b" ".join(words_of(r["text"].lower()))
        want |= {(r["doc_id"], i) for i, x in items.items() if b" " + x + b" " in b" " + flat + b" "}
    got = {(r["doc_id"], r["item_id"]) for r in D.op7(spark, SF_ORACLE).collect()}
    assert want and got == want


def test_codes_cover_the_whole_text():
    text = prose(50_000, 4)
    vocab = D.vocabulary([text])
    batch = pa.RecordBatch.from_pylist([{"k_id": 1, "k_h1": 1, "k_h2": 1, "k_len": 1, "text": text}])
    out = next(D._code(vocab)([batch]))
    assert len(np.frombuffer(out.column("codes")[0].as_py(), "<i4")) == 50_000
