"""Kneser-Ney language models against a dictionary version."""

import collections
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from sparkwright.llm import language_id as L
from tests.conftest import SF_ORACLE
from tests.llm.helpers import clash

DOC = "doc_id bigint, text string, lang string"


def slow_model(words, order):
    """Interpolated Kneser-Ney over words with marks: P(word) in one language."""
    raw = collections.Counter()
    for w, n in words.items():
        s = "\n" + w + "\n"
        for i in range(1, len(s)):
            for k in range(1, min(order, i + 1) + 1):
                raw[s[i - k + 1: i + 1]] += n
    count = {}
    for g, n in raw.items():
        opening = len(g) > 1 and g[0] == "\n"
        left = sum(1 for h in raw if len(h) == len(g) + 1 and h[1:] == g)
        count[g] = n if len(g) == order or opening else (left or n)
    discount = {}
    for k in range(1, order + 1):
        one, two = (sum(1 for g, a in count.items() if len(g) == k and a == x) for x in (1, 2))
        discount[k] = min(0.95, max(0.05, one / (one + 2 * two + 1e-9)))
    ends = collections.defaultdict(list)
    for g, a in count.items():
        ends[len(g), g[:-1]].append(a)

    def logp(word, size):
        s, total = "\n" + word + "\n", 0.0
        for i in range(1, len(s)):
            p = 1 / size
            for k in range(1, min(order, i + 1) + 1):
                g = s[i - k + 1: i + 1]
                after = ends.get((k, g[:-1]))
                if after:
                    p = (max(count.get(g, 0) - discount[k], 0) + discount[k] * len(after) * p) / sum(after)
            total += math.log(max(p, 1e-12))
        return total
    return logp, raw


def train(spark):
    rows = [(1, "the cat the dog then", "en"), (2, "der hund und die katze und", "de"), (3, "THE end, there", "en"),
            (4, "die das der", "de"), (5, None, "en"), (6, "ignored", None), (7, "", "en"), (8, "the cat", "en")]
    return spark.createDataFrame(rows, DOC).repartition(3)


def test_matches_definition(spark, monkeypatch):
    model = L.fit(train(spark))
    assert model.langs == ["de", "en"]
    texts = {"en": "the cat the dog then the end there the cat", "de": "der hund und die katze und die das der"}
    slow = {k: slow_model(collections.Counter(t.split()), L.ORDER) for k, t in texts.items()}
    size = len({g for _, raw in slow.values() for g in raw if len(g) == 1}) + 1
    probe = [b"the", b"und", b"theund", b"x", "ü".encode(), b"katze"]
    got = model.score_words(probe)
    for i, w in enumerate(probe):
        assert got[i, 2] == len(w.decode()) + 1
        for j, lang in enumerate(model.langs):
            assert got[i, j] == pytest.approx(slow[lang][0](w.decode(), size), rel=1e-4)


def test_probabilities_sum_to_one(spark):
    """Over all known characters and one unseen, after any context."""
    model = L.fit(train(spark))
    ids, _, _ = L.positions([b"the"], 1)
    assert len(model.ids[0]) >= 10
    chars = sorted({c for c in "the cat the dog then end there".replace(" ", "")})
    one = np.exp(model.score_words([c.encode() for c in chars])[:, 1])
    assert one.sum() < 1


def test_cases(spark):
    model = L.fit(train(spark))
    texts = [None, "", "123 !!", "the cat", "und die", "漢字", "the " * 20_000, "½ ²"]
    df = clash(spark.createDataFrame([(i, t, "zz") for i, t in enumerate(texts)] + [(3, "the cat", None), (None, "der", "en")], DOC))
    rows = L.identify(df, model).collect()
    assert len(rows) == 10
    got = {r["doc_id"]: r for r in rows}
    assert [got[i]["lang_pred"] for i in (0, 1, 2, 7)] == ["und"] * 4 and got[0]["score"] == 0.0
    assert got[3]["lang_pred"] == got[6]["lang_pred"] == "en" and got[4]["lang_pred"] == "de"
    assert got[5]["lang_pred"] in ("de", "en") and got[5]["rejected"] and got[5]["score"] < got[6]["score"]
    assert all(0 <= r["score"] <= 1 for r in rows)
    assert L.identify(df.where("false"), model).count() == 0


def test_no_training_texts(spark):
    model = L.fit(train(spark).where("false"))
    assert {r["lang_pred"] for r in L.identify(train(spark), model).collect()} == {"und"}


def test_counts_do_not_depend_on_partitions(spark, monkeypatch):
    a = L.fit(train(spark).repartition(1))
    b = L.fit(train(spark).repartition(7))
    for x, y in zip(a.ids + a.alpha + a.gamma, b.ids + b.alpha + b.gamma):
        assert np.allclose(x, y)


def test_different_ngrams_stay_apart(spark):
    """More n-grams of an order than 21-bit ids can tell apart by far."""
    words = ["".join(chr(0x4E00 + (i * 7 + j * 131 + i * i * j) % 20_000) for j in range(40)) for i in range(3_000)]
    grams = [{w[a: a + k] for w in ("\n" + x + "\n" for x in words) for a in range(len(w) - k + 1)} - {"\n"}
             for k in range(1, L.ORDER + 1)]
    model = L.fit(spark.createDataFrame([(i, w, "zh") for i, w in enumerate(words)], DOC))
    assert sum(map(len, grams)) > 200_000
    # The end mark alone is an n-gram too; the first mark is only a context.
    assert [len(x) for x in model.ids] == [len(grams[0]) + 1] + [len(g) for g in grams[1:]]


def test_a_model_that_is_not_held_gives_the_same(spark):
    texts = [None, "", "123 !!", "the cat", "und die", "漢字", "the " * 2_000, "½ ²", "the cat"]
    df = clash(spark.createDataFrame([(i, t, "zz") for i, t in enumerate(texts)] + [(3, "the cat", None)] * 2, DOC))
    held, joined = L.fit(train(spark)), L.fit(train(spark), held_cells=0)
    assert joined.table is not None and not joined.ids and held.table is None
    assert np.allclose(held.limit, joined.limit)
    a, b = (sorted(map(str, L.identify(df, m).withColumns(
        {c: F.round(c, 9) for c in ("score", "cross_entropy")}).collect())) for m in (held, joined))
    assert a == b and len(a) == 11
    assert L.identify(df.where("false"), joined).count() == 0


def test_a_held_model_writes_no_files(spark, monkeypatch):
    """Counts on the way were four tables in the shared folder, with a file per partition."""
    staged, counted = [], len(spark.sparkContext._jsc.getPersistentRDDs())
    monkeypatch.setattr(L, "stage", lambda df, name, _old=L.stage: staged.append(name) or _old(df, name))
    held = L.fit(train(spark))
    assert staged == [] and held.table is None
    # A model that is joined outlives its fit, so it alone is staged.
    assert L.fit(train(spark), held_cells=0).table is not None and staged[0] == "model" and set(staged) <= {"model", "slices"}
    assert len(spark.sparkContext._jsc.getPersistentRDDs()) == counted


def test_held_out_accuracy(spark):
    lang = {r["doc_id"]: r["lang"] for r in spark.read.parquet(f"{SF_ORACLE}/documents.parquet").collect()}
    rows = [r for r in L.op10(spark, SF_ORACLE).collect()]
    held = [r["lang_pred"] == lang[r["doc_id"]] for r in rows if r["held_out"]]
    assert len(rows) == len(lang) and len(held) > 250 and sum(held) >= 0.97 * len(held)


def test_all_training_texts_calibrate(spark):
    """The limit is that of all texts (4,000 were taken, by their ids' hashes)."""
    texts = ["the cat " + "the dog ran " * (i % 7) + ("zq" * (i % 50) if i % 11 == 0 else "") for i in range(4600)]
    model = L.fit(spark.createDataFrame([(i, t, "en") for i, t in enumerate(texts)], DOC))
    h = model.entropies(texts)[0][:, 0]
    assert model.limit[0] == pytest.approx(h.mean() + L.REJECT_SD * max(h.std(), 0.05), rel=1e-9)
