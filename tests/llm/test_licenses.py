"""License scan against brute force."""

import random
import re

from sparkwright.llm import licenses
from tests.llm.helpers import clash, docs, prose

WORD = re.compile("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def slow_words(t):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in t or ""))


def slow_places(t):
    w = slow_words(t)
    return sorted((i, lab) for lab, phrase in licenses.BASE for i in range(len(w))
                  if w[i:i + len(phrase.split())] == phrase.split())


def random_text(seed):
    rng = random.Random(seed)
    bits = ["under the MIT license", "Apache License, Version 2.0", "CC BY-NC 4.0", "cc by nc cc by nc", "É cc-by-nc",
            "under the", "mit license", "version 2", prose(8, seed), "İ ſ K", "\n", "under the MIT-license under the MIT"]
    return " ".join(rng.choice(bits) for _ in range(rng.randint(0, 12)))


def test_words():
    for s in range(30):
        assert [w.decode() for w in licenses.words_of(random_text(s))] == slow_words(random_text(s))


def test_base_places_match_brute_force(spark, tmp_path):
    texts = [None, "", "cc", "cc by", "cc by nc"] + [random_text(s) for s in range(150)] + [(4, "cc by nc"), (None, "cc by nc")]
    clash(docs(spark, texts)).write.parquet(f"{tmp_path}/documents.parquet")
    got = sorted((tuple(r[c] for c in ("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels"))
                  for r in licenses.op4(spark, str(tmp_path)).collect()), key=repr)
    want = []
    for i, t in enumerate(texts):
        i, t = t if isinstance(t, tuple) else (i, t)
        p = slow_places(t)
        want.append((i, len(slow_words(t)), len(p), p[0][0] if p else None, p[-1][0] if p else None,
                     ",".join(sorted({lab for _, lab in p}))))
    assert got == sorted(want, key=repr)


def test_merged_diagonals(spark):
    bsd = [t for lab, t in licenses.NOTICES if lab == "bsd"][0].split()
    edited = bsd[:8] + ["very"] + bsd[8:14] + bsd[15:]  # one word more, later one less
    texts = [" ".join(bsd), prose(50) + " " + " ".join(edited) + " " + prose(50), " ".join(bsd[:5]), " ".join(bsd[::-1])]
    got = {r["doc_id"]: r["spans"] for r in licenses.scan(docs(spark, texts)).collect()}
    assert [s["label"] for s in got[0]] == ["bsd"] and got[0][0]["exact"]
    assert [s["label"] for s in got[1]] == ["bsd"] and not got[1][0]["exact"] and got[1][0]["first"] == 50
    assert got[2] == [] and got[3] == []


def test_long_text_in_parts(spark, monkeypatch):
    words = prose(3000, 8).split()
    words[1500:1504] = "under the mit license".split()
    text = " ".join(words)
    monkeypatch.setattr(licenses, "CHUNK", 4096)  # runs in this process only
    grams = licenses._grams(3)
    import pyarrow as pa
    batch = pa.RecordBatch.from_pylist([{"k_id": 1, "k_h1": 2, "k_h2": 3, "k_len": 4, "text": text}],
                                       schema=licenses.KEY_SCHEMA.append(pa.field("text", pa.string())))
    rows = [r for b in grams([batch]) for r in b.to_pylist()]
    h1, h2 = licenses.gram_hashes(licenses.words_of(text))
    assert sorted((r["pos"], r["h1"], r["h2"]) for r in rows if r["pos"] >= 0) == sorted(
        zip(range(len(h1)), h1.tolist(), h2.tolist()))
    assert [r["h2"] for r in rows if r["pos"] < 0] == [3000]


def test_empty(spark):
    assert licenses.scan(docs(spark, [])).count() == 0
