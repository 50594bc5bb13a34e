"""The pipeline against plain versions of its stages, and its edge cases."""

import re

import corpus_pipeline as C
import numpy as np
from tokenizers import Tokenizer

from sparkwright.llm import packing, quality, secrets, simhash
from sparkwright.llm.words import words_of
from tests.conftest import SF_SMOKE
from tests.llm.helpers import docs, prose


def slow_stages(spark, sf_dir):
    """Documents that are left after each of the first four stages: (id, text)."""
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    model = quality.fit(spark.read.parquet(f"{sf_dir}/documents.parquet"), quality.training_labels(spark, sf_dir))
    scores = model.score(np.array([quality.statistics(t) for _, t in rows]))
    rows = [r for r, s in zip(rows, scores) if s >= 0.3]
    yield rows
    prints = [simhash.fingerprint(t) for _, t in rows]
    group = list(range(len(rows)))
    for _ in range(len(rows)):
        new = [min(group[j] for j, q in enumerate(prints) if (p ^ q).bit_count() <= 4) for p in prints]
        new = [min(a, b) for a, b in zip(group, new)]
        if new == group:
            break
        group = new
    least = {}
    for (i, _), g in zip(rows, group):
        least[g] = min(least.get(g, i), i)
    rows = [r for r, g in zip(rows, group) if least[g] == r[0]]
    yield rows
    items = [b" ".join(words_of(r["text"].lower())) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    clean = lambda t: not any(b" " + x + b" " in b" " + b" ".join(words_of(t.lower())) + b" " for x in items)
    rows = [r for r in rows if clean(r[1])]
    yield rows
    one = "|".join(["(?i:(?:password|passwd|secret|token|api_?key))[\"']?\\x20*[:=]\\x20*[\"']?[A-Za-z0-9+/_.=-]{6,}",
                    "AKIA[A-Z0-9]{16,}", "[0-9a-f]{24,}"])
    yield [(i, re.sub(one, secrets.MASK, t, flags=re.A)) for i, t in rows]


def test_stages_match_plain_versions(spark):
    d = spark.read.parquet(f"{SF_SMOKE}/documents.parquet")
    columns = d.columns
    sizes = [d.count()]
    for (_, apply), want in zip(C.STAGES, slow_stages(spark, SF_SMOKE)):
        d = C.stage(apply(spark, d, SF_SMOKE), "test")
        assert d.columns == columns
        got = {r["doc_id"]: (r["text"], r["n_chars"]) for r in d.collect()}
        assert set(got) == {i for i, _ in want}
        assert all(got[i][0] == t for i, t in want)
        sizes.append(len(got))
    assert sizes[0] > sizes[1] > sizes[2] > sizes[3] == sizes[4]  # every filter takes effect
    t = Tokenizer.from_file(packing.tokenizer_path())
    tokens = {i: len(t.encode(x, add_special_tokens=False).ids) + 1 for i, x in want}
    packed = C.STAGES[4][1](spark, d, SF_SMOKE).collect()
    held = {}
    for r in packed:
        held[r["doc_id"]] = held.get(r["doc_id"], 0) + r["length"]
    assert held == tokens


def test_run_gives_the_packed_rows(spark):
    out = C.run(spark, SF_SMOKE)
    assert {"doc_id", "sequence_id", "offset", "length"} <= set(out.columns) and out.count() > 0


def test_odd_rows_go_through_every_stage(spark):
    odd = [None, "", " ", prose(40, 1) + ".", prose(40, 1) + ".", (3, prose(40, 1) + "."), (None, prose(30, 2) + "."),
           prose(30_000, 3) + "."]
    for table in (odd, []):
        d = docs(spark, table)
        for name, apply in C.STAGES:
            d = C.stage(apply(spark, d, SF_SMOKE), "odd")
    assert len(C.STAGES) == 5 and d.count() == 0


def test_long_blanks_and_repeated_ids_in_the_pipeline(spark, tmp_path):
    """A run of blanks ends no stage; texts that share an id, or have none, stay."""
    import shutil
    for name in ("benchmark", "labels", "documents"):
        shutil.copy(f"{SF_SMOKE}/{name}.parquet", tmp_path / f"{name}.parquet")
    good = spark.read.parquet(f"{SF_SMOKE}/documents.parquet")
    kept = C.quality_filter(spark, good, SF_SMOKE).orderBy("doc_id").limit(3).collect()
    a, b, c = (r["text"] for r in kept)
    rows = [(1, a), (1, b), (2, a), (None, c), (None, c)]
    d = C.near_dedup(spark, docs(spark, rows), SF_SMOKE)
    assert sorted((str(r["doc_id"]), r["text"]) for r in d.collect()) == sorted([("1", a), ("1", b), ("None", c)])
    long = docs(spark, [(7, " " * 1_500_000 + "end."), (8, "\n" * 1_500_000)])
    for name, apply in C.STAGES[1:]:
        long = C.stage(apply(spark, long, SF_SMOKE), "long")
    assert {r["doc_id"] for r in long.collect()} <= {7, 8} and long.count() > 0
