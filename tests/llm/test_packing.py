"""Harmonic packing: exact round trip through the public tokenizer."""

import random
import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from sparkwright.llm import packing
from tests.llm.helpers import clash, docs, prose

PATH = packing.tokenizer_path()
ODD = ["", " ", "a", "  two  spaces \n\n tabs\t", "it's I'll we've 'tis", "ünï çødé 漢字 😀 ​", "<|endoftext|>",
       "x <|endoftext|> y", "1234567890" * 30, "a" * 5000, "\x00\x1c\x85  end", "\r\n \r\n", "!?!?...--==" * 9]


@pytest.fixture(scope="module")
def reference():
    t = Tokenizer.from_file(PATH)
    return lambda text: [*t.encode(text or "", add_special_tokens=False).ids, 1]


def test_ids_equal_the_tokenizers_library(reference):
    rng = random.Random(2)
    letters = "abc ÀÉß\n\t'0129.,!?<|>漢😀 　\x1e"
    texts = ODD + ["".join(rng.choice(letters) for _ in range(200)) for _ in range(200)]
    for t in texts:
        assert [*packing.token_ids(t, PATH).tolist(), 1] == reference(t)


def check(rows, texts, reference, capacity):
    """texts: (id, text); every document is cut into pieces without gaps or
    overlaps, and every sequence holds its pieces without gaps."""
    want = {}
    for i, t in texts:
        want.setdefault(i, []).append(reference(t))
    sequences = {}
    for r in rows:
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
        assert 1 <= r["length"] <= capacity
    used = []
    for pieces in sequences.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= capacity
        used.append(at)
    pieces = {}
    for r in rows:
        pieces.setdefault(r["doc_id"], []).append(r)
    assert set(pieces) == set(want)
    for i, group in want.items():
        ids = [np.array(g, "<u4") for g in group]
        assert sum(r["length"] for r in pieces[i]) == sum(map(len, ids))
        for r in pieces[i]:
            assert any(len(g) == r["doc_tokens"] and zlib.crc32(
                g[r["start"]: r["start"] + r["length"]].tobytes()) == r["ids_crc32"] for g in ids)
        if len(group) == 1:
            at = 0
            for r in sorted(pieces[i], key=lambda r: r["start"]):
                assert r["start"] == at
                at += r["length"]
    return used


@pytest.mark.parametrize("parts", [1, 9])
def test_round_trip(spark, reference, parts):
    texts = [*enumerate([None, *ODD, *(prose(n, n) for n in range(1, 1500, 53)), prose(9000, 3)])]
    texts += [(3, prose(40, 1)), (3, prose(40, 1)), (None, "no id")]
    df = clash(docs(spark, texts)).repartition(parts)
    rows = packing.pack(df, PATH).collect()
    used = check(rows, texts, reference, 2048)
    padding = sum(2048 - u for u in used if u & (u - 1))
    assert padding <= 0.02 * sum(used)


def test_cuts_fill_their_slots():
    for n in [*range(1, 2049), 2050, 9001, 50_000]:
        pieces = packing.cuts(n)
        assert sum(size for _, size in pieces) == n
        for j, size in pieces:
            slot = 2048 // j
            assert size <= slot and slot - size <= max(1, slot >> 6)


def test_empty_and_bad_capacity(spark):
    assert packing.pack(docs(spark, []), PATH).count() == 0
    with pytest.raises(ValueError):
        packing.pack(docs(spark, []), PATH, capacity=1000)


BLANKS = [" ", "\n", "\t", " ", "　", "\r\n", " \n\t  "]


def test_long_runs_give_the_same_ids(reference):
    texts = [x * (30_000 // len(x)) for x in [*BLANKS, "a", "abc", "7", "!", "?!-", "́", "\x1c"]]
    texts += [t + end for t in texts[:7] for end in ("x", "7", "!", "<|endoftext|>", "<|endoftext|>  b", "\x1c")]
    n = packing.LONG_BLANKS
    texts += ["a" + " " * k + "b" + "\n" * k + "<|endoftext|>" + " " * k for k in (n - 1, n, n + 1)]
    texts.append("x" + " " * n + "\x1c" + " " * n + " y" + "\n" * n + "\n" + " " * n)
    for t in texts:
        assert [*packing.token_ids(t, PATH).tolist(), 1] == reference(t)


@pytest.mark.parametrize("text", [" " * 3_000_000, "\n" * 3_000_000 + "x", "\t" * 3_000_000, " " * 1_000_000 + "1",
                                  "a" * 3_000_000, "7" * 3_000_000, "!" * 3_000_000, " \n" * 1_500_000 + " z"])
def test_millions_of_one_character(reference, text):
    assert [*packing.token_ids(text, PATH).tolist(), 1] == reference(text)


def test_long_blanks_go_through_pack(spark, reference):
    rows = list(enumerate([" " * 1_200_000 + "x", "\n" * 1_200_000, "plain"]))
    check(packing.pack(docs(spark, rows), PATH).collect(), rows, reference, packing.CAPACITY)


def test_other_tokenizer_files(tmp_path):
    """The file's normalizer and pre-tokenizer count: what isn't plain
    byte-level BPE runs on the tokenizers library."""
    import json
    with open(PATH, encoding="utf-8") as f:
        spec = json.load(f)
    assert packing._fast_form(spec)
    for name, change in {"lower": {"normalizer": {"type": "Lowercase"}},
                         "prefix": {"pre_tokenizer": spec["pre_tokenizer"] | {"add_prefix_space": True}},
                         "whole": {"pre_tokenizer": spec["pre_tokenizer"] | {"use_regex": False}}}.items():
        path = tmp_path / f"{name}.json"
        path.write_text(json.dumps(spec | change), encoding="utf-8")
        assert not packing._fast_form(spec | change)
        slow = Tokenizer.from_file(str(path))
        for t in ("Hello World", "  two Words\n", "x"):
            assert packing.token_ids(t, str(path)).tolist() == slow.encode(t, add_special_tokens=False).ids
