"""License scan by diagonal voting.

All rolling word k-gram hashes of a text are joined in Spark to the grams of a
fixed set of templates.  A hit at text word p and template word t lies on the
diagonal p - t, and the hits of one occurrence share a diagonal, so hits are
aggregated by (text, template, diagonal) into a bit per template gram.  A
diagonal with every bit is an exact occurrence.  Neighbouring incomplete
diagonals (words put in or left out) are merged and verified: the grams must
cover enough of the template's words within a span of about its length.

The gram table is broadcast: its size is that of the templates.  Only hits and
one row per text leave the map side.  Grams carry a second, independent hash,
compared after the join."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from sparkwright.llm.shared import KEY, query, row_key, same_key, slices, stage, table, text_or_empty
from sparkwright.llm.words import words_of

K = 3
#: Least share of a template's words that the merged diagonals must cover.
COVER = 0.75
#: Diagonals at most so far apart are neighbours.
NEIGHBOUR = 2
CHUNK = 1 << 20

# Fixed phrases of the contract: label and words.
BASE = (("mit", "under the mit license"), ("apache-2", "apache license version 2"), ("cc-by-nc", "cc by nc"))
# Templates of the method: label and a characteristic sentence of the notice.
NOTICES = (
    ("all-rights-reserved", "all rights reserved"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and "
            "associated documentation files the software to deal in the software without restriction"),
    ("mit", "released under the mit license"),
    ("apache-2", "licensed under the apache license version 2 0"),
    ("apache-2", "you may not use this file except in compliance with the license you may obtain a copy of the "
                 "license at"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted "
            "provided that the following conditions are met"),
    ("cc-by-nc", "licensed under cc by nc 4 0"),
    ("cc-by-sa", "licensed under cc by sa 4 0"),
    ("gpl-3", "this work is licensed under the gnu general public license version 3"),
    ("gpl", "you can redistribute it and or modify it under the terms of the gnu general public license as "
            "published by the free software foundation"),
    ("mpl-2", "this source code form is subject to the terms of the mozilla public license v 2 0"),
)

_BASES = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F))  # two odd multipliers


def _powers(n: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Powers of both multipliers and of their inverses modulo 2**64."""
    if not _CACHE or len(_CACHE[0][0]) < n:
        n, fresh = max(n, CHUNK), []
        for base in _BASES:
            inverse = np.uint64(pow(int(base), -1, 1 << 64))
            fresh.append(tuple(np.cumprod(np.concatenate([[np.uint64(1)], np.full(n, b, np.uint64)]))
                               for b in (base, inverse)))
        if n > 4 * CHUNK:
            return fresh  # one very long chunk; not kept
        _CACHE[:] = fresh
    return _CACHE


_CACHE: list = []


def gram_hashes(words: list[bytes], k: int = K) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit rolling hashes of each k consecutive words (joined by
    blanks): differences of prefix sums, shifted back to the gram's start."""
    if len(words) < k:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    flat = np.frombuffer(b" ".join(words), np.uint8).astype(np.uint64)
    size = np.fromiter(map(len, words), np.int64, len(words))
    end = np.cumsum(size + 1) - 1
    start, stop = (end - size)[: len(words) - k + 1], end[k - 1:]
    out = []
    for power, inverse in _powers(len(flat) + 1):
        total = np.concatenate([[np.uint64(0)], np.cumsum((flat + np.uint64(1)) * power[: len(flat)])])
        h = (total[stop] - total[start]) * inverse[start]
        h ^= h >> np.uint64(31)
        h *= np.uint64(0xFF51AFD7ED558CCD)
        h ^= h >> np.uint64(33)
        out.append(h.view(np.int64))
    return out[0], out[1]


def _grams(k: int):
    """Rows (key, pos, h1, h2) of every gram, and one with pos = -1 per text
    that carries its number of words as h2."""
    def emit(rows):
        """rows: (key, first word's number, words, words in all, last part?)"""
        flat = [w for r in rows for w in r[2]]
        h1, h2 = gram_hashes(flat, k)
        # Grams that reach into the next text are left out; then the summaries.
        sizes = np.array([len(r[2]) for r in rows])
        own = np.repeat(np.arange(len(rows)), sizes)
        at = np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        ok = np.flatnonzero(at[: len(h1)] + k <= sizes[own[: len(h1)]]) if len(h1) else np.zeros(0, np.int64)
        last = np.flatnonzero([r[4] for r in rows])
        row = np.concatenate([own[ok], last])
        first = np.array([r[1] for r in rows])
        pos = np.concatenate([at[ok] + first[own[ok]], np.full(len(last), -1)])
        total = np.array([r[3] for r in rows])
        keys = pa.RecordBatch.from_pylist([r[0] for r in rows], schema=KEY_SCHEMA).take(pa.array(row))
        return pa.RecordBatch.from_arrays(
            [*keys.columns, pa.array(pos.astype(np.int64)), pa.array(np.concatenate([h1[ok], np.zeros(len(last), np.int64)])),
             pa.array(np.concatenate([h2[ok], total[last]]))], names=[*KEY, "pos", "h1", "h2"])

    def run(batches):
        for b in slices(batches):
            rows, held = [], 0
            keys = b.select(KEY).to_pylist()
            for key, text in zip(keys, b.column("text").to_pylist()):
                words = words_of(text)
                # A long text goes in parts that share k - 1 words.
                step = CHUNK // 8
                starts = range(0, max(1, len(words) - k + 1), step)
                for s in starts:
                    part = words[s: s + step + k - 1]
                    rows.append((key, s, part, len(words), s + step >= max(1, len(words) - k + 1)))
                    held += sum(map(len, part)) + len(part)
                    if held >= CHUNK:
                        yield emit(rows)
                        rows, held = [], 0
            if rows:
                yield emit(rows)
    return run


KEY_SCHEMA = pa.schema([("k_id", pa.int64()), ("k_h1", pa.int64()), ("k_h2", pa.int32()), ("k_len", pa.int32())])
KEY_DDL = "k_id bigint, k_h1 bigint, k_h2 int, k_len int"


def template_grams(spark: SparkSession, templates, k: int = K) -> DataFrame:
    """(tpl, label, base, tpos, t1, t2, n_grams): one row per template gram."""
    rows = []
    for tpl, (label, text, base) in enumerate(templates):
        h1, h2 = gram_hashes(words_of(text), k)
        if not 0 < len(h1) < 63:
            raise ValueError(f"a template holds {k} to {k + 61} words: {text}")
        rows += [(tpl, label, base, t, int(a), int(b), len(h1)) for t, (a, b) in enumerate(zip(h1, h2))]
    literal = ", ".join(f"({t}, '{lab}', {str(b).lower()}, {p}, {x}L, {y}L, {n})" for t, lab, b, p, x, y, n in rows)
    return spark.sql(f"select * from values {literal} as g(tpl, label, base, tpos, t1, t2, n_grams)")


def occurrences(hits: DataFrame, k: int = K) -> DataFrame:
    """Verified spans of hits (key, tpl, label, base, pos, tpos, n_grams):
    key, tpl, label, base, first and last word, cover and exact."""
    group = [*KEY, "tpl", "label", "base", "n_grams"]
    bit = F.expr("shiftleft(1L, tpos)")
    diagonals = (hits.withColumn("diagonal", F.col("pos") - F.col("tpos")).groupBy(*group, "diagonal")
                 .agg(F.bit_or(bit).alias("bits"), F.min("pos").alias("low"), F.max("pos").alias("high"))
                 .withColumn("exact", F.col("bits") == F.expr("shiftleft(1L, n_grams) - 1")))
    per = W.partitionBy(*KEY, "tpl", "exact").orderBy("diagonal")
    apart = F.col("exact") | (F.col("diagonal") - F.lag("diagonal", 1).over(per) > NEIGHBOUR)
    run = F.sum(F.when(F.coalesce(apart, F.lit(True)), 1).otherwise(0)).over(
        per.rowsBetween(W.unboundedPreceding, 0))
    # A word is covered by each gram that holds it.
    words = F.expr("bit_count(" + " | ".join(f"shiftleft(bits, {i})" for i in range(k)) + ")")
    merged = (diagonals.withColumn("run", run).groupBy(*group, "exact", "run")
              .agg(F.bit_or("bits").alias("bits"), F.min("low").alias("low"), F.max("high").alias("high"),
                   (F.max("diagonal") - F.min("diagonal")).alias("shift")))
    size = F.col("n_grams") + (k - 1)
    return (merged.withColumn("cover", words / size)
            .where(F.col("exact") | ((F.col("cover") >= COVER)
                                     & (F.col("high") - F.col("low") + k <= size + F.col("shift"))))
            .select(*KEY, "tpl", "label", "base", F.col("low").alias("first"), (F.col("high") + k - 1).alias("last"),
                    F.least("cover", F.lit(1.0)).alias("cover"), "exact"))


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", base=BASE, notices=NOTICES,
         k: int = K) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_words, and ``spans``, an array of
    (first, last, label, base, cover, exact) by position: words from 0, last
    included; base marks the contract's phrases.

    Null and empty texts have no words and no spans; repeated rows and null
    ids are scanned like any others; an empty table gives an empty one; extra
    columns are ignored."""
    spark = docs.sparkSession
    grams = template_grams(spark, [(lab, t, True) for lab, t in base] + [(lab, t, False) for lab, t in notices], k)
    rows = (docs.select(*row_key(id_col, text_col), text_or_empty(text_col).alias("text"))
            .withColumn("k_id", F.col("k_id").cast("bigint"))
            .mapInArrow(_grams(k), f"{KEY_DDL}, pos bigint, h1 bigint, h2 bigint"))
    # Bounded by the template list, so it is broadcast; a gram whose second
    # hash differs is no hit.
    met = (rows.join(F.broadcast(grams), rows["h1"] == grams["t1"], "left")
           .where("pos = -1 or h2 = t2")
           .select(*KEY, "pos", F.col("h2").alias("n_words"), "tpl", "label", "base", "tpos", "n_grams"))
    met = stage(met, "grams-met")
    texts = met.where("pos = -1").select(*KEY, "n_words")
    spans = occurrences(met.where("pos >= 0"), k)
    spans = spans.groupBy(*KEY).agg(F.array_sort(F.collect_list(
        F.struct("first", "last", "label", "base", "cover", "exact"))).alias("spans"))
    none = F.array().cast("array<struct<first:bigint,last:bigint,label:string,base:boolean,cover:double,exact:boolean>>")
    return (texts.join(spans, same_key(texts, spans), "left")
            .select(texts["k_id"].alias("doc_id"), "n_words", F.coalesce("spans", none).alias("spans")))


@query("op4_license_scan")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan(table(spark, sf_dir, "documents"))
    exact = F.filter("spans", lambda s: s["base"] & s["exact"])
    names = lambda spans: F.array_join(F.array_sort(F.array_distinct(F.transform(
        spans, lambda s: s["label"]))), ",")
    rows = found.withColumn("places", exact)
    return rows.select(
        "doc_id", "n_words", F.size("places").cast("bigint").alias("n_base"),
        F.array_min(F.transform("places", lambda s: s["first"])).alias("first_word"),
        F.array_max(F.transform("places", lambda s: s["first"])).alias("last_word"),
        names(F.col("places")).alias("base_labels"), names(F.col("spans")).alias("labels"),
        F.coalesce(F.array_max(F.transform("spans", lambda s: s["cover"])), F.lit(0.0)).alias("score"))
