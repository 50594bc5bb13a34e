"""Benchmark decontamination by latent semantic retrieval.

The benchmark's words are the feature space; texts are turned into codes of
these words once.  Passages of the whole corpus are weighted by TF-IDF (passage
frequencies of all texts), and a randomised SVD of the passage-term matrix,
whose sketch is added up over all partitions, gives the latent directions.
A text leaks an item if one of its windows, at any word, is close by latent
cosine to a window of the item and the span aligned by the two holds the item:
the longest common subsequence of words must cover most of the item, and the
item's answer, its closing words, must be there too, so paraphrases with
changed, dropped or added words count and chance likeness does not.

Every alignment counts.  What is not computed is what a cover of 60 % rules
out: as few as 40 % of an item's words can be missing, so some of its rarest
ones must lie in the span (an inverted index of these finds where), and an
upper bound of the cover is taken before the cover itself.

Only the benchmark and what has the size of its vocabulary is broadcast, for
``items_at_once`` items at a time.  The corpus is shuffled nowhere; it sends
one row per vocabulary word and partition for the statistics and the sketch."""

from __future__ import annotations

from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkwright.llm.shared import KEY, query, release, row_key, same_key, slices, stage, table, text_or_empty
from sparkwright.llm.words import words_of

#: Words a passage (statistics, SVD), and words of the search windows (of a
#: shorter item, its length).
PASSAGE, WINDOW = 40, 10
#: Random directions of the sketch and latent directions kept.
SKETCH, RANK = 48, 40
#: Least cosine.
COSINE = 0.8
#: Rare words of an item that are looked for together.  Any number gives the same pairs.
TOGETHER = 4
#: Least cover of an item, of its answer, and the cover that needs no answer.
COVER, ANSWER, WHOLE = 0.6, 0.5, 0.9
ITEMS_AT_ONCE = 20_000
SEED = 7
WORDS_AT_ONCE = 150_000
KEY_DDL = "k_id bigint, k_h1 bigint, k_h2 int, k_len int"


@dataclass
class Item:
    item_id: int
    codes: np.ndarray

    @property
    def answer(self) -> np.ndarray:
        """The closing words: a fifth of the item, three at least."""
        return self.codes[-max(3, len(self.codes) // 5):]


def vocabulary(texts: list[str]) -> dict[bytes, int]:
    """Codes 1, 2, ... of the words; 0 stands for any other word."""
    return {w: i + 1 for i, w in enumerate(sorted({w for t in texts for w in words_of(t.lower())}))}


def _code(vocab: dict[bytes, int]):
    def run(batches):
        get = vocab.get
        for b in slices(batches):
            out = []
            for t in b.column("text").to_pylist():
                words = words_of(t.lower())
                out.append(np.fromiter(map(get, words, repeat(0)), "<i4", len(words)).tobytes())
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in KEY), pa.array(out, pa.binary())],
                                             names=[*KEY, "codes"])
    return run


def coded(docs: DataFrame, vocab: dict[bytes, int], id_col: str, text_col: str) -> DataFrame:
    """Row keys with the words of the whole text as 32-bit codes."""
    rows = docs.select(*row_key(id_col, text_col), text_or_empty(text_col).alias("text")).withColumn(
        "k_id", F.col("k_id").cast("bigint"))
    return rows.mapInArrow(_code(vocab), f"{KEY_DDL}, codes binary")


def _chunks(batches):
    """(batch, first row, codes of some rows end to end, words a row)."""
    release()
    for b in batches:
        col, at = b.column("codes"), 0
        parts, held = [], 0
        for i in range(b.num_rows):
            parts.append(np.frombuffer(col[i].as_buffer(), "<i4"))
            held += len(parts[-1])
            if held >= WORDS_AT_ONCE or i == b.num_rows - 1:
                yield b, at, np.concatenate(parts), np.array([len(p) for p in parts])
                parts, held, at = [], 0, i + 1


def _terms(codes: np.ndarray, sizes: np.ndarray, passage: int):
    """(passage, code, count) of the benchmark words, by passage; passages
    don't span texts.  Also the number of passages."""
    per = -(-sizes // passage)
    first_word, first_passage = np.cumsum(sizes) - sizes, np.cumsum(per) - per
    own = np.repeat(np.arange(len(sizes)), sizes)
    pid = first_passage[own] + (np.arange(len(codes)) - first_word[own]) // passage
    hit = codes > 0
    key, count = np.unique(pid[hit] << 32 | codes[hit], return_counts=True)
    return key >> 32, (key & 0xFFFFFFFF).astype(np.int64), count, int(per.sum())


def _frequencies(size: int, passage: int):
    """(code, n): passages with each word; code 0: all passages."""
    def run(batches):
        total = np.zeros(size + 1, np.int64)
        for _, _, codes, sizes in _chunks(batches):
            _, code, _, n = _terms(codes, sizes, passage)
            total += np.bincount(code, minlength=size + 1)
            total[0] += n
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], names=["code", "n"])
    return run


def _weights(code: np.ndarray, pid: np.ndarray, count: np.ndarray, idf: np.ndarray):
    """TF-IDF weights, each passage of length one, and where passages start."""
    w = (1 + np.log(count)) * idf[code]
    first = np.flatnonzero(np.r_[True, pid[1:] != pid[:-1]])
    norm = np.sqrt(np.add.reduceat(w * w, first))
    return (w / np.repeat(np.maximum(norm, 1e-12), np.diff(np.r_[first, len(w)]))).astype(np.float32), first


def _sketch(idf: np.ndarray, random: np.ndarray, passage: int):
    """(code, y): this partition's part of (A'A) times the random directions."""
    random = random.astype(np.float32)

    def run(batches):
        total = np.zeros(random.shape)
        for _, _, codes, sizes in _chunks(batches):
            pid, code, count, _ = _terms(codes, sizes, passage)
            if not len(code):
                continue
            w, first = _weights(code, pid, count, idf)
            z = np.add.reduceat(random[code] * w[:, None], first)
            row = np.repeat(np.arange(len(first)), np.diff(np.r_[first, len(w)]))
            # Add up by word: the terms in the order of their codes.
            order = np.argsort(code, kind="stable")
            start = np.flatnonzero(np.r_[True, np.diff(code[order]) > 0])
            total[code[order[start]]] += np.add.reduceat(z[row[order]] * w[order, None], start)
        at = np.flatnonzero(total.any(axis=1))
        y = pa.ListArray.from_arrays(pa.array(np.arange(len(at) + 1, dtype=np.int32) * random.shape[1]),
                                     pa.array(total[at].ravel()))
        yield pa.RecordBatch.from_arrays([pa.array(at), y], names=["code", "y"])
    return run


def latent_directions(rows: DataFrame, size: int, passage: int = PASSAGE, sketch: int = SKETCH,
                      rank: int = RANK) -> tuple[np.ndarray, np.ndarray]:
    """Inverse passage frequencies and the leading right singular vectors of
    the TF-IDF matrix of all passages of ``rows``, by a one-pass randomised
    (Nystrom) decomposition of its Gram matrix."""
    counts = rows.select("codes").mapInArrow(_frequencies(size, passage), "code bigint, n bigint")
    df = np.zeros(size + 1)
    for r in counts.groupBy("code").agg(F.sum("n").alias("n")).collect():  # a row per benchmark word at most
        df[r["code"]] = r["n"]
    idf = np.log((df[0] + 1) / (df + 1)) + 1
    idf[0] = idf[1:].mean() if size else 1.0  # any other word
    width = min(sketch, max(1, size))
    random = np.random.default_rng(SEED).standard_normal((size + 1, width))
    random[0] = 0
    parts = rows.select("codes").mapInArrow(_sketch(idf, random, passage), "code bigint, y array<double>")
    y = np.zeros_like(random)
    sums = parts.groupBy("code").agg(F.array(*[F.sum(F.col("y")[d]) for d in range(width)]).alias("y"))
    for r in sums.collect():
        y[r["code"]] = r["y"]
    shift = 1e-8 * max(np.linalg.norm(y), 1e-8)
    shifted = y + shift * random
    core = random.T @ shifted
    factor = np.linalg.cholesky((core + core.T) / 2 + shift * np.eye(width))
    u, _, _ = np.linalg.svd(np.linalg.solve(factor, shifted.T).T, full_matrices=False)
    return idf, u[:, :rank]


def common(item: np.ndarray, words: np.ndarray) -> int:
    """Length of the longest common subsequence; bit-parallel over the item."""
    masks: dict[int, int] = {}
    for i, c in enumerate(item.tolist()):
        masks[c] = masks.get(c, 0) | 1 << i
    row = 0
    for c in words.tolist():
        m = masks.get(c)
        if m:
            x = row | m
            row = x & ~(x - (row << 1 | 1))
    return row.bit_count()


class Retriever:
    """Where an item may begin in a text, and the checks of such a start.

    ``regions`` leaves out only starts that no check could accept.  An item of
    n words is covered by ``least`` of them at least, so of any n - least + t
    of its words t or more lie in the span that is aligned; the rarest ones
    are looked up."""

    def __init__(self, items: list[Item], idf: np.ndarray, directions: np.ndarray):
        self.items = items
        self.terms = (directions * idf[:, None]).astype(np.float32)
        self.terms[0] = 0
        self.length = np.array([len(it.codes) for it in items])
        self.window = np.minimum(WINDOW, self.length)
        self.slack = self.length // 4 + 2
        self.least = np.array([next(i for i in range(1, n + 1) if i / n >= COVER) for n in self.length.tolist()])
        self.together = np.minimum(TOGETHER, self.least)
        code, owner = [], []
        for k, it in enumerate(items):
            rare = np.argsort(-idf[it.codes], kind="stable")[: self.length[k] - self.least[k] + self.together[k]]
            code.append(np.unique(it.codes[rare]))
            owner.append(np.full(len(code[-1]), k))
        code, owner = np.concatenate(code), np.concatenate(owner)
        order = np.argsort(code, kind="stable")
        #: Items with a code among their rarest words, end to end by code.
        self.posted = owner[order]
        self.upto = np.concatenate([[0], np.cumsum(np.bincount(code, minlength=len(idf)))])
        self.queries: dict[int, np.ndarray] = {}

    @staticmethod
    def _unit(x: np.ndarray) -> np.ndarray:
        return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-12)

    def regions(self, codes: np.ndarray, sizes: np.ndarray):
        """(text, item, low, high): starts, in words of the text, around which
        enough of the item's rarest words lie; no other start can pass."""
        per = np.where(codes > 0, self.upto[codes + 1] - self.upto[codes], 0)
        at = np.repeat(np.arange(len(codes)), per)
        item = self.posted[np.repeat(self.upto[codes] - np.cumsum(per) + per, per) + np.arange(len(at))]
        first = np.cumsum(sizes) - sizes
        text = np.repeat(np.arange(len(sizes)), sizes)[at]
        at = at - first[text]
        order = np.lexsort((at, item, text))
        text, item, at = text[order], item[order], at[order]
        # ``together`` hits in a row within a span.
        i = np.arange(len(at))
        last = i + self.together[item] - 1
        i, last = i[last < len(at)], last[last < len(at)]
        k = item[i]
        low, high = at[last] - self.length[k] - self.slack[k] + 1, at[i] + self.slack[k]
        ok = (text[last] == text[i]) & (item[last] == k) & (low <= high)
        text, item, low, high = text[i][ok], k[ok], low[ok], high[ok]
        if not len(text):
            return
        # Overlapping ones are one.
        new = np.flatnonzero(np.r_[True, (text[1:] != text[:-1]) | (item[1:] != item[:-1]) | (low[1:] > high[:-1])])
        end = np.r_[new[1:], len(text)] - 1
        yield from zip(text[new].tolist(), item[new].tolist(), low[new].tolist(), high[end].tolist())

    def verify(self, item: Item, codes: np.ndarray, start: int) -> tuple[float, float]:
        """Cover of the item and of its answer around ``start``."""
        slack = len(item.codes) // 4 + 2
        near = codes[max(0, start - slack): max(0, start + len(item.codes) + slack)]
        cover = common(item.codes, near) / len(item.codes)
        return cover, common(item.answer, near) / len(item.answer) if cover >= COVER else 0.0

    def _windows(self, codes: np.ndarray, size: int) -> np.ndarray:
        """Unit vectors of all windows of ``size`` words; fewer words are one."""
        at = np.lib.stride_tricks.sliding_window_view(codes, min(size, len(codes)))
        return self._unit(self.terms[at].sum(axis=1))

    def cosines(self, k: int, codes: np.ndarray, starts: list[int]) -> list[float]:
        """For each start of item ``k`` the best cosine of a window of the text
        with the window of the item that is aligned with it."""
        size = int(self.window[k])
        if k not in self.queries:
            self.queries[k] = self._windows(self.items[k].codes, size)
        query = self.queries[k]
        # Rows of the table: windows from the first that may be aligned on.
        base = min(max(0, starts[0]), max(0, len(codes) - size))
        near = codes[base: max(0, starts[-1]) + len(query) + size - 1]
        table = self._windows(near, size) @ query.T
        return [float(max(table.diagonal(base - s), default=-1.0)) for s in starts]

    def matches(self, codes: np.ndarray, k: int, low: int, high: int):
        """(start, cover, answer, cosine) of the starts low..high that pass
        the cosine, the cover and the answer."""
        item, slack = self.items[k], int(self.slack[k])
        n, least, size = len(item.codes), int(self.least[k]), int(self.window[k])
        # A window of the text is aligned with one of the item.
        low = max(low, size - n)
        high = min(high, max(0, len(codes) - size))
        begin = max(0, low - slack)
        near = codes[begin: max(0, high + n + slack)]
        if low > high or common(item.codes, near) < least:
            return
        member = np.concatenate([[0], np.cumsum(np.isin(near, item.codes))])
        s = np.arange(low, high + 1)
        held = member[np.clip(s + n + slack - begin, 0, len(near))] - member[np.maximum(s - slack - begin, 0)]
        passed = {}
        for start in s[held >= least].tolist():
            cover, answer = self.verify(item, codes, start)
            if cover >= WHOLE or (cover >= COVER and answer >= ANSWER):
                passed[start] = cover, answer
        if passed:
            for (start, (cover, answer)), cosine in zip(passed.items(), self.cosines(k, codes, list(passed))):
                if cosine >= COSINE:
                    yield start, cover, answer, cosine


def _search(items: list[Item], idf: np.ndarray, directions: np.ndarray):
    def run(batches):
        finder = Retriever(items, idf, directions)
        for b, row0, codes, sizes in _chunks(batches):
            first = np.cumsum(sizes) - sizes
            found = {}
            for text, item, low, high in finder.regions(codes, sizes):
                own = codes[first[text]: first[text] + sizes[text]]
                for start, cover, answer, cosine in finder.matches(own, item, low, high):
                    best = found.get((text, item))
                    if best is None or (cover, cosine) > best[:2]:
                        found[text, item] = (cover, cosine, answer, start)
            if found:
                rows = [row0 + t for t, _ in found]
                keys = b.select(KEY).take(pa.array(rows))
                cover, cosine, answer, start = zip(*found.values())
                yield pa.RecordBatch.from_arrays(
                    [*keys.columns, pa.array([items[i].item_id for _, i in found], pa.int64()), pa.array(cosine),
                     pa.array(cover), pa.array(answer), pa.array([max(0, s) for s in start], pa.int64())],
                    names=[*KEY, "item_id", "cosine", "cover", "answer", "start"])
    return run


def leaks(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          item_col: str = "item_id", item_text_col: str = "text", items_at_once: int = ITEMS_AT_ONCE) -> DataFrame:
    """One row per leaking text and item: the row key, item_id, cosine, cover
    (of the item's words, in order), answer (cover of its closing words) and
    start (word at which the item begins).

    Null and empty texts and items without words leak nothing; items without
    an id are ignored; repeated items count under their smallest id.  Texts
    shorter than a window are one window.  Repeated rows share a key and give
    a row each.  Empty tables give an empty one; extra columns are ignored."""
    spark = docs.sparkSession
    empty = spark.createDataFrame([], f"{KEY_DDL}, item_id bigint, cosine double, cover double, answer double, start bigint")
    texts = (items.where(F.col(item_col).isNotNull() & F.col(item_text_col).isNotNull())
             .groupBy(F.col(item_text_col).alias("text")).agg(F.min(item_col).cast("bigint").alias("item_id")))
    texts = stage(texts, "items")
    parts = -(-texts.count() // items_at_once)
    out = empty
    for p in range(parts):
        # At most about items_at_once rows: the benchmark is the query set.
        some = texts.where(F.pmod(F.xxhash64("text"), F.lit(parts)) == p).orderBy("item_id").collect()
        vocab = vocabulary([r["text"] for r in some])
        some = [Item(r["item_id"], np.array([vocab[w] for w in words_of(r["text"].lower())], np.int64)) for r in some]
        some = [it for it in some if len(it.codes)]
        if some:
            rows = stage(coded(docs, vocab, id_col, text_col), "coded")
            idf, directions = latent_directions(rows, len(vocab))
            out = out.unionAll(rows.mapInArrow(
                _search(some, idf, directions), empty.schema))
    return out


def without_leaks(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that leak no item, all columns unchanged."""
    found = stage(leaks(docs, items, id_col, text_col).select(*KEY).distinct(), "leaking")
    keyed = docs.select(F.struct("*").alias("row"), *row_key(id_col, text_col))
    return keyed.join(found, same_key(keyed, found), "left_anti").select("row.*")


@query("op7_benchmark_decontamination")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
            .select(F.col("k_id").alias("doc_id"), "item_id", "cosine", "cover", "answer", "start"))
