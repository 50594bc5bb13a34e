"""Language identification by interpolated Kneser-Ney character models.

Each language has a character model of order ``ORDER`` over words with end
marks.  Counts come from all training texts: a task counts words by language
and sends the counts of their character n-grams; the totals, continuation
counts, discounts and back-off weights are aggregates and joins in Spark.  The
model keeps, per order, one sorted array of n-gram hashes with the discounted
probability of the n-gram and the back-off weight of the context in every
language, so one binary search serves all languages.

A text's language has the lowest cross-entropy per character.  The rejection
threshold of a language is calibrated on all its training texts: mean plus
``REJECT_SD`` deviations of their cross-entropy; a text above it is marked and
its score lowered.

n-gram ids have 63 bits and nothing bounds their number.  The model is a Spark
table; up to ``HELD_CELLS`` n-grams times languages it is broadcast, beyond
that the distinct n-grams of every slice of texts are joined to it and each
slice is scored with the rows it needs.  Both ways give the same results."""

from __future__ import annotations

import contextlib

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkwright.llm.shared import query, slices, stage, table
from sparkwright.llm.words import words_of

ORDER = 4
HASH_BITS = 63
#: N-grams times languages that are broadcast at most, and the rows of a slice.
HELD_CELLS = 4_000_000
SLICE_BITS = 9
#: Distinct words that a task counts or scores before it starts anew.
WORDS_HELD = 250_000
REJECT_SD = 4.0
#: Characters after which more text makes a score no surer.
SURE_AT = 400
GRAM = "lang string, k int, gram bigint, prefix bigint, suffix bigint, opening boolean, n bigint"


def has_letter(text: str | None) -> bool:
    return bool(text) and any(map(str.isalpha, text))


def positions(words: list[bytes], order: int = ORDER):
    """The n-gram ids at every character of the words laid end to end between
    marks: (ids by order, -1 where the word is shorter; number of the word;
    whether the n-gram of each order begins at the word's mark).  The first
    mark is only there as context."""
    flat = "\n" + "\n".join(w.decode("utf-8", "surrogatepass") for w in words) + "\n"
    c = np.frombuffer(flat.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)
    at, mark = np.arange(len(c)), c == 10
    before = np.maximum.accumulate(np.where(mark, at, 0))
    start = np.concatenate([[0], before[:-1]])
    word = np.concatenate([[0], np.cumsum(mark)[:-1] - 1])
    ids, opening = [], []
    total, power = np.zeros(len(c), np.uint64), 1
    for k in range(1, order + 1):
        shifted = np.concatenate([np.zeros(min(k - 1, len(c)), np.uint64), c[: max(0, len(c) - k + 1)] + np.uint64(1)])
        total = total + shifted * np.uint64(power)
        power = power * 0x9E3779B97F4A7C15 % (1 << 64)
        h = (total ^ np.uint64(k * 0x632BE59BD9B4E019 % (1 << 64))) * np.uint64(0xFF51AFD7ED558CCD)
        h ^= h >> np.uint64(32)
        h *= np.uint64(0xC4CEB9FE1A85EC53)
        gram = (h >> np.uint64(64 - HASH_BITS)).astype(np.int64)
        gram[at - k + 1 < start] = -1
        ids.append(gram)
        opening.append((at - k + 1 == start) if k > 1 else np.zeros(len(c), bool))
    return ids, word, opening


def _gram_counts(lang: str, counts: dict[bytes, int], order: int):
    ids, word, opening = positions(list(counts), order)
    weight = np.fromiter(counts.values(), np.int64, len(counts))[word]
    for k in range(1, order + 1):
        gram = ids[k - 1]
        at = 1 + np.flatnonzero(gram[1:] >= 0)  # the first mark is a context only
        keys, first, inverse = np.unique(gram[at], return_index=True, return_inverse=True)
        n = np.bincount(inverse, weights=weight[at], minlength=len(keys)).astype(np.int64)
        one = at[first]
        shorter = ids[k - 2] if k > 1 else None
        yield pa.RecordBatch.from_arrays(
            [pa.array([lang] * len(keys)), pa.array(np.full(len(keys), k, np.int32)), pa.array(keys),
             pa.array(shorter[one - 1] if k > 1 else np.zeros(len(keys), np.int64)),
             pa.array(shorter[one] if k > 1 else np.zeros(len(keys), np.int64)),
             pa.array(opening[k - 1][one]), pa.array(n)],
            names=["lang", "k", "gram", "prefix", "suffix", "opening", "n"])


def _count(order: int):
    def run(batches):
        held: dict[str, dict[bytes, int]] = {}
        size = 0
        for b in slices(batches):
            for lang, text in zip(b.column("lang").to_pylist(), b.column("text").to_pylist()):
                count = held.setdefault(lang, {})
                size -= len(count)
                for w in words_of(text.lower()):
                    count[w] = count.get(w, 0) + 1
                size += len(count)
                if size > WORDS_HELD:
                    for name, words in held.items():
                        yield from _gram_counts(name, words, order)
                    held, size = {}, 0
        for name, words in held.items():
            yield from _gram_counts(name, words, order)
    return run


class Model:
    """Sorted n-gram ids by order, with a column per language."""

    def __init__(self, langs: list[str], order: int):
        self.langs, self.order = langs, order
        self.ids: list[np.ndarray] = []      # by order
        self.alpha: list[np.ndarray] = []    # discounted probability of the n-gram
        self.gamma: list[np.ndarray] = []    # back-off weight of the n-gram as a context; 1 if unseen
        self.first_gamma = np.ones(len(langs))
        self.limit = np.full(len(langs), np.inf)
        self.size = 1                        # known characters and an unknown one
        self.table: DataFrame | None = None  # the n-grams of a model that isn't held
        self._index: dict[bytes, int] = {}
        self._rows = np.zeros((0, len(langs) + 1))

    def __getstate__(self):
        return self.__dict__ | {"_index": {}, "_rows": np.zeros((0, len(self.langs) + 1)), "table": None}

    def hold(self, rows: pa.Table) -> None:
        """Take these n-grams (lang, k, gram, alpha, gamma) of order 1 up."""
        number = {x: i for i, x in enumerate(self.langs)}
        lang = np.array([number[x] for x in rows.column("lang").to_pylist()], np.int64)
        k, gram, alpha, gamma = (rows.column(c).to_numpy() for c in ("k", "gram", "alpha", "gamma"))
        self.ids, self.alpha, self.gamma = [], [], []
        for o in range(1, self.order + 1):
            at = k == o
            ids, row = np.unique(gram[at], return_inverse=True)
            a, g = (np.full((len(ids), len(self.langs)), x, np.float32) for x in (0, 1))
            a[row, lang[at]] = np.nan_to_num(alpha[at].astype(float))
            own = gamma[at].astype(float)
            g[row, lang[at]] = np.where(np.isnan(own), 1.0, own)
            self.ids.append(ids)
            self.alpha.append(a)
            self.gamma.append(g)

    def part(self, rows: pa.Table) -> Model:
        """This model with some of its n-grams."""
        some = Model(self.langs, self.order)
        some.first_gamma, some.limit, some.size = self.first_gamma, self.limit, self.size
        some.hold(rows)
        return some

    def score_words(self, words: list[bytes]) -> np.ndarray:
        """A row per word: the log probability in each language, and the
        number of predicted characters (with the end mark)."""
        ids, word, _ = positions(words, self.order)
        m, width = len(word), len(self.langs)
        p = np.full((m, width), 1.0 / self.size)
        context = None
        for k in range(self.order):
            known = self.ids[k]
            at = np.searchsorted(known, ids[k])
            at[at == len(known)] = 0
            hit = (known[at] == ids[k]) if len(known) else np.zeros(m, bool)
            use = ids[k] >= 0
            alpha = np.zeros((m, width))
            alpha[hit] = self.alpha[k][at[hit]]
            if context is None:
                gamma = np.broadcast_to(self.first_gamma, (m, width))
            else:
                # The context ends one character earlier.
                gamma = np.concatenate([np.ones((1, width)), context[:-1]])
            p = np.where(use[:, None], alpha + gamma * p, p)
            context = np.ones((m, width))
            context[hit] = self.gamma[k][at[hit]]
        logs = np.log(np.maximum(p, 1e-12))
        logs[0] = 0
        out = np.zeros((len(words), width + 1))
        for j in range(width):
            out[:, j] = np.bincount(word[1:], weights=logs[1:, j], minlength=len(words))
        out[:, width] = np.bincount(word[1:], minlength=len(words))
        return out

    def entropies(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Cross-entropy per character in each language, and the characters."""
        sums = np.zeros((len(texts), len(self.langs) + 1))
        for lo, hi in _slices(texts):
            words = [words_of(t.lower()) for t in texts[lo:hi]]
            new = {w for ws in words for w in ws} - self._index.keys()
            if len(self._index) + len(new) > WORDS_HELD and self._index:
                self._index, self._rows = {}, self._rows[:0]
                new = {w for ws in words for w in ws}
            new = list(new)
            for at in range(0, len(new), 20_000):
                part = new[at: at + 20_000]
                rows = self.score_words(part)
                self._index.update(zip(part, range(len(self._index), len(self._index) + len(part))))
                self._rows = np.concatenate([self._rows, rows])
            get = self._index.__getitem__
            for i, ws in enumerate(words):
                if ws:
                    sums[lo + i] = self._rows[np.fromiter(map(get, ws), np.int64, len(ws))].sum(axis=0)
        n = np.maximum(sums[:, -1], 1)
        return -sums[:, :-1] / n[:, None], sums[:, -1]

    def predict(self, texts: list[str | None]):
        """Language, score in 0..1, cross-entropy and whether it is rejected."""
        lang = np.full(len(texts), "und", object)
        score, entropy, rejected = np.zeros(len(texts)), np.full(len(texts), np.nan), np.zeros(len(texts), bool)
        some = [i for i, t in enumerate(texts) if has_letter(t)] if self.langs else []
        if some:
            h, n = self.entropies([texts[i] for i in some])
            best = h.argmin(axis=1)
            low = h[np.arange(len(some)), best]
            sure = 1 / np.exp(-(h - low[:, None]) * np.minimum(n, SURE_AT)[:, None]).sum(axis=1)
            over = np.maximum(0.0, low - self.limit[best])
            lang[some] = np.array(self.langs, object)[best]
            score[some], entropy[some], rejected[some] = sure * np.exp(-over), low, over > 0
        return lang, score, entropy, rejected


def _slices(texts: list[str]):
    """Runs of texts of about a million characters; a longer text is alone."""
    lo, size = 0, 0
    for i, t in enumerate(texts):
        size += len(t)
        if size >= 1_000_000 or i == len(texts) - 1:
            yield lo, i + 1
            lo, size = i + 1, 0


@contextlib.contextmanager
def _kept():
    """``keep(df)`` holds ``df`` on the executors' disks until the end.  Counts
    have few bytes but a partition per shuffle partition, and a file system
    without Hadoop's native library starts a process for every file it makes."""
    held: list[DataFrame] = []

    def keep(df: DataFrame) -> DataFrame:
        held.append(df.persist(StorageLevel.DISK_ONLY))
        return held[-1]
    try:
        yield keep
    finally:
        for df in held:
            df.unpersist()


def smoothed(grams: DataFrame, order: int = ORDER, keep=lambda df: df) -> DataFrame:
    """(lang, k, gram, alpha, gamma) from n-gram counts: Kneser-Ney with one
    discount per language and order.  gamma, the weight of the shorter context,
    stands on the n-gram that is the context; order 0 holds the empty one.
    ``keep`` holds a table that is read several times."""
    totals = keep(grams.groupBy("lang", "k", "gram").agg(
        F.sum("n").alias("n"), F.min("prefix").alias("prefix"), F.min("suffix").alias("suffix"),
        F.max("opening").alias("opening")))
    # Below the highest order a count is the number of characters seen before
    # the n-gram; at a word's mark there is none, and the count itself serves.
    before = (totals.where("k > 1").groupBy("lang", (F.col("k") - 1).alias("k"), F.col("suffix").alias("gram"))
              .agg(F.count("*").alias("before")))
    used = totals.join(before, ["lang", "k", "gram"], "left").withColumn(
        "a", F.when((F.col("k") == order) | F.col("opening"), F.col("n")).otherwise(F.coalesce("before", "n")))
    used = keep(used.select("lang", "k", "gram", "prefix", "a"))
    once, twice = (F.sum(F.when(F.col("a") == i, 1).otherwise(0)) for i in (1, 2))
    # A row per language and order.
    discount = used.groupBy("lang", "k").agg(F.least(F.lit(0.95), F.greatest(
        F.lit(0.05), once / (once + 2 * twice + 1e-9))).alias("d"))
    contexts = (used.groupBy("lang", "k", "prefix").agg(F.sum("a").alias("total"), F.count("*").alias("kinds"))
                .join(F.broadcast(discount), ["lang", "k"]))
    contexts = keep(contexts.select("lang", "k", "prefix", "total", "d",
                                    (F.col("d") * F.col("kinds") / F.col("total")).alias("weight")))
    alpha = used.join(contexts, ["lang", "k", "prefix"]).select(
        "lang", "k", "gram", (F.greatest(F.col("a") - F.col("d"), F.lit(0.0)) / F.col("total")).alias("alpha"))
    gamma = contexts.select("lang", (F.col("k") - 1).alias("k"), F.col("prefix").alias("gram"),
                            F.col("weight").alias("gamma"))
    return alpha.join(gamma, ["lang", "k", "gram"], "full_outer")


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
        order: int = ORDER, held_cells: int = HELD_CELLS) -> Model:
    """Learn from all rows of ``docs`` with a text and a language; others are
    ignored (ids are not used).  Without any the model knows no language and
    predicts ``und``."""
    rows = docs.where(F.col(text_col).isNotNull() & F.col(lang_col).isNotNull()).select(
        F.col(lang_col).alias("lang"), F.col(text_col).alias("text"))
    grams = rows.select("lang", "text").mapInArrow(_count(order), GRAM)
    with _kept() as keep:
        found = keep(smoothed(grams, order, keep))
        empty = {r["lang"]: r["gamma"] for r in found.where("k = 0").collect()}  # a row per language
        model = Model(sorted(empty), order)
        if not empty:
            return model
        model.first_gamma = np.array([empty[x] for x in model.langs])
        found = found.where("k > 0")
        model.size = found.where("k = 1").select("gram").distinct().count() + 1
        # No language has more n-grams than there are rows.
        if found.count() * len(model.langs) <= held_cells:
            model.hold(found.toArrow())
        else:
            model.table = stage(found, "model")
    _calibrate(model, rows)
    return model


def _slice_grams(order: int):
    """(slice, k, gram): the distinct n-grams of the texts of a slice."""
    def run(batches):
        for b in slices(batches):
            number, texts = b.column("slice").to_numpy(), b.column("text").to_pylist()
            for one in np.unique(number):
                here = [texts[i] for i in np.flatnonzero(number == one)]
                words = list({w for t in here for w in words_of((t or "").lower())})
                for at in range(0, len(words), 20_000):
                    for k, ids in enumerate(positions(words[at: at + 20_000], order)[0], 1):
                        gram = np.unique(ids[ids >= 0])
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(np.full(len(gram), one)), pa.array(np.full(len(gram), k, np.int32)), pa.array(gram)],
                            names=["slice", "k", "gram"])
    return run


def _apply(rows: DataFrame, model: Model, score, schema: str) -> DataFrame:
    """``score(model, batch)`` of all rows (with a column ``text``)."""
    held = rows.sparkSession.sparkContext.broadcast(model)
    if model.table is None:
        def run(batches):
            for b in slices(batches):
                yield score(held.value, b)
        return rows.mapInArrow(run, schema)

    def join(some: pa.Table, grams: pa.Table) -> pa.Table:
        m, whole = held.value.part(grams), some.combine_chunks()
        return pa.Table.from_batches([score(m, b) for b in whole.to_batches()])
    numbered = stage(rows.withColumn("slice", F.shiftright(F.monotonically_increasing_id(), SLICE_BITS)), "slices")
    wanted = numbered.select("slice", "text").mapInArrow(_slice_grams(model.order), "slice bigint, k int, gram bigint")
    needed = wanted.distinct().join(model.table, ["k", "gram"]).select("slice", "lang", "k", "gram", "alpha", "gamma")
    return numbered.groupBy("slice").cogroup(needed.groupBy("slice")).applyInArrow(join, schema)


def _calibrate(model: Model, rows: DataFrame) -> None:
    """Set each language's limit from all its training texts."""
    def run(m, b):
        lang = np.array(b.column("lang").to_pylist(), object)
        h, n = m.entropies(b.column("text").to_pylist())
        ok = np.flatnonzero(n > 0)
        own = np.array([m.langs.index(x) for x in lang[ok]], np.int64)
        return pa.RecordBatch.from_arrays([pa.array(lang[ok], pa.string()), pa.array(h[ok, own])], names=["lang", "h"])
    stats = _apply(rows.select("lang", "text"), model, run, "lang string, h double").groupBy("lang").agg(
        F.avg("h").alias("mean"), F.stddev_pop("h").alias("sd")).collect()
    for r in stats:
        model.limit[model.langs.index(r["lang"])] = r["mean"] + REJECT_SD * max(r["sd"], 0.05)


def identify(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, lang_pred, score, cross_entropy, rejected): one row per row of
    ``docs``.  Null texts and texts without a letter are ``und`` with score 0
    and a null cross-entropy; repeated rows stay; an empty table gives an
    empty one; extra columns are ignored."""
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))

    def run(m, b):
        lang, score, entropy, rejected = m.predict(b.column("text").to_pylist())
        return pa.RecordBatch.from_arrays(
            [b.column("doc_id"), pa.array(lang, pa.string()), pa.array(score),
             pa.array(entropy, from_pandas=True), pa.array(rejected)],
            names=["doc_id", "lang_pred", "score", "cross_entropy", "rejected"])
    return _apply(rows, model, run, "doc_id bigint, lang_pred string, score double, cross_entropy double, rejected boolean")


def held_out(id_col: str = "doc_id"):
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % 3 == 1


@query("op10_language_id")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = fit(docs.where(~held_out()))
    return identify(docs, model).withColumn("held_out", F.coalesce(held_out(), F.lit(False)))
