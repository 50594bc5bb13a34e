"""Phrase collocations by set-oriented relational mining (SETM).

An occurrence relation lists where the frequent phrases of one length stand:
rows (slot, phrase), sorted by slot.  Slots number the words of a sheet of
texts in order and skip one between pieces, so words of one piece that follow
each other have adjacent slots and all others don't.

Length after length the relation is merge-joined with itself on piece and
adjacent position: a phrase of k words and the one that starts a word later
make a phrase of k+1 words.  The joined pairs are counted per sheet and dealt
to buckets by their hash.  A bucket gets the pairs of all sheets: it sums the
counts, numbers the frequent groups and tells every sheet which of its pairs
these are (the semi-join); what is left of the relation is persisted as the
next one.

A sheet is one row of a persisted table (its columns packed into compressed
blobs) and holds texts of one language: at most ``SHEET`` words and the text
that exceeds them.  Only distinct pairs of a sheet are shuffled, sorted and
packed; a bucket holds a share of all distinct pairs, whatever their counts."""

from __future__ import annotations

import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sparkwright.llm.shared import query, slices, stage, table, text_or_empty

LONGEST = 5
LEAST_COUNT = 100
TOP = 2000
#: A phrase goes when a longer one has this share (in percent) of its count.
COVERED = 100
SHEET = 1 << 22
#: Buckets per shuffle partition.
BUCKETS = 2

#: A-Z lower-cased; piece borders as line feeds; tabs as blanks.
BORDERS = b".,;:!?\x0a\x0b\x0c\x0d"
BYTES = bytes(b + 32 if 65 <= b <= 90 else 10 if b in BORDERS else 32 if b == 9 else b for b in range(256))

#: Texts (blob) and word lists by bucket (words, numbers, counts).
SHEETS = "sheet bigint, lang string, blob binary, bucket bigint, words binary, numbers binary, counts binary"
RELATION = "sheet bigint, slots binary, groups binary, names binary"
#: Distinct pairs of a sheet by bucket.
PAIRS = "bucket bigint, sheet bigint, a binary, b binary, n binary"
#: What a bucket finds: frequent groups (gid, f; a and b, or lang and word),
#: words in all (lang, f), and the numbers of a sheet's frequent groups.
FOUND = ("gid bigint, f bigint, lang string, word string, a bigint, b bigint, sheet bigint, first binary, second binary, "
         "gids binary")


def _pack(a: np.ndarray) -> bytes:
    """Numbers as compressed bytes, all lowest bytes first."""
    planes = np.ascontiguousarray(a).view(np.uint8).reshape(-1, a.dtype.itemsize).T
    return pa.compress(planes.tobytes(), codec="zstd", asbytes=True) + len(a).to_bytes(8, "little")


def _unpack(blob: bytes, kind: str) -> np.ndarray:
    n, size = int.from_bytes(blob[-8:], "little"), np.dtype(kind).itemsize
    raw = pa.decompress(blob[:-8], decompressed_size=n * size, codec="zstd", asbytes=True)
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(size, n).T).view(kind).reshape(n)


def _rising(a: np.ndarray) -> bytes:
    """Sorted numbers, packed by their differences."""
    return _pack(np.diff(a, prepend=0).astype("<i8"))


def _risen(blob: bytes) -> np.ndarray:
    return np.cumsum(_unpack(blob, "<i8"))


def _runs(order: np.ndarray, value: np.ndarray) -> list[np.ndarray]:
    """Places in ``order``, which goes by value, cut where the value changes."""
    return np.split(order, np.flatnonzero(np.diff(value[order])) + 1) if len(order) else []


def _frame(schema: str, rows: list[dict]) -> pa.Table:
    """Rows as an Arrow table of a schema of bigint, string, int and binary."""
    kinds = {"bigint": pa.int64(), "string": pa.string(), "binary": pa.binary(), "int": pa.int32()}
    cols = [c.strip().split(" ") for c in schema.split(",")]
    return pa.table({c: pa.array([r.get(c) for r in rows], kinds[k]) for c, k in cols})


class _Builder:
    """Texts of one language as numbers of a sheet's own word list."""

    def __init__(self):
        self.words = defaultdict(lambda: len(self.words) - 1)
        self.words[b""] = -1
        self.words[b"\n"]  # 0: a border
        self.texts, self.size = [], 0

    def add(self, text: str) -> None:
        raw = text.encode("utf-8", "surrogatepass").translate(BYTES).replace(b"\n", b" \n ").split(b" ")
        ids = np.fromiter(map(self.words.__getitem__, raw), np.int32, len(raw))
        ids = ids[ids >= 0]
        if len(ids):
            self.texts += [ids, np.zeros(1, np.int32)]
            self.size += len(ids)


def _sheets(limit: int, buckets: int):
    """A row with the texts of each sheet, and its word list by buckets."""
    def run(batches):
        worker, number, open_ = TaskContext.get().partitionId(), 0, {}
        for b in slices(batches):
            for lang, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                held = open_.setdefault(lang, _Builder())
                held.add(text)
                if held.size >= limit or len(open_) > 1 and sum(x.size for x in open_.values()) >= 2 * limit:
                    yield from done(open_, worker, number)
                    number, open_ = number + len(open_), {}
        yield from done(open_, worker, number)

    def done(open_, worker, number):
        for k, (lang, held) in enumerate(open_.items()):
            if not held.size:
                continue
            ids = np.concatenate(held.texts)
            held.texts.clear()
            sheet = (worker << 32) | (number + k)
            yield from _frame(SHEETS, [{"sheet": sheet, "lang": lang, "blob": _pack(ids)}]).to_batches()
            n = np.bincount(ids, minlength=len(held.words) - 1)
            words = sorted(list(held.words)[2:])  # after the empty word and the border
            no = np.fromiter(map(held.words.__getitem__, words), np.int64, len(words))
            bucket = np.fromiter(map(zlib.crc32, words), np.int64, len(words)) % buckets
            order = np.argsort(bucket, kind="stable")
            rows = []
            for own in _runs(order, bucket):
                rows.append({"sheet": sheet, "lang": lang, "bucket": int(bucket[own[0]]),
                             "words": pa.compress(raw := b" ".join([words[i] for i in own]), codec="zstd", asbytes=True)
                             + len(raw).to_bytes(8, "little"),
                             "numbers": _pack(no[own].astype("<i4")), "counts": _pack(n[no[own]].astype("<i8"))})
            yield from _frame(SHEETS, rows).to_batches(max_chunksize=64)
    return run


def _word_list(blob: bytes) -> list[bytes]:
    return pa.decompress(blob[:-8], decompressed_size=int.from_bytes(blob[-8:], "little"), codec="zstd",
                         asbytes=True).split(b" ")


def _count_words(least: int, buckets: int):
    """A bucket's words over all sheets: the frequent ones, each sheet's numbers
    of them, and the words of each language in all."""
    def run(key: tuple[pa.Scalar, ...], t: pa.Table) -> pa.Table:
        bucket, total = key[0].as_py(), defaultdict(int)
        lists = [(s, lang, _word_list(w), _unpack(no, "<i4"), _unpack(n, "<i8")) for s, lang, w, no, n in zip(
            *[t[c].to_pylist() for c in ("sheet", "lang", "words", "numbers", "counts")])]
        every = defaultdict(int)
        for _, lang, words, _, n in lists:
            every[lang] += int(n.sum())
            for w, k in zip(words, n.tolist()):
                total[lang, w] += k
        frequent = sorted(k for k, f in total.items() if f >= least)
        gid = {k: i * buckets + bucket for i, k in enumerate(frequent)}
        rows = [{"gid": gid[k], "f": total[k], "lang": k[0], "word": k[1].decode()} for k in frequent]
        rows += [{"f": n, "lang": lang} for lang, n in every.items()]
        for sheet, lang, words, no, _ in lists:
            got = [(i, gid[lang, w]) for i, w in zip(no.tolist(), words) if (lang, w) in gid]
            if got:
                first, ids = np.array(got, "<i8").T
                rows.append({"sheet": sheet, "first": _pack(first), "gids": _pack(ids)})
        return _frame(FOUND, rows)
    return run


def _relation(sheet: int, slots: np.ndarray, gids: np.ndarray) -> dict:
    """A relation's row: slots as differences, groups as places in ``names``."""
    names, groups = np.unique(gids, return_inverse=True)
    return {"sheet": sheet, "slots": _pack(np.diff(slots, prepend=0).astype("<i4")),
            "groups": _pack(groups.astype("<i4")), "names": _rising(names)}


def _first_relation(sheet: pa.Table, found: pa.Table) -> pa.Table:
    """Relation of the frequent words: a sheet's texts with their numbers."""
    if not sheet.num_rows or not found.num_rows:
        return _frame(RELATION, [])
    ids = _unpack(sheet["blob"][0].as_py(), "<i4")
    no, gid = (np.concatenate([_unpack(x, "<i8") for x in found[c].to_pylist()]) for c in ("first", "gids"))
    of = np.full(int(max(ids.max(), no.max())) + 1, -1, np.int64)
    of[no] = gid
    got = of[ids]
    slots = np.flatnonzero(got >= 0)
    return _frame(RELATION, [_relation(sheet["sheet"][0].as_py(), slots, got[slots])])


def _joined(slots: np.ndarray, groups: np.ndarray, names: np.ndarray):
    """Merge-join of a relation with itself on the next slot: the slots and the
    pairs as single numbers.  Both sides are sorted and slots are unique, so a
    row's partner is the row behind it or there is none."""
    slot, group = np.cumsum(slots), groups.astype(np.int64)
    met = np.flatnonzero(slot[1:] == slot[:-1] + 1)
    return slot[met], group[met] * len(names) + group[met + 1]


def _read(sheet, slots, groups, names):
    return sheet, _unpack(slots, "<i4"), _unpack(groups, "<i4"), _risen(names)


def _mixed(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    x = a.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) ^ b.astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F)
    x ^= x >> np.uint64(29)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    return (x >> np.uint64(32)).astype(np.int64)


def _pairs(buckets: int):
    """The distinct pairs of each sheet with their counts, by bucket."""
    def run(batches):
        for batch in slices(batches, 1):
            for row in zip(*[c.to_pylist() for c in batch.columns]):
                sheet, slots, groups, names = _read(*row)
                key, n = np.unique(_joined(slots, groups, names)[1], return_counts=True)
                if not len(key):
                    continue
                a, b = names[key // len(names)], names[key % len(names)]
                bucket = _mixed(a, b) % buckets
                order = np.argsort(bucket, kind="stable")
                rows = [{"bucket": int(bucket[own[0]]), "sheet": sheet, "a": _rising(a[own]), "b": _pack(b[own]),
                         "n": _pack(n[own].astype("<i8"))}
                        for own in _runs(order, bucket)]
                yield from _frame(PAIRS, rows).to_batches(max_chunksize=64)
    return run


def _count_pairs(least: int, buckets: int, tell: bool):
    """A bucket's pairs over all sheets: the frequent ones and, if ``tell``, each
    sheet's own of them."""
    def run(key: tuple[pa.Scalar, ...], t: pa.Table) -> pa.Table:
        bucket, sheets = key[0].as_py(), t["sheet"].to_pylist()
        parts = [[_risen(a), _unpack(b, "<i8"), _unpack(n, "<i8")] for a, b, n in zip(
            *[t[c].to_pylist() for c in ("a", "b", "n")])]
        of = np.repeat(np.arange(len(parts)), [len(p[0]) for p in parts])
        a, b, n = (np.concatenate(c) for c in zip(*parts))
        order = np.lexsort((of, b, a))
        a, b, n, of = a[order], b[order], n[order], of[order]
        start = np.flatnonzero(np.r_[True, (a[1:] != a[:-1]) | (b[1:] != b[:-1])])
        f = np.add.reduceat(n, start)
        ok = f >= least
        gid = (np.cumsum(ok) - 1) * buckets + bucket
        rows = [{"gid": g, "f": k, "a": x, "b": y} for g, k, x, y in zip(
            gid[ok].tolist(), f[ok].tolist(), a[start[ok]].tolist(), b[start[ok]].tolist())]
        if tell and rows:
            group = np.repeat(np.arange(len(start)), np.diff(np.r_[start, len(a)]))
            mine = np.flatnonzero(ok[group])
            mine = mine[np.argsort(of[mine], kind="stable")]
            for own in _runs(mine, of):
                rows.append({"sheet": sheets[of[own[0]]], "first": _rising(a[own]), "second": _pack(b[own]),
                             "gids": _pack(gid[group[own]])})
        return _frame(FOUND, rows)
    return run


def _next_relation(relation: pa.Table, found: pa.Table) -> pa.Table:
    """The joined rows of a sheet whose pairs are frequent, with their numbers."""
    if not relation.num_rows or not found.num_rows:
        return _frame(RELATION, [])
    sheet, slots, groups, names = _read(*[c[0].as_py() for c in relation.columns])
    slot, key = _joined(slots, groups, names)
    a = np.searchsorted(names, np.concatenate([_risen(x) for x in found["first"].to_pylist()]))
    b, gid = (np.concatenate([_unpack(x, "<i8") for x in found[c].to_pylist()]) for c in ("second", "gids"))
    mine = a * len(names) + np.searchsorted(names, b)
    order = np.argsort(mine)
    mine, gid = mine[order], gid[order]
    at = np.minimum(np.searchsorted(mine, key), len(mine) - 1)
    ok = mine[at] == key
    return _frame(RELATION, [_relation(sheet, slot[ok], gid[at[ok]])])


def frequent_phrases(docs: DataFrame, lang_col: str = "lang", text_col: str = "text", longest: int = LONGEST,
                     least: int = LEAST_COUNT, sheet: int = SHEET) -> tuple[list[DataFrame], DataFrame]:
    """Tables of the frequent phrases of 1, 2, ... words (gid, lang, phrase,
    last, f), and (lang, n), all words of each language.

    Null languages are ``und``; null and empty texts have no words; repeated
    rows count each; an empty table gives empty tables; extra columns are
    ignored."""
    rows = docs.select(F.coalesce(F.col(lang_col), F.lit("und")).alias("lang"), text_or_empty(text_col).alias("text"))
    buckets = BUCKETS * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    sheets = stage(rows.mapInArrow(_sheets(sheet, buckets), SHEETS), "sheets")
    found = stage(sheets.where("bucket is not null").select("bucket", "sheet", "lang", "words", "numbers", "counts")
                  .groupBy("bucket").applyInArrow(_count_words(least, buckets), FOUND), "words")
    totals = stage(found.where("gid is null and sheet is null").groupBy("lang").agg(F.sum("f").alias("n")), "totals")
    level = stage(found.where("gid is not null").select("gid", "lang", F.col("word").alias("phrase"),
                                                        F.col("word").alias("last"), "f"), "phrases-1")
    texts = sheets.where("blob is not null").select("sheet", "blob")
    own = found.where("sheet is not null").select(F.col("sheet").alias("of"), "first", "gids")
    relation = texts.groupBy("sheet").cogroup(own.groupBy("of")).applyInArrow(_first_relation, RELATION)
    levels = [level]
    for size in range(2, longest + 1):
        relation = stage(relation, f"relation-{size - 1}")
        found = stage(relation.mapInArrow(_pairs(buckets), PAIRS).groupBy("bucket")
                      .applyInArrow(_count_pairs(least, buckets, size < longest), FOUND), f"pairs-{size}")
        pairs = found.where("gid is not null").select("gid", "f", "a", "b")
        if not pairs.head(1):
            break
        front = level.select(F.col("gid").alias("a"), "lang", "phrase")
        back = level.select(F.col("gid").alias("b"), "last")
        level = stage(pairs.join(front, "a").join(back, "b").select(
            "gid", "lang", F.concat_ws(" ", "phrase", "last").alias("phrase"), "last", "f"), f"phrases-{size}")
        levels.append(level)
        own = found.where("sheet is not null").select(F.col("sheet").alias("of"), "first", "second", "gids")
        relation = relation.groupBy("sheet").cogroup(own.groupBy("of")).applyInArrow(_next_relation, RELATION)
    return levels, totals


def collocations(docs: DataFrame, lang_col: str = "lang", text_col: str = "text", longest: int = LONGEST,
                 least: int = LEAST_COUNT, covered: int = COVERED, sheet: int = SHEET) -> DataFrame:
    """(lang, phrase, a, l, r, n, score): the phrases of 2 to ``longest`` words
    that occur at least ``least`` times and aren't covered by a longer one.

    Of the cuts of a phrase the lowest score counts, the first one among
    equals.  A phrase is covered if its words stand in a longer frequent phrase
    that has ``covered`` percent of its count; counts only fall with length, so
    phrases longer by one word decide."""
    levels, totals = frequent_phrases(docs, lang_col, text_col, longest, least, sheet)
    if len(levels) == 1:
        return _empty(docs.sparkSession)
    known = levels[0].select("lang", "phrase", "f")
    for x in levels[1:]:
        known = known.unionAll(x.select("lang", "phrase", "f"))
    long = levels[1].select("lang", "phrase", "f")
    for x in levels[2:]:
        long = long.unionAll(x.select("lang", "phrase", "f"))
    words = F.split("phrase", " ")
    cut = long.select("lang", "phrase", F.col("f").alias("a"), words.alias("words"),
                      F.explode(F.sequence(F.lit(1), F.size(words) - 1)).alias("k"))
    cut = cut.select("lang", "phrase", "a", "k", F.array_join(F.slice("words", F.lit(1), F.col("k")), " ").alias("left"),
                     F.array_join(F.slice("words", F.col("k") + 1, F.size("words")), " ").alias("right"))
    l = known.select("lang", F.col("phrase").alias("left"), F.col("f").alias("l"))
    r = known.select("lang", F.col("phrase").alias("right"), F.col("f").alias("r"))
    # Integers of up to 38 digits.
    score = F.expr("(cast(1000 * a as decimal(38,0)) * cast(n as decimal(38,0))) div "
                   "(cast(l as decimal(38,0)) * cast(r as decimal(38,0)))")
    scored = (cut.join(l, ["lang", "left"]).join(r, ["lang", "right"]).join(totals, "lang")
              .select("lang", "phrase", "a", "n", F.struct(score.alias("score"), "k", "l", "r").alias("cut"))
              .groupBy("lang", "phrase", "a", "n").agg(F.min("cut").alias("cut")))
    parts = long.select("lang", words.alias("words"), F.col("f").alias("longer")).where(F.size("words") > 2)
    shorter = parts.select("lang", "longer", F.explode(F.array(
        F.array_join(F.slice("words", F.lit(1), F.size("words") - 1), " "),
        F.array_join(F.slice("words", F.lit(2), F.size("words") - 1), " "))).alias("phrase"))
    shorter = shorter.groupBy("lang", "phrase").agg(F.max("longer").alias("longer"))
    left = scored.join(shorter, ["lang", "phrase"], "left").where(
        F.col("longer").isNull() | (100 * F.col("longer") < covered * F.col("a")))
    return left.select("lang", "phrase", "a", F.col("cut.l").alias("l"), F.col("cut.r").alias("r"), "n",
                       F.col("cut.score").alias("score"))


def _empty(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], "lang string, phrase string, a bigint, l bigint, r bigint, n bigint, score bigint")


def best(found: DataFrame, top: int = TOP) -> DataFrame:
    """Each language's first ``top`` phrases by score, count and bytes."""
    by = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    return (found.withColumn("rank", F.row_number().over(by)).where(F.col("rank") <= top)
            .withColumn("rank", F.col("rank").cast("bigint")))


ORACLE = r"""with pieces as (
  select lang, p, len(w) as m, w from (
    select lang, p, list_filter(string_split_regex(piece, '[\x20\x09]+'), lambda x: x <> '') as w
    from (select lang, piece, row_number() over () as p
          from (select coalesce(lang, 'und') as lang, unnest(string_split_regex(
                  translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                  '[.,;:!?\x0A-\x0D]')) as piece from documents)))),
starts as (select lang, w, m, unnest(range(1, m + 1)) as i from pieces where m > 0),
counts as (
  select lang, k, phrase, count(*) as f
  from (select lang, k, array_to_string(w[i:i + k - 1], ' ') as phrase
        from starts, (select unnest([1, 2, 3, 4, 5]) as k) where i + k - 1 <= m)
  group by lang, k, phrase having count(*) >= 100),
totals as (select lang, count(*) as n from starts group by lang),
long as (select lang, k, phrase, f as a, string_split(phrase, ' ') as w from counts where k > 1),
cuts as (select *, unnest(range(1, k)) as c from long),
scored as (
  select c.lang, c.phrase, c.k, c.a, c.w, c.c, l.f as l, r.f as r, t.n,
         (1000::hugeint * c.a * t.n) // (l.f::hugeint * r.f) as score
  from cuts c
  join counts l on l.lang = c.lang and l.phrase = array_to_string(c.w[1:c.c], ' ')
  join counts r on r.lang = c.lang and r.phrase = array_to_string(c.w[c.c + 1:c.k], ' ')
  join totals t on t.lang = c.lang),
lowest as (select * from scored qualify row_number() over (partition by lang, phrase order by score, c) = 1),
kept as (
  select * from lowest s where not exists (
    select 1 from long b where b.lang = s.lang and b.k > s.k and 100 * b.a >= 100 * s.a
      and (' ' || b.phrase || ' ') like ('% ' || replace(replace(replace(s.phrase, '\', '\\'), '%', '\%'), '_', '\_') || ' %') escape '\'))
select * from (
  select lang, row_number() over (partition by lang order by score desc, a desc, phrase) as rank, phrase, a, l, r,
         n, score::bigint as score from kept)
where rank <= 2000"""


@query("op12_phrase_collocations", ORACLE)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = best(collocations(table(spark, sf_dir, "documents")))
    return found.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
