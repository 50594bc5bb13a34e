"""SimHash near-dedup with a pigeonring filter.

The 64-bit fingerprint is cut into ``SEGMENTS`` segments laid on a ring.  If
two fingerprints differ in at most ``t`` bits, some segment starts a chain in
which the first l segments differ in at most l*t/SEGMENTS bits, for every l
(the strong pigeonhole form on a ring).  With 5 segments and t = 4 the first
segment is equal and the second differs in one bit at most, so candidates meet
on a 26-bit key: a fingerprint is stored under its five (segment, next segment)
keys and asks for these keys and their one-bit changes of the second segment.
The longer chains are then checked one by one before the full distance.

Rows are spread by key; inside a task the rows of one key arrive together.
Keys held by more than ``block`` fingerprints are cut into a grid of blocks, so
no task holds an unbounded key.  A task returns a spanning forest of the links
that it found, never all pairs of a group.  Exact copies meet as one
fingerprint before the search."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkwright.llm.components import components, forest
from sparkwright.llm.shared import KEY, query, release, row_key, same_key, slices, stage, table

SEGMENTS = 5
WIDTHS = (13, 13, 13, 13, 12)
SHIFTS = (0, 13, 26, 39, 52)
BLOCK = 4096
PAIRS_AT_ONCE = 2_000_000


def fingerprint(text: str | None, shingle: int = 4) -> int:
    """Unsigned 64-bit fingerprint: the majority of each bit over the XXH64
    (seed 42) of every word shingle; no words: 0."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    flat = b" ".join(words)
    if len(words) <= shingle:
        spans = [(0, len(flat))]
    else:
        size = np.fromiter(map(len, words), np.int64, len(words))
        end = np.cumsum(size + 1) - 1
        spans = list(zip((end - size)[: len(words) - shingle + 1].tolist(), end[shingle - 1:].tolist()))
    digest, ones = xxhash.xxh64_intdigest, np.zeros(64, np.int64)
    for k in range(0, len(spans), 65536):
        h = np.array([digest(flat[a:b], 42) for a, b in spans[k: k + 65536]], "<u8")
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(ones * 2 > len(spans), bitorder="little").view("<u8")[0])


def _fingerprints(shingle: int):
    def run(batches):
        for b in slices(batches):
            fp = np.array([fingerprint(t, shingle) for t in b.column(1).to_pylist()], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fp)], names=["doc_id", "fp"])
    return run


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 4) -> DataFrame:
    """(doc_id, fp): one row per input row; fp is the fingerprint as a signed
    bigint.  Null and empty texts have 0."""
    ids = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))
    return ids.mapInArrow(_fingerprints(shingle), "doc_id bigint, fp bigint")


def _segments(fp: np.ndarray) -> list[np.ndarray]:
    return [(fp >> np.uint64(s)) & np.uint64((1 << w) - 1) for s, w in zip(SHIFTS, WIDTHS)]


def _store_keys(fp: np.ndarray) -> list[tuple[np.ndarray, int]]:
    seg = _segments(fp)
    return [((np.uint64(i) << np.uint64(26)) | (seg[i] << np.uint64(13)) | seg[(i + 1) % SEGMENTS], i)
            for i in range(SEGMENTS)]


def _keys(ask: bool):
    """Rows (key, ask, fp): the stored keys, or those that a fingerprint asks for."""
    def run(batches):
        for b in batches:
            fp = b.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
            for at in range(0, len(fp), 8192):
                part = fp[at: at + 8192]
                keys = []
                for key, i in _store_keys(part):
                    keys.append(key)
                    if ask:
                        keys += [key ^ np.uint64(1 << bit) for bit in range(WIDTHS[(i + 1) % SEGMENTS])]
                n = len(part) * len(keys)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(keys).view(np.int64)), pa.array(np.full(n, ask)),
                     pa.array(np.tile(part, len(keys)).view(np.int64))], names=["key", "ask", "fp"])
    return run


def _chain_masks(i: int) -> list[np.ndarray]:
    """Masks of the segments i .. i+l-1, for l = 3, 4 and 5."""
    out, mask = [], 0
    for k in range(SEGMENTS):
        j = (i + k) % SEGMENTS
        mask |= ((1 << WIDTHS[j]) - 1) << SHIFTS[j]
        out.append(mask)
    return [np.uint64(x) for x in out[2:]]


MASKS = np.array([_chain_masks(i) for i in range(SEGMENTS)], np.uint64)


def _viable(key: np.ndarray, x: np.ndarray, bits: int) -> np.ndarray:
    """Which pairs, with differing bits ``x``, pass every chain from the key's
    segment; the last chain is the whole ring, so it is the full distance."""
    start = (key >> 26).astype(np.int64)
    alive = np.arange(len(x))
    for l in range(3, SEGMENTS + 1):
        alive = alive[np.bitwise_count(x[alive] & MASKS[start[alive], l - 3]) <= l * bits // SEGMENTS]
    return alive


def _links_of(key, ask, fp, bits: int):
    """Links among rows sorted by key, stored rows before asking ones."""
    if not len(key):
        return
    first = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
    size = np.diff(np.r_[first, len(key)])
    stored = np.add.reduceat((~ask).astype(np.int64), first)
    asking = size - stored
    hold = (stored > 0) & (asking > 1)
    first, stored, asking = first[hold], stored[hold], asking[hold]
    pairs = stored * asking
    upto = np.cumsum(pairs)
    g = 0
    while g < len(first):
        # Groups that fit one chunk together; a group above it is cut further.
        h = max(g + 1, int(np.searchsorted(upto, PAIRS_AT_ONCE + upto[g] - pairs[g], "right")))
        f, s, a, p = first[g:h], stored[g:h], asking[g:h], pairs[g:h]
        total = int(p.sum())
        for lo in range(0, total, PAIRS_AT_ONCE):
            n = np.arange(lo, min(total, lo + PAIRS_AT_ONCE))
            at = np.searchsorted(np.cumsum(p), n, "right")
            r = n - (np.cumsum(p) - p)[at]
            left, right = f[at] + r // a[at], f[at] + s[at] + r % a[at]
            x = fp[left] ^ fp[right]
            other = np.flatnonzero(x)
            ok = other[_viable(key[left[other]], x[other], bits)]
            if len(ok):
                yield fp[left[ok]].view(np.int64), fp[right[ok]].view(np.int64)
        g = h


def _match(bits: int):
    """Links of each key's rows as a forest; the rows are sorted by key and
    block, so a group is complete when the next one starts."""
    def run(batches):
        rest = None
        release()
        for b in batches:
            cols = [b.column(k).to_numpy(zero_copy_only=False) for k in range(4)]
            if rest is not None:
                cols = [np.concatenate(x) for x in zip(rest, cols)]
            same = (cols[0] == cols[0][-1]) & (cols[1] == cols[1][-1])
            cut = int(np.argmax(same)) if len(same) else 0
            rest = [c[cut:].copy() for c in cols]
            if cut:
                yield from found([c[:cut] for c in cols])
        if rest is not None and len(rest[0]):
            yield from found(rest)

    def found(cols):
        key, block, ask, fp = cols[0], cols[1], cols[2].astype(bool), cols[3].view(np.uint64)
        edges = list(_links_of_blocks(key, block, ask, fp, bits))
        if edges:
            u, v = forest(np.concatenate([e[0] for e in edges]), np.concatenate([e[1] for e in edges]))
            yield pa.RecordBatch.from_arrays([pa.array(u), pa.array(v)], names=["u", "v"])
    return run


def _links_of_blocks(key, block, ask, fp, bits):
    # Blocks of one key are groups of their own.
    if not block.any():
        yield from _links_of(key, ask, fp, bits)
        return
    for bl in np.unique(block):
        at = block == bl
        yield from _links_of(key[at], ask[at], fp[at], bits)


def _blocked(keys: DataFrame, heavy: DataFrame) -> DataFrame:
    """Cut the rows of heavy keys into a parts x parts grid: a stored row goes
    to every column of its row block, an asking one to every row of its column."""
    part = F.pmod(F.xxhash64("fp"), F.col("parts"))
    turn = F.explode(F.sequence(F.lit(0), F.col("parts") - 1))
    rows = keys.join(heavy, "key", "left")
    plain = rows.where("parts is null").select("key", F.lit(0).cast("bigint").alias("block"), "ask", "fp")
    cut = rows.where("parts is not null").select("key", "ask", "fp", "parts", part.alias("own"), turn.alias("other"))
    block = (F.when(F.col("ask"), F.col("other") * F.col("parts") + F.col("own"))
             .otherwise(F.col("own") * F.col("parts") + F.col("other")) + 1)
    return plain.unionAll(cut.select("key", block.cast("bigint").alias("block"), "ask", "fp"))


def near_links(prints: DataFrame, bits: int = 4, block: int = BLOCK) -> DataFrame:
    """(u, v): a spanning forest, per task, of all pairs of the distinct
    fingerprints (column ``fp``) that differ in 1 to ``bits`` bits.  ``bits``
    up to 4 keeps the first segment of a chain equal."""
    if not 0 <= bits < SEGMENTS:
        raise ValueError(f"bits must lie in 0..{SEGMENTS - 1}")
    stored = prints.select("fp").mapInArrow(_keys(False), "key bigint, ask boolean, fp bigint")
    asking = prints.select("fp").mapInArrow(_keys(True), "key bigint, ask boolean, fp bigint")
    heavy = stage(stored.groupBy("key").count().where(F.col("count") > block)
                  .select("key", F.ceil(F.col("count") / block).cast("bigint").alias("parts")), "heavy-keys")
    keys = stored.unionAll(asking)
    rows = keys.select("key", F.lit(0).cast("bigint").alias("block"), "ask", "fp")
    if heavy.head(1):
        rows = _blocked(keys, heavy)
    return (rows.repartition("key", "block").sortWithinPartitions("key", "block", "ask")
            .mapInArrow(_match(bits), "u bigint, v bigint"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    shingle: int = 4, bits: int = 4, block: int = BLOCK) -> DataFrame:
    """One row per row of ``docs``: doc_id, fp, fingerprint (16 hex digits) and
    component_id, the smallest id reached by links of at most ``bits`` bits.

    Null and empty texts have fingerprint 0 and link like any other.  Repeated
    rows stay repeated.  A null id gets its component's id (null when no
    document of the component has an id).  An empty table gives an empty one;
    extra columns are ignored, whatever their names."""
    rows = stage(fingerprints(docs, id_col, text_col, shingle), "prints")
    prints = stage(rows.groupBy("fp").agg(F.min("doc_id").alias("low")), "distinct-prints")
    groups = components(near_links(prints, bits, block)).withColumnRenamed("node", "fp")
    named = prints.join(groups, "fp", "left").select("fp", "low", F.coalesce("root", "fp").alias("root"))
    low = named.groupBy("root").agg(F.min("low").alias("component_id"))
    of = named.join(low, "root").select("fp", "component_id")
    return rows.join(of, "fp").select(
        "doc_id", "fp", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 4,
             bits: int = 4) -> DataFrame:
    """``docs`` with one row of each component.

    A row counts by its id and text, so rows of one id or without an id are
    told apart.  The smallest row stays: ids before none, then the smaller id,
    then the text's hashes; of rows alike in id and text one stays."""
    rows = docs.select(*row_key(id_col, text_col), F.col(text_col).alias("text"))
    rows = stage(rows.withColumn("k_id", F.col("k_id").cast("bigint"))
                 .mapInArrow(_keyed_prints(shingle), KEYED), "prints")
    links = near_links(rows.groupBy("fp").agg(F.lit(1).alias("one")), bits)
    groups = components(links).withColumnRenamed("node", "fp")
    order = F.struct(F.col("k_id").isNull().alias("none"), *KEY)
    # The smallest row of each fingerprint, then of each component.
    low = rows.groupBy("fp").agg(F.min(order).alias("low"))
    named = stage(low.join(groups, "fp", "left").select("fp", "low", F.coalesce("root", "fp").alias("root")), "named")
    least = named.groupBy("root").agg(F.min("low").alias("least"))
    least = named.join(least, "root").select("fp", "least")
    marked = rows.groupBy("fp", *KEY).agg(F.count("*").alias("copies")).join(least, "fp")
    stays = F.col("least").eqNullSafe(order)
    # Rows to drop, and rows that stay but repeat.
    drop = stage(marked.where(~stays).select(*KEY), "drop")
    again = stage(marked.where(stays & (F.col("copies") > 1)).select(*KEY), "again")
    keyed = docs.select(F.struct("*").alias("row"), *row_key(id_col, text_col))
    # The rows to drop grow with the input: the same join at every size.
    left = keyed.join(drop.hint("merge"), same_key(keyed, drop), "left_anti")
    if not again.head(1):
        return left.select("row.*")
    on = same_key(left, again)
    once = left.join(again, on, "left_semi").groupBy(*KEY).agg(F.first("row").alias("row"))
    return left.join(again, on, "left_anti").select("row.*").unionAll(once.select("row.*"))


KEYED = "k_id bigint, k_h1 bigint, k_h2 int, k_len int, fp bigint"


def _keyed_prints(shingle: int):
    def run(batches):
        for b in slices(batches):
            fp = np.array([fingerprint(t, shingle) for t in b.column(4).to_pylist()], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([*b.columns[:4], pa.array(fp)], names=["k_id", "k_h1", "k_h2", "k_len", "fp"])
    return run


@query("op1_simhash_near_dedup")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents")).drop("fp")
