"""Removal of repeated substrings by a hash-compared suffix sort.

A byte goes when it lies in a window of ``WINDOW`` bytes that also starts
earlier.  Windows are compared through anchors: the anchor of a window is its
smallest gram of ``GRAM`` bytes by polynomial hash (the leftmost among equals),
so equal windows have equal anchors at equal places.  The windows with one
anchor are neighbours; their union is the anchor's span (under twice the
window), the only text that can decide about them.

1. Every task hashes its texts with prefix polynomials and lists their anchors
   (gram hash, span hash, place).  Spans alike within the task are settled on
   the spot, so a hot passage leaves one row a task.
2. Anchors meet by gram.  Of spans alike all but the first are removed; grams
   with one span are done.
3. The spans that share a gram but differ are fetched from their texts.  A task
   sorts the suffixes that start at the anchors, and the prefixes that end
   there, by mergesort; two of them are compared by the length of their common
   extension, a binary search over prefix hashes.  The extensions of neighbours
   are verified byte by byte.  Two windows are equal if their suffixes agree on
   the right of the anchor and their prefixes on its left, which the sorted
   orders answer for all windows at a time.
4. Grams with very many spans (found in a sample of texts that is used for
   nothing else) would be one big group.  Their spans are compared as single
   windows, by two hashes, each window a group of its own.

Spans that count as alike agree in gram hash and span hash, which use different
bases: 128 bits."""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkwright.llm.shared import query, release, same_key, slices, stage, table, text_or_empty

WINDOW = 100
GRAM = 20
#: Bytes of text hashed together; longer texts in overlapping pieces.
PIECE = 1 << 19
#: A block holds less than two pieces and a window.
BLOCK_BITS = 21
#: Anchors settled together inside a task.
ANCHORS_AT_ONCE = 1 << 20
#: One text in so many is looked at for hot grams; a gram is hot from so many
#: different spans in the sample on.
SAMPLE = 64
HOT_SPANS = 16
#: Hot grams at most: a bound for the list that goes to every task.  A gram
#: beyond it is treated like any other.
HOT_GRAMS = 10_000

BASES = (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93)
NULL_ID = -(1 << 63)
ANCHOR = "g bigint, h bigint, doc bigint, place bigint, lo smallint, hi smallint, kind tinyint"
#: Kinds of rows: an anchor, a window of a hot gram, removed bytes [place, g).
SPAN, HOT, GONE = 0, 1, 2
PLACE_BITS = 31


@lru_cache(maxsize=8)
def _powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of a base and of its inverse modulo 2^64."""
    out = []
    for b in (base, pow(base, -1, 1 << 64)):
        p = np.full(n, np.uint64(b))
        p[:1] = 1
        out.append(np.multiply.accumulate(p))
    return out[0], out[1]


class Prefixes:
    """Prefix polynomial hashes of a byte buffer: equal substrings have equal
    hashes wherever they stand."""

    def __init__(self, data: np.ndarray, which: int):
        n = len(data)
        # Powers up to a size that is a power of two are kept.
        self.power, self.inverse = _powers(BASES[which], 1 << max(10, (n + 1).bit_length()))
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * self.power[:n], out=self.sums[1:])

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return (self.sums[end] - self.sums[start]) * self.inverse[start]

    def grams(self, size: int) -> np.ndarray:
        n = len(self.sums) - size
        return _mixed((self.sums[size:] - self.sums[:n]) * self.inverse[:n])


def _mixed(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(29))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


def _sliding_least(x: np.ndarray, width: int) -> np.ndarray:
    """Least of x[i : i + width], by doubling."""
    done = 1
    while done < width:
        step = min(done, width - done)
        x = np.minimum(x[:-step], x[step:])
        done += step
    return x


def anchors(data: np.ndarray, ends: np.ndarray, window: int = WINDOW, gram: int = GRAM):
    """Anchors of all windows of the texts laid end to end in ``data`` (text k
    ends before ends[k]): text, place of the anchor, first and last window
    start, gram hash, and the two prefix hashes."""
    if len(data) >> BLOCK_BITS:
        raise ValueError("too many bytes at once")
    one, two = Prefixes(data, 0), Prefixes(data, 1)
    none = np.empty(0, np.int64)
    if len(data) < window:
        return none, none, none, none, none.view(np.uint64), one, two
    g = one.grams(gram)
    # The place in the low bits makes the leftmost of equal grams the least.
    # Grams count by their upper bits: the same ones in every block.
    bits = np.uint64(BLOCK_BITS)
    ranked = (g >> bits << bits) | np.arange(len(g), dtype=np.uint64)
    least = _sliding_least(ranked, window - gram + 1)
    at = (least & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)
    begin = np.r_[0, ends[:-1]]
    size = np.maximum(ends - begin - window + 1, 0)
    start = np.repeat(begin, size) + np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
    text = np.repeat(np.arange(len(ends)), size)
    at = at[start]
    new = np.flatnonzero(np.r_[True, (at[1:] != at[:-1]) | (text[1:] != text[:-1])]) if len(at) else none
    last = np.r_[new[1:], len(at)] - 1 if len(at) else none
    return text[new], at[new], start[new], start[last], g[at[new]], one, two


def _order(doc: np.ndarray, place: np.ndarray, *keys: np.ndarray) -> np.ndarray:
    return np.lexsort((place, doc, *reversed(keys)))


def _gone(doc, place, lo, hi):
    """Rows of removed bytes, neighbouring ones as one."""
    o = np.lexsort((lo, place, doc))
    tie, at = place[o] >> PLACE_BITS, place[o] & ((1 << PLACE_BITS) - 1)
    doc, start, end = doc[o], at - hi[o], at - lo[o] + WINDOW
    if not len(doc):
        return doc, tie, start, end
    # Starts ascend almost: sort them by text, then join what overlaps.
    o = np.lexsort((start, tie, doc))
    doc, tie, start, end = doc[o], tie[o], start[o], end[o]
    text = np.r_[True, (doc[1:] != doc[:-1]) | (tie[1:] != tie[:-1])]
    group = np.cumsum(text) - 1
    reach = np.maximum.accumulate(end + group * (1 << 33)) - group * (1 << 33)
    first = np.flatnonzero(text | np.r_[True, start[1:] > reach[:-1]])
    return doc[first], tie[first], start[first], reach[np.r_[first[1:], len(doc)] - 1]


def _anchor_rows(g, h, doc, place, lo, hi, kind):
    return pa.RecordBatch.from_arrays(
        [pa.array(g.view(np.int64)), pa.array(h.view(np.int64)), pa.array(doc), pa.array(place),
         pa.array(lo.astype(np.int16)), pa.array(hi.astype(np.int16)),
         pa.array(np.full(len(g), kind, np.int8) if np.isscalar(kind) else kind.astype(np.int8))],
        names=["g", "h", "doc", "place", "lo", "hi", "kind"])


def _gone_rows(doc, place, lo, hi):
    doc, tie, start, end = _gone(doc, place, lo, hi)
    none = np.zeros(len(doc), np.int64)
    return _anchor_rows(end.astype(np.int64), none, doc, (tie << PLACE_BITS) | start, none, none, GONE)


def _listed(hot, sample: bool = False):
    """Anchors of a task's texts, spans alike settled."""
    hot_grams = np.asarray(hot, np.int64).view(np.uint64)

    def run(batches):
        held, n = [], 0
        for block in _blocks(batches):
            found = one_block(*block)
            held.append(found)
            n += len(found[0])
            if n >= ANCHORS_AT_ONCE:
                yield from settled(held)
                held, n = [], 0
        if held:
            yield from settled(held)

    def one_block(raw, ends, doc, tie, shift):
        data = np.frombuffer(raw, np.uint8)
        text, at, first, last, g, one, two = anchors(data, ends)
        h = _mixed(two.of(first, last + WINDOW) + (last - first).astype(np.uint64))
        begin = np.r_[0, ends[:-1]][text]
        place = (tie[text] << PLACE_BITS) | (at - begin + shift[text])
        rows = [g, h, doc[text], place, at - last, at - first]
        is_hot = np.isin(g, hot_grams) if len(hot_grams) else np.zeros(len(g), bool)
        extra = [np.empty(0, r.dtype) for r in rows]
        if is_hot.any():
            # One row per window of a hot gram, by two hashes.
            k = np.flatnonzero(is_hot)
            size = last[k] - first[k] + 1
            who = np.repeat(k, size)
            start = np.repeat(first[k], size) + np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
            off = at[who] - start
            extra = [_mixed(one.of(start, start + WINDOW)), _mixed(two.of(start, start + WINDOW)), doc[text][who],
                     place[who], off, off]
        keep = ~is_hot
        return [np.concatenate([r[keep], e]) for r, e in zip(rows, extra)] + [
            np.r_[np.full(keep.sum(), SPAN, np.int8), np.full(len(extra[0]), HOT, np.int8)]]

    def settled(held):
        g, h, doc, place, lo, hi, kind = [np.concatenate(c) for c in zip(*held)]
        # Windows stand by their start, spans by their anchor: alike spans have alike distances.
        o = _order(doc, place, kind, g, h)
        g, h, doc, place, lo, hi, kind = [c[o] for c in (g, h, doc, place, lo, hi, kind)]
        first = _firsts(kind, g, h, doc, place)
        for at in range(0, len(g), 200_000):
            s = slice(at, at + 200_000)
            f = first[s]
            yield _anchor_rows(g[s][f], h[s][f], doc[s][f], place[s][f], lo[s][f], hi[s][f], kind[s][f])
        if not sample and not first.all():
            yield _gone_rows(doc[~first], place[~first], lo[~first], hi[~first])
    return run


def _firsts(kind, g, h, doc, place):
    """Of rows sorted by (kind, g, h, doc, place) those that are first of their
    (kind, g, h), or repeat the first one's text and place."""
    if not len(g):
        return np.zeros(0, bool)
    head = np.r_[True, (kind[1:] != kind[:-1]) | (g[1:] != g[:-1]) | (h[1:] != h[:-1])]
    lead = np.flatnonzero(head)[np.cumsum(head) - 1]
    return (doc == doc[lead]) & (place == place[lead])


def _blocks(batches):
    """(bytes, ends, doc, tie, shift) of some texts, or of a piece of a long
    one; pieces overlap so that each window lies in exactly one."""
    release()
    raw, ends, doc, tie, shift, size = [], [], [], [], [], 0

    def block():
        return (b"".join(raw), np.array(ends, np.int64), np.array(doc, np.int64), np.array(tie, np.int64),
                np.array(shift, np.int64))

    for b in slices(batches):
        for d, t, text in zip(*[b.column(k).to_pylist() for k in range(3)]):
            data = text.encode("utf-8", "surrogatepass")
            for at in range(0, max(1, len(data) - WINDOW + 1), PIECE):
                part = data[at: at + PIECE + WINDOW - 1]
                if len(part) < WINDOW:
                    continue
                raw.append(part)
                size += len(part)
                ends.append(size)
                doc.append(NULL_ID if d is None else d)
                tie.append(t)
                shift.append(at)
                if size >= PIECE:
                    yield block()
                    raw, ends, doc, tie, shift, size = [], [], [], [], [], 0
    if raw:
        yield block()
    release()


def _meet(batches):
    """Rows sorted by (kind, g, h, doc, place) in, groups of a gram whole:
    removed bytes of all but the first of spans alike, and the different spans
    of grams that have several.  Removed bytes (the last kind) pass."""
    rest = None
    for b in batches:
        cols = [b.column(k).to_numpy(zero_copy_only=False) for k in range(7)]
        at = int(np.searchsorted(cols[6], GONE))
        if at < b.num_rows:
            yield b.slice(at)
            cols = [c[:at] for c in cols]
        if rest is not None:
            cols = [np.concatenate(c) for c in zip(rest, cols)]
        if not len(cols[0]):
            continue
        same = (cols[0] == cols[0][-1]) & (cols[6] == cols[6][-1])
        cut = int(np.argmax(same))
        if cut:
            yield from _met([c[:cut] for c in cols])
        rest = [c[cut:].copy() for c in cols]
    if rest is not None:
        yield from _met(rest)


def _met(cols):
    g, h, doc, place, lo, hi, kind = cols
    first = _firsts(kind, g, h, doc, place)
    lo, hi = lo.astype(np.int64), hi.astype(np.int64)
    if not first.all():
        yield _gone_rows(doc[~first], place[~first], lo[~first], hi[~first])
    # Spans of a gram: one row per (g, h) and place.
    span = np.flatnonzero(first & (kind == SPAN))
    if len(span):
        x, y = g[span], h[span]
        several = np.zeros(len(span), bool)
        change = (x[1:] == x[:-1]) & (y[1:] != y[:-1])
        several[1:] |= change
        group = np.cumsum(np.r_[True, x[1:] != x[:-1]]) - 1
        keep = span[np.bincount(group, several)[group] > 0]
        if len(keep):
            yield _anchor_rows(g[keep], h[keep], doc[keep], place[keep], lo[keep], hi[keep], SPAN)


def merge_sort(group: np.ndarray, before) -> np.ndarray:
    """Stable bottom-up mergesort of items within their groups (``group`` is
    sorted), all merges of a width at a time.  ``before(i, j)`` tells for
    arrays of items whether i comes strictly before j."""
    n = len(group)
    start = np.flatnonzero(np.r_[True, group[1:] != group[:-1]])
    size = np.diff(np.r_[start, n])
    base, length = np.repeat(start, size), np.repeat(size, size)
    order, place = np.arange(n), np.arange(n) - np.repeat(start, size)
    width, largest = 1, int(size.max()) if n else 0
    while width < largest:
        block = place // (2 * width) * (2 * width)
        left = place - block < width
        # The other run of the block: [a, b) within the group.
        a = np.where(left, block + width, block)
        b = np.minimum(np.where(left, block + 2 * width, block + width), length)
        act = np.flatnonzero(a < b)
        lo, hi = a[act].copy(), b[act].copy()
        while True:
            open_ = np.flatnonzero(lo < hi)
            if not len(open_):
                break
            mid = (lo[open_] + hi[open_]) // 2
            mine, other = order[act[open_]], order[base[act[open_]] + mid]
            # Left items go before equal right ones.
            is_left = left[act[open_]]
            right_of = np.empty(len(open_), bool)
            right_of[is_left] = before(other[is_left], mine[is_left])
            right_of[~is_left] = ~before(mine[~is_left], other[~is_left])
            lo[open_[right_of]] = mid[right_of] + 1
            hi[open_[~right_of]] = mid[~right_of]
        new = place.copy()
        new[act] = block[act] + (place - block - np.where(left, 0, width))[act] + (lo - a[act])
        moved = np.empty(n, np.int64)
        moved[base + new] = order
        order = moved
        width *= 2
    return order


class Sorted:
    """Suffixes of a buffer from ``start`` (at most up to ``end``), sorted
    within their groups, with the common extension of neighbours."""

    def __init__(self, data: np.ndarray, start: np.ndarray, end: np.ndarray, group: np.ndarray):
        self.data, self.start, self.end = data, start, end
        self.hashes = Prefixes(data, 0)
        self.order = merge_sort(group, self.before)
        a, b = self.order[:-1], self.order[1:]
        self.common = self.extension(a, b)
        if not self.verified(a, b):
            # Colliding hashes: sort by the bytes themselves.
            raw = data.tobytes()
            keys = [(int(g), raw[s:e]) for g, s, e in zip(group, start, end)]
            self.order = np.array(sorted(range(len(start)), key=keys.__getitem__), np.int64)
            self.common = np.array([_plain_extension(keys[i][1], keys[j][1])
                                    for i, j in zip(self.order[:-1], self.order[1:])], np.int64)
        # Neighbours of different groups have nothing in common.
        self.common[group[self.order[:-1]] != group[self.order[1:]]] = -1

    def extension(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Length of the common prefix of suffixes i and j, by binary search."""
        s, t = self.start[i], self.start[j]
        lo, hi = np.zeros(len(i), np.int64), np.minimum(self.end[i] - s, self.end[j] - t)
        while (lo < hi).any():
            mid = (lo + hi + 1) // 2
            equal = self.hashes.of(s, s + mid) == self.hashes.of(t, t + mid)
            lo = np.where(equal, mid, lo)
            hi = np.where(equal, hi, mid - 1)
        return lo

    def before(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        n = self.extension(i, j)
        s, t = self.start[i] + n, self.start[j] + n
        ends_i, ends_j = s >= self.end[i], t >= self.end[j]
        last = len(self.data) - 1
        less = self.data[np.minimum(s, last)] < self.data[np.minimum(t, last)]
        return np.where(ends_i, ~ends_j, ~ends_j & less)

    def verified(self, i: np.ndarray, j: np.ndarray) -> bool:
        """Whether neighbours agree byte by byte as far as their hashes say."""
        n = self.common
        who = np.repeat(np.arange(len(n)), n)
        step = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        return not (self.data[self.start[i][who] + step] != self.data[self.start[j][who] + step]).any()

    def classes(self, depth: int) -> np.ndarray:
        """Number of each suffix's class: alike in the first ``depth`` bytes."""
        out = np.empty(len(self.order), np.int64)
        out[self.order] = np.cumsum(np.r_[0, self.common < depth])
        return out


def _plain_extension(a: bytes, b: bytes) -> int:
    n = 0
    while n < min(len(a), len(b)) and a[n] == b[n]:
        n += 1
    return n


def repeated_windows(spans: list[bytes], group: np.ndarray, doc: np.ndarray, place: np.ndarray, lo: np.ndarray,
                     hi: np.ndarray, window: int = WINDOW):
    """Windows of spans that an earlier span of the group has too: (item,
    offset), the window starting ``offset`` bytes before the item's anchor.

    Item k is the span from hi[k] bytes before its anchor to lo[k] bytes before
    it plus ``window``.  Items are sorted by group, doc and place."""
    size = np.array([len(s) for s in spans], np.int64)
    end = np.cumsum(size)
    data = np.frombuffer(b"".join(spans), np.uint8)
    anchor = end - size + hi
    right = Sorted(data, anchor, end, group)
    back = data[::-1].copy()
    left = Sorted(back, len(data) - anchor, len(data) - (end - size), group)
    items, offsets = [], []
    earlier = np.r_[False, (group[1:] == group[:-1])]
    for off in range(int(lo.min()), int(hi.max()) + 1):
        own = np.flatnonzero((lo <= off) & (off <= hi))
        if len(own) < 2 or not earlier.any():
            continue
        key = left.classes(off)[own] * len(group) + right.classes(window - off)[own]
        # Items come by doc and place: the first of a class stays.
        _, head, which = np.unique(key, return_index=True, return_inverse=True)
        lead = own[head][which]
        late = (doc[lead] != doc[own]) | (place[lead] != place[own])
        items.append(own[late])
        offsets.append(np.full(int(late.sum()), off, np.int64))
    if not items:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    return np.concatenate(items), np.concatenate(offsets)


def _suffix_sorted(batches):
    """Rows (g, doc, place, lo, hi, span), sorted by g, doc and place: removed
    bytes by the suffix sort of each gram's spans."""
    rest, n = [], 0
    release()
    for b in batches:
        t = pa.Table.from_batches([b])
        rest.append(t)
        n += b.num_rows
        if n < 20_000:
            continue
        t = pa.concat_tables(rest).combine_chunks()
        g = t["g"].to_numpy()
        cut = int(np.argmax(g == g[-1]))
        if cut:
            yield from _sorted_rows(t.slice(0, cut))
        rest, n = [t.slice(cut)], t.num_rows - cut
    if n:
        yield from _sorted_rows(pa.concat_tables(rest).combine_chunks())
    release()


def _sorted_rows(t: pa.Table):
    g, doc, place, lo, hi = [t[c].to_numpy().astype(np.int64) for c in ("g", "doc", "place", "lo", "hi")]
    group = np.cumsum(np.r_[False, g[1:] != g[:-1]])
    item, off = repeated_windows(t["span"].to_pylist(), group, doc, place, lo, hi)
    if len(item):
        yield _gone_rows(doc[item], place[item], off, off)


def _fetch(batches):
    """Spans of a text from its list of anchors."""
    for b in slices(batches, 64):
        out = []
        for data, doc, items in zip(*[b.column(k).to_pylist() for k in range(3)]):
            raw = pa.decompress(data[:-8], decompressed_size=int.from_bytes(data[-8:], "little"), codec="zstd",
                                asbytes=True)
            for x in items:
                at = x["place"] & ((1 << PLACE_BITS) - 1)
                out.append((x["g"], doc, x["place"], x["lo"], x["hi"], raw[at - x["hi"]: at - x["lo"] + WINDOW]))
        cols = list(zip(*out)) if out else [()] * 6
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int16(), pa.int16(), pa.binary())
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)],
                                         names=["g", "doc", "place", "lo", "hi", "span"])


def _packed(batches):
    """Texts as compressed bytes, so that a shuffle carries less."""
    for b in slices(batches, 64):
        raw = [x.encode("utf-8", "surrogatepass") for x in b.column(b.num_columns - 1).to_pylist()]
        data = [pa.compress(x, codec="zstd", asbytes=True) + len(x).to_bytes(8, "little") for x in raw]
        yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(data, pa.binary())],
                                         names=[*b.schema.names[:-1], "data"])


def _union(spans) -> list[tuple[int, int]]:
    out = []
    for s, e in sorted(spans):
        if out and s <= out[-1][1]:
            out[-1][1] = max(out[-1][1], e)
        else:
            out.append([s, e])
    return [tuple(x) for x in out]


def _cut(batches):
    """(id, h1, h2, len, n_bytes, removed spans, kept bytes) of each text."""
    for b in slices(batches, 64):
        data, spans = b.column(4).to_pylist(), b.column(5).to_pylist()
        out = []
        for x, gone in zip(data, spans):
            n = int.from_bytes(x[-8:], "little")
            raw = pa.decompress(x[:-8], decompressed_size=n, codec="zstd", asbytes=True) if n else b""
            gone, kept, at = _union((s["start"], s["end"]) for s in gone or ()), [], 0
            for s, e in gone:
                kept.append(raw[at:s])
                at = e
            kept.append(raw[at:])
            out.append((n, [{"start": s, "end": e} for s, e in gone], b"".join(kept)))
        cols = list(zip(*out)) if out else [()] * 3
        yield pa.RecordBatch.from_arrays(
            [*b.columns[:4], pa.array(cols[0], pa.int64()),
             pa.array(cols[1], pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
             pa.array(cols[2], pa.binary())], names=["k_id", "k_h1", "k_h2", "k_len", "n_bytes", "removed", "kept"])


def _tie(h1: str = "k_h1") -> F.Column:
    """Order of different texts under one id: the upper half of their hash."""
    return F.expr(f"shiftrightunsigned({h1}, 32)")


def hot_grams(rows: DataFrame, sample: int = SAMPLE, spans: int = HOT_SPANS) -> list[int]:
    """Grams with very many different spans in every ``sample``-th text."""
    some = rows.where(F.pmod("k_h2", F.lit(sample)) == 0).select("k_id", "tie", "text")
    seen = some.mapInArrow(_listed([], sample=True), ANCHOR).groupBy("g").agg(F.count_distinct("h").alias("n"))
    return [r["g"] for r in seen.where(F.col("n") >= spans).orderBy(F.desc("n"), "g").limit(HOT_GRAMS).collect()]


def removed_bytes(rows: DataFrame, hot: list[int] | None = None) -> DataFrame:
    """(doc, tie, start, end): bytes to remove, in pieces that may overlap.
    ``rows`` has k_id, k_h2, tie and text; doc is the id, or the least bigint
    for none."""
    hot = hot_grams(rows) if hot is None else hot
    # Settled inside the tasks, then met by gram (hot windows by their hash).
    listed = rows.select("k_id", "tie", "text").mapInArrow(_listed(hot), ANCHOR)
    own = F.when(F.col("kind") == GONE, F.xxhash64("doc", "place")).otherwise(F.col("g"))
    local = listed.repartition(own).sortWithinPartitions("kind", "g", "h", "doc", "place")
    met = stage(local.mapInArrow(_meet, ANCHOR), "met")
    wanted = (met.where(F.col("kind") == SPAN)
              .groupBy("doc", F.shiftright("place", PLACE_BITS).alias("tie"))
              .agg(F.collect_list(F.struct("g", "place", "lo", "hi")).alias("items")))
    texts = rows.select(F.coalesce("k_id", F.lit(NULL_ID)).alias("doc"), "tie", "text").where(
        F.octet_length("text") >= WINDOW).mapInArrow(_packed, "doc bigint, tie bigint, data binary")
    spans = (texts.join(wanted, ["doc", "tie"]).select("data", "doc", "items")
             .mapInArrow(_fetch, "g bigint, doc bigint, place bigint, lo smallint, hi smallint, span binary"))
    late = (spans.repartition("g").sortWithinPartitions("g", "doc", "place")
            .mapInArrow(_suffix_sorted, ANCHOR))
    gone = met.where(F.col("kind") == GONE).unionAll(stage(late, "late"))
    return gone.select("doc", F.shiftright("place", PLACE_BITS).alias("tie"),
                       F.col("place").bitwiseAND(F.lit((1 << PLACE_BITS) - 1)).alias("start"), F.col("g").alias("end"))


def dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", hot: list[int] | None = None) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_bytes, removed (sorted, disjoint
    spans of bytes) and kept (the bytes that stay).

    Texts come in the order of their ids, null ids first, different texts under
    one id by their hash; of rows alike in id and text one is the first and the
    others are later copies.  Null and empty texts have no bytes; texts shorter
    than the window lose nothing; an empty table gives an empty one; extra
    columns are ignored."""
    text = text_or_empty(text_col)
    rows = docs.select(F.col(id_col).cast("bigint").alias("k_id"), F.xxhash64(text).alias("k_h1"),
                       F.hash(text).alias("k_h2"), F.length(text).alias("k_len"), text.alias("text"))
    rows = rows.withColumn("tie", _tie())
    gone = (removed_bytes(rows, hot).groupBy("doc", "tie")
            .agg(F.collect_list(F.struct("start", "end")).alias("gone")))
    texts = rows.select("k_id", "k_h1", "k_h2", "k_len", F.coalesce("k_id", F.lit(NULL_ID)).alias("doc"), "tie", "text")
    texts = texts.mapInArrow(_packed, "k_id bigint, k_h1 bigint, k_h2 int, k_len int, doc bigint, tie bigint, data binary")
    cut = (texts.join(gone, ["doc", "tie"], "left").select("k_id", "k_h1", "k_h2", "k_len", "data", "gone")
           .mapInArrow(_cut, "k_id bigint, k_h1 bigint, k_h2 int, k_len int, n_bytes bigint, "
                             "removed array<struct<start:bigint,end:bigint>>, kept binary"))
    # Rows that repeat id and text: all but one are copies of an earlier row.
    again = stage(rows.groupBy("k_id", "k_h1", "k_h2", "k_len").count().where("count > 1"), "again")
    if not again.head(1):
        return cut.select(F.col("k_id").alias("doc_id"), "n_bytes", "removed", "kept")
    return _copies(cut, again)


def _copies(cut: DataFrame, again: DataFrame) -> DataFrame:
    key = ["k_id", "k_h1", "k_h2", "k_len"]
    cut = stage(cut, "cut")
    on = same_key(cut, again)
    once = cut.join(again, on, "left_anti")
    some = cut.join(again, on, "left_semi").groupBy(*key).agg(
        F.count("*").alias("n"), F.first("n_bytes").alias("n_bytes"), F.first("removed").alias("removed"),
        F.first("kept").alias("kept"))
    some = some.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("n").cast("int"))))
    late = (F.col("copy") > 1) & (F.col("n_bytes") >= WINDOW)
    whole = F.array(F.struct(F.lit(0).cast("bigint").alias("start"), F.col("n_bytes").alias("end")))
    some = some.select(F.col("k_id").alias("doc_id"), "n_bytes", F.when(late, whole).otherwise(F.col("removed"))
                       .alias("removed"), F.when(late, F.lit(b"")).otherwise(F.col("kept")).alias("kept"))
    return once.select(F.col("k_id").alias("doc_id"), "n_bytes", "removed", "kept").unionAll(some)


ORACLE = """with docs as (select doc_id, hex(encode(coalesce(text, ''))) as x from documents),
windows as (
  select doc_id, s, substr(x, 2 * s + 1, 200) as w
  from (select doc_id, x, unnest(range(0, length(x) // 2 - 99)) as s from docs where length(x) >= 200)),
late as (select doc_id, s from windows qualify row_number() over (partition by w order by doc_id, s) > 1),
runs as (
  select doc_id, min(s) as b, max(s) + 100 as e
  from (select *, sum(fresh) over (partition by doc_id order by s) as k
        from (select doc_id, s, case when s <= lag(s) over (partition by doc_id order by s) + 100 then 0 else 1 end as fresh
              from late))
  group by doc_id, k),
gaps as (
  select doc_id, b, e, coalesce(lag(e) over (partition by doc_id order by b), 0) as f from runs),
kept as (
  select d.doc_id, string_agg(substr(d.x, 2 * g.f + 1, 2 * (g.b - g.f)), '' order by g.b) as front,
         substr(any_value(d.x), 2 * max(g.e) + 1) as tail, count(*) as n_spans, sum(g.e - g.b)::bigint as n_removed
  from gaps g join docs d using (doc_id) group by d.doc_id)
select d.doc_id, (length(d.x) // 2)::bigint as n_bytes, coalesce(k.n_removed, 0) as n_removed,
       coalesce(k.n_spans, 0) as n_spans,
       sha256(unhex(case when k.doc_id is null then d.x else k.front || k.tail end)) as kept_sha256
from docs d left join kept k using (doc_id)"""


@query("op13_suffix_array_dedup", ORACLE)
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = dedup(table(spark, sf_dir, "documents"))
    size = F.aggregate("removed", F.lit(0).cast("bigint"), lambda n, s: n + s["end"] - s["start"])
    return found.select("doc_id", "n_bytes", size.alias("n_removed"), F.size("removed").cast("bigint").alias("n_spans"),
                        F.sha2("kept", 256).alias("kept_sha256"))
