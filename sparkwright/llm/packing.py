"""Harmonic packing of token sequences.

A document's token ids are cut into pieces, and a piece of length L belongs to
the reciprocal-capacity class j with capacity/(j+1) < L <= capacity/j.  A
sequence of class j takes exactly j pieces, so each worker fills its own
sequences without knowing any other's.  Since documents may be cut freely, a
remainder that would waste more than 1/64 of its slot is cut into a head that
fills a slot exactly and a tail that fits its own.

What a worker cannot complete (fewer than j pieces of a class, so at most one
sequence a class) is laid end to end over groups of workers and cut at the
capacity; a group's last tokens go to sequences of power-of-two length, which
need no padding."""

from __future__ import annotations

import json
import re
import zlib
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkwright.llm.shared import query, slices, stage, table

CAPACITY = 2048
#: Workers whose unfinished sequences are completed together.
WORKERS_AT_ONCE = 16
PIECE = "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, offset bigint"


#: Runs of blanks from this length on are cut off before the split pattern sees
#: them: its lookahead goes back over a whole run.
LONG_BLANKS = 4096
#: White space as the split pattern means it (the Unicode property).
BLANKS = re.compile("[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]{%d,}" % LONG_BLANKS)
#: The pieces of a byte-level pre-tokenizer.
PIECES = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def _fast_form(spec: dict) -> bool:
    """Whether tiktoken gives a tokenizer's ids: plain byte-level BPE without
    normalizer, whose special tokens are taken as they stand, and whose ids
    are in merge order."""
    pre, model, added = spec.get("pre_tokenizer") or {}, spec.get("model") or {}, spec.get("added_tokens") or []
    plain = (spec.get("normalizer") is None and pre.get("type") == "ByteLevel" and pre.get("use_regex", True)
             and not pre.get("add_prefix_space", True) and model.get("type") == "BPE")
    flags = ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback",
             "ignore_merges")
    plain = plain and not any(model.get(f) for f in flags) and all(
        t.get("special") and not (t.get("lstrip") or t.get("rstrip") or t.get("single_word")) for t in added)
    if not plain:
        return False
    vocab = model["vocab"]
    pairs = [m.split(" ", 1) if isinstance(m, str) else m for m in model["merges"]]
    ids = [vocab.get(x + y, -1) for x, y in pairs]
    return all(i < j for i, j in zip(ids, ids[1:]))


class _Encoder:
    """Token ids as the tokenizers library gives them.  A file that is plain
    byte-level BPE runs on tiktoken (same ids, several times as fast); any
    other runs on the tokenizers library itself."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        if not _fast_form(spec):
            from tokenizers import Tokenizer

            slow = Tokenizer.from_file(path)
            self.ids = lambda text: np.array(slow.encode(text, add_special_tokens=False).ids, "<u4")
            return
        import tiktoken

        special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        # Byte-level alphabet: printable bytes stand for themselves, the others for 256, 257, ...
        plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
        byte_of = {chr(b): b for b in plain}
        byte_of |= {chr(256 + k): b for k, b in enumerate(x for x in range(256) if x not in set(plain))}
        ranks = {bytes(byte_of[c] for c in w): i for w, i in spec["model"]["vocab"].items() if w not in special}
        self.special = tuple(special)
        self.fast = tiktoken.Encoding("from-json", pat_str=PIECES, mergeable_ranks=ranks, special_tokens=special)
        self.ids = self._cut

    def _cut(self, text: str) -> np.ndarray:
        """Long runs of blanks are pieces of their own: a run up to its last
        character, which belongs to the piece behind it, or all of it where no
        piece follows."""
        run = BLANKS.search(text)
        if not run:
            return self._plain(text)
        out, at = [], 0
        while run:
            end = run.end()
            if end < len(text) and not text.startswith(self.special, end):
                end -= 1
            out.append(self._plain(text[at:run.start()]))
            out.append(np.array(self.fast._encode_single_piece(text[run.start():end].encode()), "<u4"))
            at = end
            # The character left over is no run.
            run = BLANKS.search(text, max(at, run.end()))
        out.append(self._plain(text[at:]))
        return np.concatenate(out)

    def _plain(self, text: str) -> np.ndarray:
        return self.fast.encode_to_numpy(text, allowed_special="all").astype("<u4", copy=False)


@lru_cache(maxsize=2)
def _encoder(path: str) -> _Encoder:
    return _Encoder(path)


def token_ids(text: str, path: str) -> np.ndarray:
    """Ids of ``text`` (uint32) without added tokens; a special token's string
    inside the text is that token."""
    return _encoder(path).ids(text)


#: A piece shorter than this is cut off only where nothing else fits.
SHORT = 16


@lru_cache(maxsize=None)
def _rest_cuts(rest: int, capacity: int) -> tuple[tuple[int, int], ...]:
    """Pieces of a remainder: whole if it fills its slot up to 1/64, else the
    largest exact head whose tail does so, else the next class's head."""
    j = capacity // rest
    if capacity // j - rest <= max(1, capacity // j >> 6):
        return ((j, rest),)
    for k in range(j + 1, capacity + 1):
        tail = rest - capacity // k
        if tail >= SHORT and len(_rest_cuts(tail, capacity)) == 1:
            return ((k, capacity // k), *_rest_cuts(tail, capacity))
    return ((j + 1, capacity // (j + 1)), *_rest_cuts(rest - capacity // (j + 1), capacity))


def cuts(n: int, capacity: int = CAPACITY) -> list[tuple[int, int]]:
    """(class, length) of the pieces of a document of ``n`` tokens, in order."""
    rest = n % capacity
    return [(1, capacity)] * (n // capacity) + (list(_rest_cuts(rest, capacity)) if rest else [])


def _pack(path: str, eos: int, capacity: int):
    """Fill sequences inside one task; unfinished pieces leave with their ids."""
    def run(batches):
        worker = TaskContext.get().partitionId()
        number, bins, end = 0, {}, np.array([eos], "<u4")
        for b in slices(batches):
            done = [[] for _ in range(7)]
            for doc, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                ids = np.concatenate([token_ids(text or "", path), end])
                at = 0
                for j, size in cuts(len(ids), capacity):
                    part = ids[at: at + size].tobytes()
                    held = bins.setdefault(j, [])
                    held.append((doc, at, size, zlib.crc32(part), len(ids), part if j > 1 else b""))
                    at += size
                    if len(held) == j:
                        offset = 0
                        for piece in held:
                            for col, x in zip(done, (*piece[:5], (worker << 32) | number, offset)):
                                col.append(x)
                            offset += piece[2]
                        number += 1
                        held.clear()
            yield _batch(done, [None] * len(done[0]), worker)
        left = [(*p[:5], None, None, p[5]) for j in sorted(bins) for p in bins[j]]
        # Class 1 holds whole sequences and never waits, but for a lone piece.
        cols = [list(c) for c in zip(*left)] if left else [[] for _ in range(8)]
        yield _batch(cols[:7], cols[7], worker)
    return run


def _batch(cols, ids, worker):
    n = len(cols[0])
    arrays = [pa.array(c, pa.int64()) for c in cols]
    arrays += [pa.array(ids, pa.binary()), pa.array(np.full(n, worker), pa.int64())]
    return pa.RecordBatch.from_arrays(arrays, names=["doc_id", "start", "length", "ids_crc32", "doc_tokens",
                                                     "sequence_id", "offset", "ids", "worker"])


def _complete(capacity: int):
    """Lay the unfinished pieces of some workers end to end."""
    def run(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["worker", "length", "doc_id", "start", "ids_crc32"], kind="stable")
        total = int(pdf["length"].sum())
        # Lengths of the sequences: full ones, then the powers of two of the rest.
        rest = total % capacity
        sizes = [capacity] * (total // capacity) + [1 << k for k in reversed(range(capacity.bit_length()))
                                                    if rest >> k & 1]
        out, s, used = [], 0, 0
        base = (1 << 62) | (int(key[0]) << 32)
        for doc, start, tokens, ids in zip(pdf["doc_id"], pdf["start"], pdf["doc_tokens"], pdf["ids"]):
            at, size = 0, len(ids) // 4
            while at < size:
                take = min(size - at, sizes[s] - used)
                part = ids[4 * at: 4 * (at + take)]
                out.append((doc, start + at, take, zlib.crc32(part), tokens, base + s, used))
                at, used = at + take, used + take
                if used == sizes[s]:
                    s, used = s + 1, 0
        cols = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
        done = pd.DataFrame(out, columns=cols)
        return done.astype({c: "int64" for c in cols[1:]} | {"doc_id": "Int64"})
    return run


def pack(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", eos: int = 1,
         capacity: int = CAPACITY) -> DataFrame:
    """Pack the token ids of all documents, each ended by ``eos``, into
    sequences of at most ``capacity`` tokens.

    One row per piece: doc_id, start (tokens of the document before it),
    length, ids_crc32 (of its ids as little-endian unsigned 32-bit numbers),
    doc_tokens, sequence_id and offset (in the sequence, without gaps).  Every
    token lies in one piece.  Null and empty texts give the single token
    ``eos``; repeated rows and null ids are packed like any others; an empty
    table gives an empty one; extra columns are ignored."""
    if capacity & (capacity - 1):
        raise ValueError("the capacity must be a power of two")
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))
    packed = stage(rows.mapInArrow(_pack(tokenizer, eos, capacity), PIECE + ", ids binary, worker bigint"), "packed")
    late = (packed.where("sequence_id is null")
            .groupBy(F.floor(F.col("worker") / WORKERS_AT_ONCE).alias("workers"))
            .applyInPandas(_complete(capacity), PIECE))
    return packed.where("sequence_id is not null").drop("ids", "worker").unionByName(late)


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


@query("op5_harmonic_packing")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"), tokenizer_path())
