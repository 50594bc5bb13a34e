"""Embedding near-dedup by random-hyperplane sign hashing.

Equal vectors are one node first.  Every table gives a node the signs of its
own random hyperplanes as bucket; nodes that share a bucket in some table are
compared by exact cosine in double precision.  A pair that meets in several
tables counts in the first of them only, told by the nodes' buckets in the
earlier tables, so link counts need no pair table: a task returns counts a node
and a spanning forest of its links.  Buckets held by more than ``block`` nodes
are cut into a grid of blocks.

Two vectors at angle a agree on a plane's side with probability 1 - a/pi, so
the number of tables follows from the bits a table, the cosine and the wanted
recall; more bits (for more vectors) bring more tables and the same recall."""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkwright.llm.components import components, forest
from sparkwright.llm.shared import query, stage, table

COSINE = 0.9
#: Share of the pairs at exactly the least cosine that some table must hold together.
RECALL = 0.98
BLOCK = 2048
SEED = 20240


def tables_for(bits: int, cosine: float = COSINE, recall: float = RECALL) -> int:
    """Tables that pairs at ``cosine`` need to meet with probability ``recall``."""
    together = (1 - math.acos(cosine) / math.pi) ** bits
    return max(1, math.ceil(math.log(1 - recall) / math.log(1 - together)))


def _vectors(batches):
    """(vec_id, digest, vec): the vector as float64 bytes; null for vectors
    that link with nothing (null, zero, null or non-finite components) and for
    null ids."""
    for b in batches:
        ids, out, digests = b.column(0).to_pylist(), [], []
        col = b.column(1)
        for i, vec_id in enumerate(ids):
            raw = col[i].values if col[i].is_valid and vec_id is not None else None
            x = None
            if raw is not None and len(raw) and not raw.null_count:
                x = raw.to_numpy(zero_copy_only=False).astype(np.float64) + 0.0  # one zero
                if not np.isfinite(x).all() or not x.any():
                    x = None
            out.append(None if x is None else x.tobytes())
            digests.append(None if x is None else hashlib.blake2b(out[-1], digest_size=16).digest())
        yield pa.RecordBatch.from_arrays([b.column(0), pa.array(digests, pa.binary()), pa.array(out, pa.binary())],
                                         names=["vec_id", "digest", "vec"])


def _planes(dim: int, tables: int, bits: int) -> np.ndarray:
    return np.random.default_rng(SEED + dim).standard_normal((dim, tables * bits))


def _unit(x: np.ndarray) -> np.ndarray:
    """Rows of length one, scaled first so that no square over- or underflows."""
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _buckets(tables: int, bits: int):
    """Rows (bucket, node, copies, signs, vec) of each node in each table; the
    bucket names the table and the vector's dimension, too."""
    weights = (1 << np.arange(bits)).astype(np.int64)

    def run(batches):
        for b in batches:
            dims = np.array([len(v.as_buffer()) // 8 for v in b.column("vec")])
            for dim in np.unique(dims):
                part = b.take(pa.array(np.flatnonzero(dims == dim)))
                for at in range(0, part.num_rows, 256):
                    rows = part.slice(at, 256)
                    x = np.frombuffer(b"".join(rows.column("vec").to_pylist()), np.float64).reshape(-1, dim)
                    side = (_unit(x) @ _planes(int(dim), tables, bits) > 0).reshape(len(x), tables, bits)
                    signs = (side @ weights).astype("<i4")
                    key = ((np.int64(dim) << 40) + (np.arange(tables, dtype=np.int64) << 32) + signs).T.ravel()
                    again = pa.array(np.tile(np.arange(len(x)), tables))
                    packed = pa.array([s.tobytes() for s in signs], pa.binary())
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(key), *(rows.column(c).take(again) for c in ("node", "copies")),
                         packed.take(again), rows.column("vec").take(again)],
                        names=["bucket", "node", "copies", "signs", "vec"])
    return run


def _compare(cosine: float):
    """Rows (u, v, links) from rows sorted by bucket and block: u != v is a link
    of the forest, u = v the number of vectors linked with u."""
    def pairs(rows, bucket: int, cell: int):
        x = _unit(np.frombuffer(b"".join(rows.column("vec").to_pylist()), np.float64).reshape(rows.num_rows, -1))
        own = rows.column("own").to_numpy()
        signs = np.frombuffer(b"".join(rows.column("signs").to_pylist()), "<i4").reshape(len(x), -1)
        t = (bucket >> 32) & 0xFF
        for lo in range(0, len(x), 512):
            a, c = np.nonzero(x[lo: lo + 512] @ x.T >= cosine)
            a += lo
            # Each pair once; in a cell of two blocks only pairs across them.
            ok = (a < c) if cell < 0 else (own[a] < own[c])
            a, c = a[ok], c[ok]
            if t and len(a):
                new = ~(signs[a, :t] == signs[c, :t]).any(axis=1)
                a, c = a[new], c[new]
            if len(a):
                yield a, c

    def run(batches):
        rest = None
        for b in batches:
            both = b if rest is None else pa.concat_batches([rest, b])
            if not both.num_rows:
                continue
            key, cell = both.column("bucket").to_numpy(), both.column("cell").to_numpy()
            first = np.flatnonzero(np.r_[True, (key[1:] != key[:-1]) | (cell[1:] != cell[:-1])])
            rest = both.slice(int(first[-1]))
            yield from found(both, first[:-1], first[1:], key, cell)
        if rest is not None and rest.num_rows:
            yield from found(rest, np.array([0]), np.array([rest.num_rows]), rest.column("bucket").to_numpy(),
                             rest.column("cell").to_numpy())

    def found(rows, starts, ends, key, cell):
        node, copies = rows.column("node").to_numpy(), rows.column("copies").to_numpy()
        us, vs, links = [], [], np.zeros(rows.num_rows, np.int64)
        for s, e in zip(starts.tolist(), ends.tolist()):
            if e - s > 1:
                for a, c in pairs(rows.slice(s, e - s), int(key[s]), int(cell[s])):
                    a, c = a + s, c + s
                    np.add.at(links, a, copies[c])
                    np.add.at(links, c, copies[a])
                    # Contract the links at once; a group never keeps its pairs.
                    u, v = forest(node[a], node[c])
                    us.append(u)
                    vs.append(v)
        has = np.flatnonzero(links)
        if len(has):
            u, v = forest(np.concatenate(us), np.concatenate(vs))
            nodes, idx = np.unique(node[has], return_inverse=True)
            total = np.zeros(len(nodes), np.int64)
            np.add.at(total, idx, links[has])
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate([u, nodes])), pa.array(np.concatenate([v, nodes])),
                 pa.array(np.concatenate([np.zeros(len(u), np.int64), total]))], names=["u", "v", "links"])
    return run


def near_links(nodes: DataFrame, cosine: float = COSINE, recall: float = RECALL, bits: int | None = None,
               block: int = BLOCK) -> DataFrame:
    """(u, v, links) as in ``_compare``, for distinct vectors (node, copies, vec).
    ``bits`` defaults to the logarithm of their number less 5."""
    if bits is None:
        bits = min(24, max(8, math.ceil(math.log2(max(2, nodes.count()))) - 5))
    tables = tables_for(bits, cosine, recall)
    rows = nodes.mapInArrow(_buckets(tables, bits), "bucket bigint, node bigint, copies bigint, signs binary, vec binary")
    heavy = stage(rows.groupBy("bucket").count().where(F.col("count") > block).select(
        F.col("bucket"), F.ceil(F.col("count") / block).cast("bigint").alias("parts")), "heavy-buckets")
    zero = F.lit(0).cast("bigint")
    if heavy.head(1):
        # A node's block meets every block of the bucket in one cell of the grid;
        # cells of one block have negative numbers.
        own = F.pmod(F.xxhash64("node"), F.col("parts"))
        rows = (rows.join(heavy, "bucket", "left").withColumn("parts", F.coalesce("parts", F.lit(1).cast("bigint")))
                .withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
                .withColumn("cell", F.when(F.col("own") == F.col("other"), -1 - F.col("own")).otherwise(
                    F.least("own", "other") * F.col("parts") + F.greatest("own", "other"))))
    else:
        rows = rows.withColumn("own", zero).withColumn("cell", zero - 1)
    rows = rows.select("bucket", "cell", "own", "node", "copies", "signs", "vec")
    return (rows.repartition("bucket", "cell").sortWithinPartitions("bucket", "cell")
            .mapInArrow(_compare(cosine), "u bigint, v bigint, links bigint"))


def near_duplicates(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", cosine: float = COSINE,
                    recall: float = RECALL, bits: int | None = None, block: int = BLOCK) -> DataFrame:
    """One row per row of ``vectors``: vec_id, n_links (other rows linked
    directly by a found cosine of at least ``cosine``), component_id (smallest
    id reached) and kept (whether that is its own).

    Null, empty and zero vectors, those with null or non-finite components and
    rows without an id link with nothing; vectors of different lengths don't
    link.  Equal vectors always link.  Rows that share an id are one node.  An
    empty table gives an empty one; extra columns are ignored."""
    rows = (vectors.select(F.col(id_col).cast("bigint").alias("vec_id"), F.col(vec_col).alias("vec"))
            .mapInArrow(_vectors, "vec_id bigint, digest binary, vec binary"))
    nodes = stage(rows.where("digest is not null").groupBy("digest").agg(
        F.min("vec_id").alias("node"), F.count("*").alias("copies"), F.first("vec").alias("vec")), "vectors")
    met = stage(near_links(nodes.select("node", "copies", "vec"), cosine, recall, bits, block), "vector-links")
    links = met.where("u = v").groupBy("u").agg(F.sum("links").alias("links"))
    groups = components(met.where("u != v"))
    info = (nodes.select("digest", "node", "copies").join(links, F.col("node") == F.col("u"), "left").drop("u")
            .join(groups, "node", "left")
            .select("digest", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
                    F.coalesce("root", "node").alias("component_id")))
    of = F.coalesce("component_id", "vec_id")
    return (rows.select("vec_id", "digest").join(info, "digest", "left")
            .select("vec_id", F.coalesce("n_links", F.lit(0).cast("bigint")).alias("n_links"),
                    of.alias("component_id"), (F.col("vec_id") == of).alias("kept")))


@query("op6_embedding_near_dedup")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "embeddings"))
