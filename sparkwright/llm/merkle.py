"""Merkle manifest of a dataset, with proofs by octopus multiproofs.

A row is a leaf.  The leaves of a source, in the order of their ids, form a
tree of fan-out ``FANOUT``; the sources' subroots, in the order of the sources,
form the tree above them.

Rows are range-partitioned by (source, id) and cut into leaf parts of at most
``LEAVES_A_PART`` neighbouring leaves, so a hot source is many parts.  The tree
is built level by level with grouped aggregates.  For the proofs a part first
works out the minimal set of node coordinates that it can neither hold nor
derive: on every level only the brothers left and right of its own interval,
however many leaves it has.  All parts' coordinates are fetched in one join;
each part then derives its shared interior nodes and expands the proof of each
of its leaves by itself."""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sparkwright.llm.shared import query, stage, table

FANOUT = 16
LEAVES_A_PART = 4096
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Group number of the tree over the subroots.
TOP = -1
PROOF = ("doc_id bigint, leaf string, subroot string, root string, proof string, folded_root string, "
         "verified boolean")


def _field(c: Column) -> Column:
    """``-`` for a null, else byte count, colon and value."""
    s = c.cast("string")
    return F.when(s.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(s).cast("string"), F.lit(":"), s))


def leaf_hash(*columns: Column) -> Column:
    """Hex sha256 of the fields of a row; decimal integers, null as ``-``."""
    return F.sha2(F.concat(*[_field(c) for c in columns]), 256)


def lower_cased(c: Column) -> Column:
    """A-Z in lower case, all else as it is."""
    return F.translate(c, UPPER, LOWER)


def leaves(docs: DataFrame, id_col: str = "doc_id", group_col: str = "source",
           columns: tuple[str, ...] = ("doc_id", "source", "lang", "n_chars", "text"), text_col: str = "text",
           tamper: Column | None = None) -> DataFrame:
    """(source, doc_id, leaf, tampered): a leaf hash per row and, where
    ``tamper`` holds, the hash of the row with its text lower-cased."""
    own = [F.col(c) for c in columns]
    other = [lower_cased(F.col(c)) if c == text_col else F.col(c) for c in columns]
    changed = F.lit(None).cast("string") if tamper is None else F.when(tamper, leaf_hash(*other))
    return docs.select(F.col(group_col).cast("string").alias("source"), F.col(id_col).cast("bigint").alias("doc_id"),
                       leaf_hash(*own).alias("leaf"), changed.alias("tampered"))


def _number(size: int):
    """Cut the sorted rows of a task into parts of ``size`` and those into runs
    of one source; number the rows of a run."""
    def run(batches):
        base, at, last, run_no, seq = TaskContext.get().partitionId() << 32, 0, None, -1, 0
        for b in batches:
            source = b.column(0)
            text = source.fill_null("").to_numpy(zero_copy_only=False)
            null = source.is_null().to_numpy(zero_copy_only=False)
            n = b.num_rows
            part, runs, seqs = np.empty(n, np.int64), np.empty(n, np.int64), np.empty(n, np.int64)
            for i in range(n):
                here = None if null[i] else text[i]
                if at % size == 0:
                    run_no, seq = 0, 0
                elif here != last:
                    run_no, seq = run_no + 1, 0
                part[i], runs[i], seqs[i] = base | (at // size), run_no, seq
                last, at, seq = here, at + 1, seq + 1
            yield pa.RecordBatch.from_arrays(
                [pa.array(part), pa.array(runs), pa.array(seqs), *[b.column(k) for k in range(4)]],
                names=["part", "run", "seq", "source", "doc_id", "leaf", "tampered"])
    return run


def placed_leaves(found: DataFrame, part_size: int = LEAVES_A_PART) -> DataFrame:
    """Every leaf with its place: part, g (rank of its source), idx (place in
    the source), n (leaves of the source), a and b (its part's interval).

    Order: source (null first, bytewise), id (null first), leaf hash; rows
    alike in all three are interchangeable."""
    kept = stage(found.withColumn("row", F.monotonically_increasing_id()), "leaves")
    order = ["source", "doc_id", "leaf", "row"]
    schema = "part bigint, run bigint, seq bigint, source string, doc_id bigint, leaf string, tampered string"
    ordered = stage(kept.repartitionByRange(*order).sortWithinPartitions(*order)
                    .select("source", "doc_id", "leaf", "tampered").mapInArrow(_number(part_size), schema), "ordered")
    runs = ordered.groupBy("part", "run").agg(F.first("source").alias("source"), F.count("*").alias("size"))
    # A source has at most one run a part; parts are in the order of the rows.
    same = Window.partitionBy("source")
    earlier = same.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    runs = stage(runs.select("part", "run", "size", F.coalesce(F.sum("size").over(earlier), F.lit(0)).alias("a"),
                             F.sum("size").over(same).alias("n")), "runs")
    # Rank of a source: first runs before it, by whole parts and inside its part.
    parts = runs.groupBy("part").agg(F.count_if(F.col("a") == 0).alias("fresh"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("part", F.coalesce(F.sum("fresh").over(before), F.lit(0)).alias("fresh"))
    inside = Window.partitionBy("part").orderBy("run")
    spots = (runs.join(parts, "part").select(
        "part", "run", "a", (F.col("a") + F.col("size")).alias("b"), "n",
        (F.col("fresh") + F.sum((F.col("a") == 0).cast("bigint")).over(inside) - 1).alias("g")))
    return stage(ordered.join(spots, ["part", "run"]).select(
        "part", "g", (F.col("a") + F.col("seq")).alias("idx"), "n", "a", "b", "doc_id", "leaf", "tampered"), "placed")


def climb(nodes: DataFrame, largest: int) -> tuple[DataFrame, DataFrame]:
    """Interior nodes (g, level, idx, h) and tops (g, h) of the trees over
    ``nodes`` (g, idx, n, h); ``largest`` is the largest n."""
    level, here, tops, inner = 0, nodes, [], []
    while True:
        tops.append(here.where("n = 1").select("g", "h"))
        if largest <= 1:
            break
        level, largest = level + 1, -(-largest // FANOUT)
        kids = F.array_sort(F.collect_list(F.struct("idx", "h")))
        here = stage(here.where("n > 1").groupBy("g", F.ceil(F.col("n") / FANOUT).alias("up"),
                                                 F.floor(F.col("idx") / FANOUT).alias("place"))
                     .agg(F.sha2(F.array_join(F.transform(kids, lambda k: k["h"]), ""), 256).alias("h"))
                     .select("g", F.col("place").alias("idx"), F.col("up").alias("n"), "h"), f"level-{level}")
        inner.append(here.select("g", F.lit(level).alias("level"), "idx", "h"))
    union = tops[0]
    for t in tops[1:]:
        union = union.unionAll(t)
    rest = nodes.select("g", F.lit(0).alias("level"), "idx", "h").where("false")
    for x in inner:
        rest = rest.unionAll(x)
    return rest, union


def _missing(runs: DataFrame, depth: int) -> DataFrame:
    """(part, g, level, idx): the nodes beside the interval [a, b) of a part
    that complete its runs of brothers, on every level below the top."""
    at = runs.withColumn("level", F.explode(F.sequence(F.lit(0), F.lit(depth))))
    shift = lambda c: F.expr(f"shiftright({c}, 4 * level)")  # noqa: E731  16 nodes a step
    at = (at.select("part", "g", "level", shift("a").alias("lo"), shift("b - 1").alias("hi"),
                    (shift("n - 1") + 1).alias("n")).where("n > 1"))
    first = F.expr("shiftleft(shiftright(lo, 4), 4)")
    last = F.least(F.expr("shiftleft(shiftright(hi, 4), 4) + 15"), F.col("n") - 1)
    none = F.array().cast("array<bigint>")
    left = F.when(first < F.col("lo"), F.sequence(first, F.col("lo") - 1)).otherwise(none)
    right = F.when(last > F.col("hi"), F.sequence(F.col("hi") + 1, last)).otherwise(none)
    return at.select("part", "g", "level", F.explode(F.concat(left, right)).alias("idx"))


def _digest(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


class _Tree:
    """What one part knows of one tree: the nodes of each level by place."""

    def __init__(self, n: int, known: dict[int, dict[int, str]]):
        self.sizes = [n]
        while self.sizes[-1] > 1:
            self.sizes.append(-(-self.sizes[-1] // FANOUT))
        self.known = [known.get(k, {}) for k in range(len(self.sizes))]

    def brothers(self, level: int, place: int) -> list[str]:
        """The run of nodes under one parent."""
        here, first = self.known[level], place * FANOUT
        return [here[i] for i in range(first, min(first + FANOUT, self.sizes[level]))]

    def derive(self) -> None:
        """Interior nodes from the leaves held and the nodes fetched."""
        for level in range(len(self.sizes) - 1):
            for place in {i // FANOUT for i in self.known[level]}:
                self.known[level + 1][place] = _digest("".join(self.brothers(level, place)))

    @property
    def top(self) -> str:
        return self.known[-1][0]

    def siblings(self, level: int, i: int) -> str:
        run = self.brothers(level, i // FANOUT)
        del run[i % FANOUT]
        return "".join(run)

    def path(self, i: int, from_level: int = 0) -> str:
        """Siblings from a node of ``from_level`` up to the top."""
        out = []
        for level in range(from_level, len(self.sizes) - 1):
            out.append(self.siblings(level, i))
            i //= FANOUT
        return "".join(out)

    def fold(self, i: int, node: str) -> str:
        """The top recomputed with ``node`` in place i of the lowest level."""
        for level in range(len(self.sizes) - 1):
            run = self.brothers(level, i // FANOUT)
            run[i % FANOUT] = node
            node, i = _digest("".join(run)), i // FANOUT
        return node


def _expand(sources: int, root: str):
    """Proofs of a part's leaves from its leaves and the nodes fetched for it."""
    def run(mine: pa.Table, fetched: pa.Table) -> pa.Table:
        known: dict[int, dict[int, dict[int, str]]] = {}
        for g, level, idx, h in zip(*[fetched[c].to_pylist() for c in ("g", "level", "idx", "h")]):
            known.setdefault(g, {}).setdefault(level, {})[idx] = h
        g, idx, n, doc, leaf, tampered = [mine[c].to_pylist()
                                          for c in ("g", "idx", "n", "doc_id", "leaf", "tampered")]
        sizes = dict(zip(g, n))
        for group, i, h in zip(g, idx, leaf):
            known.setdefault(group, {}).setdefault(0, {})[i] = h
        trees = {}
        for group, size in sizes.items():
            trees[group] = _Tree(size, known[group])
            trees[group].derive()
            known.setdefault(TOP, {}).setdefault(0, {})[group] = trees[group].top
        above = _Tree(sources, known[TOP])
        above.derive()
        over = {group: above.path(group) for group in sizes}
        # Leaves under one parent share the rest of their path.
        shared: dict[tuple[int, int], str] = {}
        proofs, folded = [], []
        for group, i, change in zip(g, idx, tampered):
            tree, key = trees[group], (group, i // FANOUT)
            if key not in shared:
                shared[key] = (tree.path(key[1], 1) if len(tree.sizes) > 1 else "") + over[group]
            proofs.append((tree.siblings(0, i) if len(tree.sizes) > 1 else "") + shared[key])
            folded.append(above.top if change is None else above.fold(group, tree.fold(i, change)))
        return pa.table({
            "doc_id": pa.array(doc, pa.int64()), "leaf": pa.array(leaf, pa.string()),
            "subroot": pa.array([trees[x].top for x in g], pa.string()),
            "root": pa.array([root] * len(g), pa.string()), "proof": pa.array(proofs, pa.string()),
            "folded_root": pa.array(folded, pa.string()),
            "verified": pa.array([f == root for f in folded], pa.bool_())})
    return run


def manifest(placed: DataFrame) -> tuple[DataFrame, DataFrame, int, str | None]:
    """Of placed leaves: the interior nodes (g, level, idx, h; g = -1 above the
    subroots, with the subroots as its level 0), the runs' places, the number
    of sources and the root (None for no leaves)."""
    runs = stage(placed.groupBy("part", "g", "a", "b", "n").agg(F.count("*").alias("size")).drop("size"), "places")
    size = runs.agg(F.max("n").alias("n"), F.max("g").alias("g")).first()
    if size["n"] is None:
        return placed.sparkSession.createDataFrame([], "g bigint, level int, idx bigint, h string"), runs, 0, None
    sources = size["g"] + 1
    inner, tops = climb(placed.select("g", "idx", "n", F.col("leaf").alias("h")), size["n"])
    subroots = stage(tops, "subroots")
    base = subroots.select(F.lit(TOP).cast("bigint").alias("g"), F.col("g").alias("idx"),
                           F.lit(sources).cast("bigint").alias("n"), "h")
    above, root = climb(base, sources)
    nodes = inner.unionAll(base.select("g", F.lit(0).alias("level"), "idx", "h")).unionAll(above)
    return nodes, runs, sources, root.first()["h"]


def multiproofs(found: DataFrame, part_size: int = LEAVES_A_PART) -> DataFrame:
    """A row per leaf of ``found`` (the columns of ``leaves``): doc_id, leaf,
    subroot, root, proof (the siblings from the leaf up to the root, as hex
    digests, left to right and level by level), folded_root (the root
    recomputed with the tampered leaf, where there is one) and verified.

    Null sources are a source of their own, before all others; null ids come
    first in theirs; repeated rows are leaves of their own; an empty table
    gives an empty one."""
    placed = placed_leaves(found, part_size)
    nodes, runs, sources, root = manifest(placed)
    if root is None:
        return placed.sparkSession.createDataFrame([], PROOF)
    largest = runs.agg(F.max("n")).first()[0]
    depth = _levels(max(largest, sources))
    top = runs.groupBy("part").agg(F.min("g").alias("a"), (F.max("g") + 1).alias("b")).select(
        "part", F.lit(TOP).cast("bigint").alias("g"), "a", "b", F.lit(sources).cast("bigint").alias("n"))
    wanted = _missing(runs.select("part", "g", "a", "b", "n").unionAll(top), depth)
    # Only the outer runs of brothers of a part can be wanted by another.
    edge = placed.where("shiftright(idx, 4) = shiftright(a, 4) or shiftright(idx, 4) = shiftright(b - 1, 4)")
    have = edge.select("g", F.lit(0).alias("level"), "idx", F.col("leaf").alias("h")).unionAll(nodes)
    fetched = wanted.join(have, ["g", "level", "idx"]).select("part", "g", "level", "idx", "h")
    mine = placed.select("part", "g", "idx", "n", "doc_id", "leaf", "tampered")
    out = mine.groupBy("part").cogroup(fetched.groupBy("part"))
    return out.applyInArrow(_expand(sources, root), PROOF)


def _levels(n: int) -> int:
    depth = 0
    while n > 1:
        n, depth = -(-n // FANOUT), depth + 1
    return depth


def _sql(levels: int = 8) -> str:
    """DuckDB twin, for trees of up to 16^levels nodes."""
    def field(c, value=None):
        v = value or c
        return f"case when {c} is null then '-' else strlen({v}::varchar)::varchar || ':' || {v}::varchar end"

    def row(text="text"):
        return " || ".join([field("doc_id"), field("source"), field("lang"), field("n_chars"), field("text", text)])

    upper = f"translate(text, '{UPPER}', '{LOWER}')"
    # crc32 bit by bit over the decimal digits.
    bits = "list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda c, z: xor(c >> 1, 3988292384 * (c & 1)))"
    crc = ("xor(list_reduce(list_prepend(4294967295::bigint, list_transform(string_split(doc_id::varchar, ''), "
           f"lambda d: ord(d)::bigint)), lambda c, b: {bits}), 4294967295)")

    def tree(name, base, last):
        """Level tables name_0..: g, i, n, h, and the parent's run as ``kids``."""
        out = [f"{name}_0 as ({base})"]
        for k in range(1, levels + 1):
            out.append(
                f"{name}_{k} as (select g, i // 16 as i, (any_value(n) + 15) // 16 as n, "
                f"sha256(string_agg(h, '' order by i)) as h from {name}_{k - 1} where n > 1 group by g, i // 16)")
        tops = " union all ".join(f"select g, h from {name}_{k} where n = 1" for k in range(levels + 1))
        out.append(f"{last} as ({tops})")
        return out

    parts = [f"""leaves as (
  select doc_id, source, sha256({row()}) as leaf,
         case when {crc} % 5 = 0 then sha256({row(upper)}) end as tampered,
         dense_rank() over (order by source nulls first) - 1 as g,
         row_number() over (partition by source order by doc_id nulls first) - 1 as i,
         count(*) over (partition by source) as n
  from documents)"""]
    parts += tree("l", "select g, i, n, leaf as h from leaves", "subroots")
    parts += tree("t", "select 0 as g, g as i, count(*) over () as n, h from subroots", "root")
    # Walk every leaf up: the node in hand, its place, the proof so far.
    parts.append("w_0 as (select doc_id, leaf, tampered, g, i, n, coalesce(tampered, leaf) as cur, '' as proof from leaves)")
    last = "w_0"
    for name in ("l", "t"):
        if name == "t":
            parts.append(f"v_0 as (select doc_id, leaf, tampered, g as s, 0 as g, g as i, "
                         f"(select count(*) from subroots) as n, cur, proof from {last})")
            last = "v_0"
        for k in range(levels):
            extra = "s, " if name == "t" else ""
            cols = f"{extra}doc_id, leaf, tampered"
            nxt = f"{'w' if name == 'l' else 'v'}_{k + 1}"
            wcols = ", ".join("w." + c for c in cols.split(", "))
            parts.append(f"""{nxt} as (
  select {wcols}, w.g, case when w.n > 1 then w.i // 16 else w.i end as i,
         case when w.n > 1 then (w.n + 15) // 16 else w.n end as n,
         case when w.n > 1 then sha256(r.before || w.cur || r.after) else w.cur end as cur,
         case when w.n > 1 then w.proof || r.before || r.after else w.proof end as proof
  from {last} w left join (
    select g, i, coalesce(string_agg(h, '') over (partition by g, i // 16 order by i rows between unbounded preceding and 1 preceding), '') as before,
           coalesce(string_agg(h, '') over (partition by g, i // 16 order by i rows between 1 following and unbounded following), '') as after
    from {name}_{k}) r on r.g = w.g and r.i = w.i)""")
            last = nxt
    return ("with " + ",\n".join(parts) + f"""
select doc_id, leaf, subroots.h as subroot, root.h as root, sha256(proof) as proof_sha256,
       cur as folded_root, cur = root.h as verified
from {last} w join subroots on subroots.g = w.s cross join root""")


@query("op11_merkle_manifest", _sql())
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    chosen = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    return multiproofs(leaves(docs, tamper=chosen)).select(
        "doc_id", "leaf", "subroot", "root", F.sha2("proof", 256).alias("proof_sha256"), "folded_root", "verified")
