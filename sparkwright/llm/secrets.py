"""Secret scan with multipart credential linking, in DataFrame functions only.

Strong parts (assigned passwords and tokens, cloud access ids, long hex runs)
are secrets by themselves.  Weak parts (user names and client ids, loosely
named or bare high-entropy values, service addresses) count only where parts
that complete a credential stand near each other: a weak value with an
identifier or an endpoint, an identifier or endpoint with a secret.

Parts are intervals of code points.  They meet in an interval join: every text
is divided into cells as wide as the scope, the parts are summed up per row,
cell and role (smallest start, largest end), and each weak candidate joins the
cells that its scope touches.  A cell is no wider than the scope, so the two
bounds decide exactly whether one of its parts lies inside; the join returns a
few rows a candidate however many parts stand together."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkwright.llm.shared import KEY, query, row_key, same_key, stage, table, text_or_empty

# Fixed patterns of the contract (base kinds), in the order of ties.
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
#: Runs of [0-9a-f] are taken whole, so those of 24 or more are these matches.
HEX = r"[0-9a-f]{24,}"

# Weak parts of the method.
IDENTIFIER = (r"""(?i)\b(user(?:name)?|login|client_?id|account_?id|access_?key_?id)["']?\x20*[:=]\x20*["']?"""
              r"([A-Za-z0-9@._-]{3,})")
NAMED = (r"""(?i)\b(passphrase|pwd|auth|credential|private_?key|access_?key|signature)["']?\x20*[:=]\x20*["']?"""
         r"([A-Za-z0-9+/_.=-]{8,})")
BARE = r"(?<![A-Za-z0-9+/])(?=[A-Za-z+/]*[0-9])(?=[a-z0-9+/]*[A-Z])(?=[A-Z0-9+/]*[a-z])([A-Za-z0-9+/]{40})(?![A-Za-z0-9+/])"
ENDPOINT = (r"""(?i)\b(?:https?|s?ftp|ssh|jdbc:[a-z0-9]+|postgres(?:ql)?|mysql|mongodb|redis|amqp)://([^\s"'<>]+)""")

#: kind -> (order, role, pattern, group whose length counts, its least length)
BASE = {"assign": (0, "secret", ASSIGN, 2, 6), "access": (1, "identifier", ACCESS, 0, 20),
        "hex": (2, "secret", HEX, 0, 24)}
WEAK = {"identifier": (3, "identifier", IDENTIFIER, 2, 3), "named": (4, "secret", NAMED, 2, 8),
        "bare": (5, "secret", BARE, 1, 40), "endpoint": (6, "endpoint", ENDPOINT, 1, 4)}
#: Code points between two parts of one credential, at most.
SCOPE = 200
MASK = "[SECRET]"
SPAN = "array<struct<start:bigint,rank:int,end:bigint,kind:string,role:string>>"


def _running(values: Column, combine) -> Column:
    """Inclusive running sums (or maxima) of an array: in round k every element
    takes in the one 2^k places before it, so n elements take log n rounds of
    linear work.  (A fold that appends copies its result at every step.)"""
    rounds = F.ceil(F.log2(F.size(values) + F.lit(0.0))).cast("int")
    steps = F.when(F.size(values) > 1, F.sequence(F.lit(0), rounds - 1)).otherwise(F.array().cast("array<int>"))

    def step(acc, k):
        by = F.pow(F.lit(2.0), k).cast("int")
        return F.concat(F.slice(acc, F.lit(1), by),
                        F.zip_with(F.slice(acc, by + 1, F.size(acc) - by), F.slice(acc, F.lit(1), F.size(acc) - by), combine))

    return F.aggregate(steps, values, step)


def _spans(text: Column, kind: str, spec: tuple) -> Column:
    """Spans of the matches of one pattern: the running lengths of the texts
    between the matches and of the matches give the offsets."""
    rank, role, pattern, group, least = spec
    whole = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    value = whole if group == 0 else F.regexp_extract_all(text, F.lit(pattern), F.lit(group))
    size = F.transform(whole, F.length)
    # The last gap has no match after it.
    gaps = F.slice(F.transform(F.split(text, pattern), F.length), F.lit(1), F.size(whole))
    ends = _running(F.zip_with(gaps, size, lambda g, n: (g + n).cast("bigint")), lambda x, y: x + y)
    steps = F.arrays_zip(ends.alias("end"), size.alias("size"), F.transform(value, F.length).alias("held"))
    # A match that is too short is passed over but moves the offset on.
    named = F.transform(F.filter(steps, lambda x: x["held"] >= least), lambda x: F.struct(
        (x["end"] - x["size"]).alias("start"), F.lit(rank).alias("rank"), x["end"].alias("end"),
        F.lit(kind).alias("kind"), F.lit(role).alias("role")))
    # The plain test spares most texts the rest.
    return F.when(text.rlike(pattern), named).otherwise(F.array()).cast(SPAN)


def base_spans(text: Column) -> Column:
    """All strong spans of a text, by start and then kind."""
    return F.array_sort(F.concat(*[_spans(text, k, s) for k, s in BASE.items()]))


def weak_spans(text: Column) -> Column:
    """All weak parts; a value or an endpoint alone never counts, so bare
    values are only looked for in texts that have another weak part or an
    access id."""
    named = {k: _spans(text, k, s) for k, s in WEAK.items() if k != "bare"}
    partner = (text.rlike(IDENTIFIER) | text.rlike(ENDPOINT) | text.rlike(ACCESS))
    bare = F.when(partner, _spans(text, "bare", WEAK["bare"])).otherwise(F.array()).cast(SPAN)
    return F.array_sort(F.concat(*named.values(), bare))


def link_parts(parts: DataFrame, scope: int = SCOPE) -> DataFrame:
    """Weak parts that parts of complementary roles complete.

    ``parts``: the row key columns and ``base`` and ``weak`` span arrays, one
    row per text.  Returns the key and ``linked``, the array of weak spans
    whose gap to a complementary part is at most ``scope`` code points."""
    # Only texts with weak parts can have linked ones.
    rows = parts.where(F.size("weak") > 0).dropDuplicates(KEY)
    weak = rows.select(*KEY, F.explode("weak").alias("w")).select(*KEY, "w.*")
    every = rows.select(*KEY, F.explode(F.concat("base", "weak")).alias("p")).select(*KEY, "p.*")
    cell = lambda c: F.floor(c / scope)
    cells = (every.select(*KEY, F.col("role").alias("other"), "start", "end",
                          F.explode(F.sequence(cell(F.col("start")), cell(F.col("end")))).alias("cell"))
             .groupBy(*KEY, "cell", "other").agg(F.min("start").alias("low"), F.max("end").alias("high")))
    asks = weak.withColumn("cell", F.explode(F.sequence(
        cell(F.greatest(F.col("start") - scope, F.lit(0))), cell(F.col("end") + scope))))
    near = ((F.col("high") >= F.col("start") - scope) & (F.col("low") <= F.col("end") + scope))
    completes = F.when(F.col("role") == "secret", F.col("other").isin("identifier", "endpoint")).otherwise(
        F.col("other") == "secret")
    on = same_key(asks, cells) & (asks["cell"] == cells["cell"])
    met = (asks.join(cells, on)
           .where(near & completes)
           .select(*[asks[c] for c in KEY], "start", "rank", "end", "kind", "role").distinct())
    return met.groupBy(*KEY).agg(F.array_sort(F.collect_list(
        F.struct("start", "rank", "end", "kind", "role"))).alias("linked"))


def _listed(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", scope: int = SCOPE) -> DataFrame:
    """One row per row of ``docs``: doc_id, ``base`` and ``linked`` span arrays
    (start, rank, end, kind, role; code points, end exclusive) by start and
    then kind.

    Null and empty texts have no spans; repeated rows and null ids are scanned
    like any others; an empty table gives an empty one; extra columns are
    ignored."""
    text = text_or_empty(text_col)
    parts = stage(docs.select(*row_key(id_col, text_col), base_spans(text).alias("base"),
                              weak_spans(text).alias("weak")), "parts")
    linked = stage(link_parts(parts, scope), "linked")
    return (parts.join(linked, same_key(parts, linked), "left")
            .select(parts["k_id"].alias("doc_id"), "base",
                    F.coalesce("linked", F.array().cast(SPAN)).alias("linked")))


#: Code points of a text that are addressed together.
CHUNK = 1024


def _masked(text: Column, spans: Column, mask: str) -> Column:
    """``text`` with the spans (sorted by start) replaced; a span that starts
    inside earlier ones adds no mask.  The text is cut into chunks once, so a
    piece of it costs its own length and two chunks, wherever it stands."""
    reach = _running(F.transform(spans, lambda s: s["end"]), lambda x, y: F.greatest(x, y))
    # Each span with the end of all before it.
    pairs = F.arrays_zip(F.transform(spans, lambda s: s["start"]).alias("start"),
                         F.concat(F.array(F.lit(0).cast("bigint")), F.slice(reach, F.lit(1), F.size(reach) - 1)).alias("from"))
    chunks = F.regexp_extract_all(text, F.lit(f"(?s).{{1,{CHUNK}}}"), F.lit(0))

    def piece(held, start, end):
        one, two = F.floor(start / CHUNK).cast("int"), F.floor(end / CHUNK).cast("int")
        a, b = (start % CHUNK).cast("int"), (end % CHUNK).cast("int")
        first, last = F.coalesce(F.get(held, one), F.lit("")), F.coalesce(F.get(held, two), F.lit(""))
        return F.when(one == two, F.substring(first, a + 1, b - a)).otherwise(F.concat(
            F.substring(first, a + 1, F.lit(CHUNK)), F.array_join(F.slice(held, one + 2, two - one - 1), ""),
            F.substring(last, F.lit(1), b)))

    # One binding of the chunks for all pieces.
    parts = F.transform(F.array(chunks), lambda held: F.concat(
        F.array_join(F.transform(pairs, lambda x: F.when(
            x["start"] >= x["from"], F.concat(piece(held, x["from"], x["start"]), F.lit(mask))).otherwise("")), ""),
        piece(held, F.array_max(reach), F.length(text).cast("bigint"))))
    return F.get(parts, F.lit(0))


def redact(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", scope: int = SCOPE,
           mask: str = MASK) -> DataFrame:
    """``docs`` with every secret span of its texts replaced by ``mask``;
    overlapping spans become one.  All rows and columns stay; a column
    ``n_chars`` is counted anew where a text changed."""
    text = text_or_empty(text_col)
    parts = docs.select(*row_key(id_col, text_col), base_spans(text).alias("base"), weak_spans(text).alias("weak"))
    linked = stage(link_parts(stage(parts, "parts"), scope), "linked")
    keyed = docs.select(F.struct("*").alias("row"), *row_key(id_col, text_col), base_spans(text).alias("base"))
    rows = keyed.join(linked, same_key(keyed, linked), "left")
    t = F.col("row")[text_col]
    spans = F.array_sort(F.concat("base", F.coalesce("linked", F.array().cast(SPAN))))

    clean = _masked(t, spans, mask)
    rows = rows.select("row", F.when(F.size(spans) > 0, clean).alias("clean"))
    kinds = dict(docs.dtypes)
    out = []
    for c in docs.columns:
        if c == text_col:
            out.append(F.coalesce("clean", F.col("row")[c]).alias(c))
        elif c == "n_chars":
            out.append(F.when(F.col("clean").isNotNull(), F.length("clean").cast(kinds[c]))
                       .otherwise(F.col("row")[c]).alias(c))
        else:
            out.append(F.col("row")[c].alias(c))
    return rows.select(*out)


@query("op3_secret_scan")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan(table(spark, sf_dir, "documents"))
    count = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("bigint")
    return found.select(
        "doc_id", count("assign").alias("n_assign"), count("access").alias("n_access"), count("hex").alias("n_hex"),
        F.sha2(_listed(F.col("base")), 256).alias("base_sha256"),
        _listed(F.array_sort(F.concat("base", "linked"))).alias("spans"))
