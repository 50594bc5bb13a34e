"""Fixed-stride multi-line records (S5, S6) and their rendering.

A text scan yields lines without numbers.  Lines are numbered per file from
the scan's own metadata: each file block is read in order by one task, so
the position inside a block plus the line count of the earlier blocks of the
same file is the line number (no sort of the lines).  Records are then assembled by a group-by on
(file, line // stride) - a record split across two blocks still meets in one
group - and an incomplete last record is dropped.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F


# The field order of one record (7 lines).
PLANET_FIELDS = ["name", "type", "distance", "mass", "low", "high", "cloud"]
PLANET_TYPES = {"distance": "double", "mass": "double", "low": "int", "high": "int", "cloud": "int"}
# Astronomical unit -> million miles factor.
AU_TO_MILLION_MILES = 93


def numbered_lines(spark: SparkSession, path: str, glob: str | None = None) -> DataFrame:
    """(file, line_no, value): 0-based line numbers per file, without sorting
    the lines.  One task reads a file block from start to end, so the ids of
    a block's lines are consecutive: line_no = id - first id of the block +
    lines in the earlier blocks of the file.  Only the per-block table (one
    row per block, bounded by data size / block size) is aggregated and
    joined back; the scan and its ids are the same on every re-read."""
    r = spark.read.option("wholetext", False)
    if glob:
        r = r.option("pathGlobFilter", glob)
    raw = r.text(path).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("_seq"),
        "value")
    blocks = raw.groupBy("file", "block").agg(F.min("_seq").alias("_first"), F.count(F.lit(1)).alias("_n"))
    ow = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = blocks.select("file", "block", "_first",
                            F.coalesce(F.sum("_n").over(ow), F.lit(0)).alias("_off"))
    return (raw.join(offsets, ["file", "block"])
            .select("file", (F.col("_off") + F.col("_seq") - F.col("_first")).alias("line_no"), "value"))


def stride_records(lines: DataFrame, fields: list[str], types: dict[str, str] | None = None) -> DataFrame:
    """Every ``len(fields)`` consecutive lines of a file form one record.
    Returns (file, record_no, *fields, rejected) with typed fields; a value
    that does not parse becomes null and sets ``rejected``."""
    k = len(fields)
    rec = (lines.groupBy("file", F.floor(F.col("line_no") / k).alias("record_no"))
           .agg(F.count(F.lit(1)).alias("_n"),
                *[F.max(F.when(F.col("line_no") % k == i, F.col("value"))).alias(f) for i, f in enumerate(fields)]))
    rec = rec.where(F.col("_n") == k).drop("_n")
    types = types or {}
    typed = [F.col(f).try_cast(types[f]).alias(f) if f in types else F.col(f) for f in fields]
    bad = F.lit(False)
    for f in types:
        bad = bad | (F.col(f).isNotNull() & F.col(f).try_cast(types[f]).isNull())
    return rec.select("file", "record_no", *typed, bad.alias("rejected"))


def planet_variant(records: DataFrame) -> DataFrame:
    """low == 0 and high == 0 -> 'jovian' (cloud-top temperature kept),
    otherwise 'terrestrial' (low/high kept); absent fields are null."""
    jov = (F.col("low") == 0) & (F.col("high") == 0)
    return records.select(
        "*",
        F.when(jov, "jovian").otherwise("terrestrial").alias("variant")
    ).select(
        *[c for c in records.columns if c not in ("low", "high", "cloud")],
        F.when(F.col("variant") == "terrestrial", F.col("low")).alias("low"),
        F.when(F.col("variant") == "terrestrial", F.col("high")).alias("high"),
        F.when(F.col("variant") == "jovian", F.col("cloud")).alias("cloud"),
        "variant")


def render_planet(df: DataFrame) -> DataFrame:
    """The multi-line description per variant and the distance
    sentence with the AU -> million miles conversion (two decimals)."""
    base = F.concat(F.lit("Planet Name:"), F.col("name"), F.lit("\nPlanet type:"), F.col("type"),
                    F.lit("\nDistace from Sun (AU):"), F.col("distance").cast("string"),
                    F.lit("\nMass (kg):"), F.col("mass").cast("string"), F.lit("\n"))
    terr = F.concat(base, F.lit("Surface Temperature (degrees C):"), F.col("low").cast("string"),
                    F.lit(" to "), F.col("high").cast("string"), F.lit("\n"))
    jov = F.concat(base, F.lit("Temperature above cloud tops (degrees C):"), F.col("cloud").cast("string"),
                   F.lit("\n"))
    miles = F.col("distance") * AU_TO_MILLION_MILES
    return df.withColumns({
        "description": F.when(F.col("variant") == "jovian", jov).otherwise(terr),
        "sentence": F.format_string("%s is %.2f million miles from the Sun", F.col("name"), miles),
    })
