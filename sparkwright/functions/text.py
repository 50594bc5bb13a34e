"""Text cleaning and framing (F1-F4, T-1) as column expressions.

The same functions apply to batch and streaming DataFrames; nothing here keeps
state or leaves the JVM.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Frame marker and the removal patterns, applied in this order.
FRAME_MARKER = "t_end"
STRICT_PATTERNS = [r"http\S+", r"@\w+", "#", "RT", ":"]
# Default mode removes RT only as a whole word.
WORD_PATTERNS = [r"http\S+", r"@\w+", "#", r"\bRT\b", ":"]


def strip_markup(c, strict: bool = True) -> Column:
    """remove URLs, @mentions, '#', 'RT', ':' (in that order).
    ``strict`` keeps the reference's behaviour: 'RT' goes inside words too."""
    c = F.col(c) if isinstance(c, str) else c
    for p in (STRICT_PATTERNS if strict else WORD_PATTERNS):
        if p.isalnum() or p in ("#", ":"):
            c = F.replace(c, F.lit(p), F.lit(""))      # literal: no regex engine
        else:
            # Most texts lack the pattern's literal start: they skip the regex engine.
            start = re.match(r"(\\b)?([\w@#]+?)(?=\\|$)", p)
            c = F.when(F.contains(c, F.lit(start[2])), F.regexp_replace(c, p, "")).otherwise(c)
    return c


def unframe(df: DataFrame, column: str = "value", marker: str = FRAME_MARKER, out: str = "word") -> DataFrame:
    """one row per framed piece (``marker`` is a regex, as in split)."""
    return df.select(F.explode(F.split(F.col(column), marker)).alias(out))


def clean_stream_text(lines: DataFrame, column: str = "value", strict: bool = True,
                      marker: str = FRAME_MARKER) -> DataFrame:
    """T-1: unframe -> '' to null -> drop nulls -> strip markup.
    Strict (reference) order drops only exact '' before stripping, so a
    piece that becomes blank after stripping is kept.  Non-strict mode also
    drops pieces that are blank after stripping."""
    words = unframe(lines, column, marker, "word")
    words = words.where(F.col("word").isNotNull() & (F.col("word") != ""))
    words = words.select(strip_markup("word", strict).alias("word"))
    if not strict:
        words = words.where(F.trim(F.col("word")) != "")
    return words


def track_filter(df: DataFrame, text: str, lang: str | None, keywords: list[str],
                 languages: list[str] | None = None) -> DataFrame:
    """Keep messages in the given languages whose lower-cased text
    contains any keyword.  Works on batch and streaming frames."""
    low = F.lower(F.col(text))
    hit = F.lit(False)
    for k in keywords:
        hit = hit | F.contains(low, F.lit(k.lower()))
    cond = hit
    if lang and languages:
        cond = cond & F.col(lang).isin(list(languages))
    return df.where(cond)


#: Characters of a keyword's key.
GRAM = 4


def keyword_matches(df: DataFrame, key: str, text: str, keywords: list[str]) -> DataFrame:
    """S9 for many keywords: (key, keyword) for every keyword that a text holds
    (in lower case, as ``track_filter``), once each.

    A text is cut at characters that no keyword has, and each of its different
    pieces, if long enough for a keyword, is looked at once.  A keyword's key is
    its first ``GRAM`` characters (fewer if the shortest keyword has fewer).  A
    piece is cut into its different runs of that length in one pass, the runs
    probe a hash table of the keys, and only the keywords that share a run with
    the piece are looked for; so the cost of a text goes with its length and
    its candidates, not with the number of keywords, and a run carries its
    piece, not its text.  The keywords are a list given by the caller, so their
    table is broadcast."""
    words = sorted({w.lower() for w in keywords if w})
    if not words:
        return df.select(key, F.lit("").alias("keyword")).where("false")
    shortest = min(map(len, words))
    size = min(GRAM, shortest)
    table = df.sparkSession.createDataFrame([(w[:size], w) for w in words], "_gram string, keyword string")
    pieces = F.array_distinct(F.split(F.lower(F.col(text)), f"[^{_char_class(''.join(words))}]+"))
    rows = (df.select(key, F.explode(pieces).alias("_t")).where(F.length("_t") >= shortest)
            .select(key, "_t", F.explode(F.array_distinct(
                F.regexp_extract_all(F.col("_t"), F.lit(f"(?s)(?=(.{{{size}}}))"), F.lit(1)))).alias("_gram")))
    return (rows.join(F.broadcast(table), "_gram").where(F.contains("_t", "keyword")).select(key, "keyword").distinct())


def _char_class(chars: str) -> str:
    """The inside of a regex class of these characters, as ranges."""
    points, ranges = sorted(set(map(ord, chars))), []
    for p in points:
        if ranges and p == ranges[-1][1] + 1:
            ranges[-1][1] = p
        else:
            ranges.append([p, p])
    return "".join(f"\\x{{{a:x}}}-\\x{{{b:x}}}" for a, b in ranges)


def track_many(df: DataFrame, key: str, text: str, lang: str, keywords: list[str], langs: list[str]) -> DataFrame:
    """S9 for many keywords: the rows of ``track_filter``, by a unique key."""
    rows = df.where(F.col(lang).isin(list(langs)))
    hits = keyword_matches(rows, key, text, keywords).select(key).distinct()
    return rows.join(hits, key, "left_semi")
