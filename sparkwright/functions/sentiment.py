"""Lexicon sentiment (T-2, T-3, T-4): polarity and subjectivity per text.

Each text is tokenised (lower case, split on anything that is not a-z or an
apostrophe); each token found in the lexicon contributes its (polarity,
subjectivity); the scores are the means over the matched tokens, 0.0 when none
matches.  The lexicon is a bounded literal map, so the whole score is one
per-row expression: no shuffle, no state, valid in append-mode streams.
A large lexicon kept in a table goes through ``score_with_table`` instead
(tokens joined to the lexicon, then grouped per text).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


TOKEN_SPLIT = "[^a-z']+"

# The default lexicon, word -> (polarity, subjectivity).
LEXICON = {
    "good": (0.7, 0.6), "great": (0.8, 0.75), "best": (1.0, 0.3), "better": (0.5, 0.5),
    "excellent": (1.0, 1.0), "happy": (0.8, 1.0), "nice": (0.6, 1.0), "love": (0.5, 0.6),
    "well": (0.2, 0.3), "new": (0.14, 0.45), "free": (0.4, 0.8), "right": (0.29, 0.54),
    "bad": (-0.7, 0.67), "worst": (-1.0, 1.0), "worse": (-0.4, 0.6), "poor": (-0.4, 0.6),
    "sad": (-0.5, 1.0), "hate": (-0.8, 0.9), "wrong": (-0.5, 0.9), "old": (0.1, 0.2),
    "only": (0.0, 1.0), "very": (0.2, 0.3), "first": (0.25, 0.33), "last": (0.0, 0.07),
}


def _lexicon_map(lexicon: dict) -> Column:
    """word -> array(polarity, subjectivity), a foldable literal map."""
    return F.create_map(*[x for k, (p, s) in lexicon.items()
                          for x in (F.lit(k), F.array(F.lit(float(p)), F.lit(float(s))))])


def _hits(text, lexicon: dict) -> Column:
    """Score pairs of the lexicon tokens of one text (one split, one lookup)."""
    t = F.col(text) if isinstance(text, str) else text
    m = _lexicon_map(lexicon)
    return F.filter(F.transform(F.split(F.lower(t), TOKEN_SPLIT), lambda w: m[w]), lambda v: v.isNotNull())


def _mean_slot(hits: Column, i: int) -> Column:
    total = F.aggregate(hits, F.lit(0.0), lambda acc, v: acc + v[i])
    return F.when(F.size(hits) > 0, total / F.size(hits)).otherwise(F.lit(0.0))


def polarity(text, lexicon: dict = LEXICON) -> Column:
    """T-2: mean polarity of lexicon tokens, in [-1, 1]."""
    return _mean_slot(_hits(text, lexicon), 0)


def subjectivity(text, lexicon: dict = LEXICON) -> Column:
    """T-3: mean subjectivity of lexicon tokens, in [0, 1]."""
    return _mean_slot(_hits(text, lexicon), 1)


def classify_text(df: DataFrame, text: str = "word", lexicon: dict = LEXICON) -> DataFrame:
    """T-4: append both scores (doubles, not strings).  The matched pairs are
    computed once per row and both means read them."""
    cols = df.columns
    h = df.withColumn("_hits", _hits(text, lexicon))
    return h.select(*cols, _mean_slot(F.col("_hits"), 0).alias("polarity"),
                    _mean_slot(F.col("_hits"), 1).alias("subjectivity"))


def score_with_table(df: DataFrame, key: str, text: str, lexicon: DataFrame) -> DataFrame:
    """Batch form for a lexicon held in a table (word, polarity, subjectivity):
    tokens join the lexicon, means per key."""
    toks = df.select(key, F.explode(F.split(F.lower(F.col(text)), TOKEN_SPLIT)).alias("word"))
    hits = toks.join(lexicon, "word", "inner")
    agg = hits.groupBy(key).agg(F.avg("polarity").alias("polarity"), F.avg("subjectivity").alias("subjectivity"))
    return (df.join(agg, key, "left")
            .fillna(0.0, subset=["polarity", "subjectivity"]))
