"""JSON message source (S8): pick the long text when present.

A message is ``{"text": ..., "extended_tweet": {"full_text": ...}}`` with the
nested object optional.  A message that is not one whole JSON value, or whose
text is not a string, is dropped, as the reference skips it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _string_at(message: Column, path: str) -> Column:
    """The string at ``path``; null for any other type and where there is none."""
    inner = F.variant_get(message, path, "variant")
    return F.when(F.schema_of_variant(inner) == "STRING", F.variant_get(message, path, "string"))


def message_text(df: DataFrame, column: str = "value", keep: list[str] | tuple = ()) -> DataFrame:
    """(keep..., text, lang): ``extended_tweet.full_text`` if the message has
    an ``extended_tweet``, else ``text``; messages that don't parse or have no
    such string are dropped."""
    # Inside brackets, anything after the message's value is an error or a
    # second element.
    m = F.try_parse_json(F.concat(F.lit("["), F.col(column), F.lit("]")))
    parsed = df.select(*keep, m.alias("_m")).where(F.variant_get("_m", "$[1]", "variant").isNull())
    nested = F.variant_get("_m", "$[0].extended_tweet", "variant").isNotNull()
    text = F.when(nested, _string_at(F.col("_m"), "$[0].extended_tweet.full_text")).otherwise(
        _string_at(F.col("_m"), "$[0].text"))
    out = parsed.select(*keep, text.alias("text"), _string_at(F.col("_m"), "$[0].lang").alias("lang"))
    return out.where(F.col("text").isNotNull())
