"""All queries of this package: importing the modules registers them."""

from sparkwright.llm import (  # noqa: F401
    collocations,
    decontaminate,
    embedding_dedup,
    language_id,
    licenses,
    merkle,
    packing,
    preferences,
    quality,
    secrets,
    simhash,
    suffix_dedup,
    toxicity,
)
from sparkwright.llm.shared import ORACLES, QUERIES

__all__ = ["QUERIES", "ORACLES"]
