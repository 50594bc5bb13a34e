"""Registered queries: one per operator of the inventory (see README)."""

from sparkwright.plans import (  # noqa: F401  (import registers the queries)
    q_clean,
    q_eval,
    q_features,
    q_ml,
    q_profile,
    q_relational,
    q_stores,
    q_sources,
    q_text,
)
from sparkwright.plans.registry import ORACLES, QUERIES

__all__ = ["QUERIES", "ORACLES"]
