"""Named queries (one per operator of the inventory) and their oracle SQL."""

from __future__ import annotations

from tillcast.catalog import drift_q, encode_q, fits_q, model_q, panel_q, profile_q, scoring_q  # noqa: F401  (registers queries)
from tillcast.catalog.registry import ORACLE, QUERIES


def queries():
    return dict(QUERIES)


def oracle_sql():
    return dict(ORACLE)
