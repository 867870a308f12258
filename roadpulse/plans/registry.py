"""All registered queries and their oracle SQL (import side effects fill both)."""

from __future__ import annotations

from . import (  # noqa: F401
    catalog,
    catalog_eval,
    catalog_features,
    catalog_io,
    catalog_ml,
    catalog_more,
    catalog_streams,
    oracle,
    oracle_dash,
    oracle_eval,
    oracle_features,
    oracle_io,
    oracle_more,
    oracle_streams,
)

QUERIES = catalog.QUERIES
ORACLE = oracle.ORACLE
