"""All registered queries and their SQL equivalents."""

from __future__ import annotations

from plumbline.plans import (
    cleaning_queries,
    evaluation_queries,
    feature_queries,
    model_queries,
    profile_queries,
    scoring_queries,
    storage_queries,
)

MODULES = (
    storage_queries,
    profile_queries,
    cleaning_queries,
    feature_queries,
    model_queries,
    evaluation_queries,
    scoring_queries,
)
QUERIES = {key: fn for module in MODULES for key, fn in module.registry.queries.items()}
ORACLE = {key: sql for module in MODULES for key, sql in module.registry.oracle.items()}
