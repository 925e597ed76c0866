"""All registered queries: importing this module registers them."""

from quillon import queries, queries_inputs, queries_models, queries_runs
from quillon.registry import ORACLE_SQL, QUERIES

MODULES = (queries, queries_inputs, queries_models, queries_runs)
__all__ = ["MODULES", "ORACLE_SQL", "QUERIES"]
