"""Layer jobs, the named-query registry and its SQL oracle."""

from .layers import LAYERS, LayerPaths, resolve_layers, run_bronze, run_gold, run_layers, run_silver
from .oracle import oracle_sql
from .registry import QUERIES, gold

__all__ = [
    "LAYERS",
    "LayerPaths",
    "QUERIES",
    "gold",
    "oracle_sql",
    "resolve_layers",
    "run_bronze",
    "run_gold",
    "run_layers",
    "run_silver",
]
