"""Import every plan module so that its queries register."""

import importlib

from brightledger.plans.registry import all_queries, all_sql

MODULES = [
    "projections",
    "relations",
    "aggregations",
    "windows",
    "streams",
    "statistics",
    "quality",
    "texts",
    "graphs",
    "learning",
    "clusters",
    "sources",
]

for _m in MODULES:
    importlib.import_module(f"brightledger.plans.{_m}")

__all__ = ["all_queries", "all_sql"]
