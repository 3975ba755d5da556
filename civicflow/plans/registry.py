"""Query registry: every query of the library with its DuckDB oracle text.

A query is a plain function ``(tables, **params) -> DataFrame``.  The
decorator records it together with

* ``oracle`` — the same question in DuckDB SQL over the register tables
  (``None`` where only a rows check is possible), and
* ``params`` — the fixed parameters used by the correctness check.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame


@dataclass
class QuerySpec:
    name: str
    fn: Callable[..., DataFrame]
    oracle: str | None
    params: dict = field(default_factory=dict)
    section: str = ""

    def __call__(self, tables: Mapping[str, DataFrame]) -> DataFrame:
        return self.fn(tables, **self.params)


REGISTRY: dict[str, QuerySpec] = {}


def query(name: str, oracle: str | None = None, section: str = "", **params):
    def deco(fn):
        if name in REGISTRY:
            raise ValueError(f"duplicate query {name}")
        REGISTRY[name] = QuerySpec(name, fn, oracle, params, section)
        return fn
    return deco


def load_all() -> dict[str, QuerySpec]:
    """Import every query module (registration happens on import)."""
    from civicflow.plans import benchmark, reports, stress, views  # noqa: F401
    from civicflow.plans.dashboards import (  # noqa: F401
        advanced, city, compliance, finance, geo, legislation, market,
        optimized, organization, overview, parameters, party)
    from civicflow.sources import ingest_queries  # noqa: F401
    return REGISTRY
