"""A mapping of register tables that also resolves derived views lazily."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping

from pyspark.sql import DataFrame


class Tables(Mapping):
    """Base tables plus views computed on first use.

    ``views`` maps a view name to a function of this mapping.  A view that
    was materialized (``civicflow.sources.store.materialize``) is supplied as
    a base table instead and is then read, not recomputed.
    """

    def __init__(self, base: Mapping[str, DataFrame],
                 views: Mapping[str, Callable[["Tables"], DataFrame]] | None = None):
        self._base = dict(base)
        self._views = dict(views or {})
        self._memo: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name in self._base:
            return self._base[name]
        if name in self._memo:
            return self._memo[name]
        if name in self._views:
            df = self._views[name](self)
            self._memo[name] = df
            return df
        raise KeyError(name)

    def __iter__(self) -> Iterator[str]:
        yield from self._base
        yield from (v for v in self._views if v not in self._base)

    def __len__(self) -> int:
        return len(set(self._base) | set(self._views))

    def with_tables(self, **more: DataFrame) -> "Tables":
        return Tables({**self._base, **more}, self._views)


def register_model(base: Mapping[str, DataFrame]) -> Tables:
    from civicflow.plans.views import VIEW_BUILDERS
    return Tables(base, VIEW_BUILDERS)
