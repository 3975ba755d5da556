"""Aggregate expressions that PostgreSQL has and Spark spells differently."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def string_agg_distinct(c, sep: str) -> Column:
    """``STRING_AGG(DISTINCT c, sep)`` with a defined (sorted) order.

    ``collect_set`` is a partial aggregate (map-side de-duplication), so a hot
    group ships one set per partition, not one row per input row.  An empty
    set gives NULL, as in PostgreSQL.
    """
    s = F.collect_set(_c(c))
    return F.when(F.size(s) > 0, F.array_join(F.array_sort(s), sep))


def json_agg_distinct(c) -> Column:
    """``JSON_AGG(DISTINCT c)`` as an array: sorted values, then NULL if any.

    PostgreSQL keeps NULL as a distinct element; ``collect_set`` drops it, so
    it is re-appended when the group saw a NULL.
    """
    vals = F.array_sort(F.collect_set(_c(c)))
    saw_null = F.max(F.when(_c(c).isNull(), F.lit(1)).otherwise(F.lit(0))) == 1
    return F.when(saw_null, F.concat(vals, F.array(F.lit(None).cast("string")))).otherwise(vals)

