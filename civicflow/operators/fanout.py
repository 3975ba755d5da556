"""Exact aggregation over 1:N × 1:M join fan-out without building it.

Many register queries join an entry to two independent child tables (its
topics and its fiscal years, its donations and its staff, …) and aggregate
the product.  The reference keeps the fan-out on purpose: an entry's
expenses are summed once per matching topic row.  Materialising the product
is quadratic per entry and, with one entry holding a large share of a child
table, puts that square into one task.

Instead each child is reduced per join key first (partial aggregation,
skew-proof) and the aggregates are combined by multiplicity:

    SUM over (a × b)   = SUM_a(x) · |b|
    COUNT over (a × b) = |a| · |b|
    MAX / MIN / COUNT DISTINCT over (a × b) = the child's own value

where ``|b|`` is the number of b-rows the join contributes (at least 1 for a
LEFT join that found nothing).  The joins that remain are 1:1 on the key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def child_stats(df: DataFrame, key: str | list[str], value: str | None = None,
                prefix: str = "c") -> DataFrame:
    """Per key: row count, non-NULL count, sum and max of ``value``."""
    keys = [key] if isinstance(key, str) else list(key)
    aggs = [F.count(F.lit(1)).alias(f"{prefix}_rows")]
    if value is not None:
        aggs += [F.count(value).alias(f"{prefix}_n"),
                 F.sum(value).alias(f"{prefix}_sum"),
                 F.max(value).alias(f"{prefix}_max")]
    return df.groupBy(*keys).agg(*aggs)


def left_rows(c: Column | str) -> Column:
    """Rows a LEFT JOIN contributes: the match count, or 1 for no match."""
    c = F.col(c) if isinstance(c, str) else c
    return F.greatest(F.coalesce(c, F.lit(0)).cast("long"), F.lit(1).cast("long"))


def exact(*factors: Column | str) -> Column:
    """Product of whole numbers as decimal(38,0): multiplicities overflow a long."""
    out = None
    for f in factors:
        f = (F.col(f) if isinstance(f, str) else f).cast("decimal(38,0)")
        out = f if out is None else (out * f).cast("decimal(38,0)")
    return out
