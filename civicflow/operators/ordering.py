"""Ordering operators: PostgreSQL null order, top-k and RANK() <= k.

PostgreSQL sorts NULLs *first* for DESC and *last* for ASC; Spark does the
opposite.  Every ORDER BY in the query library goes through ``desc``/``asc``
below so the survivors of a LIMIT match the reference.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def desc(c) -> Column:
    """``ORDER BY c DESC`` with PostgreSQL semantics (NULLs first)."""
    return _c(c).desc_nulls_first()


def asc(c) -> Column:
    """``ORDER BY c ASC`` with PostgreSQL semantics (NULLs last)."""
    return _c(c).asc_nulls_last()


def top_k(df: DataFrame, k: int, *order: Column) -> DataFrame:
    """``ORDER BY … LIMIT k``.

    Planned as TakeOrderedAndProject: every partition keeps its own k best
    rows and only k × partitions rows reach the final merge, so the cost is
    one pass over the input, with no global sort and no shuffle of the data.
    """
    return df.orderBy(*order).limit(k)


def rank_leq(df: DataFrame, value: str, k: int, rank_col: str = "rank",
             nulls_last: bool = True) -> DataFrame:
    """Rows whose ``RANK() OVER (ORDER BY value DESC)`` is at most ``k``.

    A window without PARTITION BY runs in a single task.  Instead:

    1. count rows per distinct value (partial aggregation, skew-proof even if
       one value holds a third of the rows);
    2. keep the k largest distinct values (TakeOrderedAndProject, <= k rows);
    3. rank those values: rank = 1 + rows with a strictly larger value — a
       window over at most k rows;
    4. broadcast-join the (<= k row, proven bound) value→rank table back.

    Ties are kept whole, so more than k rows may come back, exactly as RANK.
    """
    order = F.col(value).desc_nulls_last() if nulls_last else F.col(value).desc_nulls_first()
    counts = df.groupBy(value).agg(F.count(F.lit(1)).alias("__n"))
    best = counts.orderBy(order).limit(k)
    w = Window.orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    ranked = (best
              .withColumn(rank_col, (F.coalesce(F.sum("__n").over(w), F.lit(0)) + 1).cast("int"))
              .filter(F.col(rank_col) <= k)
              .select(F.col(value).alias("__v"), rank_col))
    return (df.join(F.broadcast(ranked), df[value].eqNullSafe(ranked["__v"]), "inner")
              .drop("__v"))


def top_k_per_group(df: DataFrame, keys: list[str], k: int, *order: Column,
                    salts: int = 16) -> DataFrame:
    """The first ``k`` rows per group under ``order`` (exact), skew-safe.

    A plain ``row_number() OVER (PARTITION BY keys)`` sorts a hot group in
    one task.  Here the group is first split into ``salts`` sub-groups by a
    hash of the whole row; each keeps its own k best (any row of the final k
    is among the k best of its sub-group), and the second window ranks at
    most ``k × salts`` rows per group.
    """
    salt = F.pmod(F.xxhash64(*[F.col(c) for c in df.columns]), F.lit(salts))
    w1 = Window.partitionBy(*keys, "__salt").orderBy(*order)
    w2 = Window.partitionBy(*keys).orderBy(*order)
    return (df.withColumn("__salt", salt)
            .withColumn("__r", F.row_number().over(w1)).filter(F.col("__r") <= k)
            .withColumn("__r", F.row_number().over(w2)).filter(F.col("__r") <= k)
            .drop("__salt", "__r"))


def lag_by(df: DataFrame, key: str, order: list[str], value: str, alias: str) -> DataFrame:
    """``LAG(value) OVER (PARTITION BY key ORDER BY order)``, exact, one plan for every size.

    ``order`` must make rows unique within a key (end it with an id).  A key
    is cut into slices, one per value of the first order column; each slice
    is a window of its own.  A slice's first row takes the last value of the
    slice before, which partial aggregates find (one row per slice), so a hot
    key's rows are never sorted in one task.  Nothing runs until an action.
    """
    head, *tail = order
    inside = Window.partitionBy(key, head).orderBy(*tail)
    last = df.groupBy(key, head).agg(
        F.max_by(F.struct(F.col(value).alias("v")), F.struct(*tail)).alias("__last"))
    before = last.select(
        F.col(key).alias("__key"), F.col(head).alias("__head"),
        F.lag("__last").over(Window.partitionBy(key).orderBy(head)).alias("__before"))
    rows = (df.withColumn("__place", F.row_number().over(inside))
            .withColumn("__lag", F.lag(value).over(inside)))
    joined = rows.join(before, rows[key].eqNullSafe(before["__key"])
                       & rows[head].eqNullSafe(before["__head"]), "left")
    return joined.withColumn(alias, F.when(F.col("__place") == 1, F.col("__before.v"))
                             .otherwise(F.col("__lag"))).select(*df.columns, alias)
