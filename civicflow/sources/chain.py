"""SRC-1 / SRC-8: the order of landed pages along their cursors, by list ranking.

A client pages through a register by cursor: it asks without one, each answer
names the cursor of the next page, and it stops when there is none, or one it
has asked for already.  Landed pages are an unordered table of
(run, page, cursor asked for, next cursor).  Their order is the rank on the path from the
run's first page, found by pointer doubling: after round k the first
``2**k`` pages of every run are ranked and each page points ``2**k`` pages ahead, so a chain
of n pages takes log2(n) rounds of equi-joins, never a walk page by page on the driver.

States of a page: ``chained``; ``last`` (no next cursor); ``gap`` (the next cursor has not landed);
``repeated`` (the next cursor is on the path already, its own included); ``duplicate`` (an earlier named page
has the same cursor); ``unreachable`` (no path from the run's first page).  Only
the first four have a rank, from 0.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from civicflow.sources.store import stage

#: Stands for the cursor of a run's first page, which is asked for without one.
FIRST = ""


def _shuffled(left: DataFrame, right: DataFrame, on: list[str], how: str = "inner") -> DataFrame:
    """A join that never broadcasts: every round joins whole tables, and a side that
    is just small enough would go through the driver once a round."""
    return left.join(right.hint("merge"), on, how)


def page_chain(pages: DataFrame) -> DataFrame:
    """(run, page, rank, state) of landed ``pages`` (run, page, cursor, next_cursor)."""
    rows = pages.select("run", "page", F.coalesce("cursor", F.lit(FIRST)).alias("at"),
                        F.nullif(F.col("next_cursor"), F.lit(FIRST)).alias("to"))
    firsts = rows.groupBy("run", "at").agg(F.min("page").alias("page"))
    # One page per cursor; equal rows of one page name count once.
    nodes = stage(_shuffled(rows, firsts, ["run", "at", "page"]).groupBy("run", "at", "page").agg(
        F.min("to").alias("to")), "chain-nodes")
    known = nodes.select("run", F.col("at").alias("to"))
    jumps = _shuffled(nodes.where(F.col("to") != F.col("at")), known, ["run", "to"]).select("run", "at", "to")
    ranked = nodes.where(F.col("at") == FIRST).select("run", "at", F.lit(0).cast("long").alias("rank"))
    jumps, ranked, step, n = stage(jumps, "chain-jumps"), stage(ranked, "chain-ranks"), 1, -1
    while (now := ranked.count()) != n:
        n = now
        ahead = _shuffled(ranked, jumps, ["run", "at"]).select(
            "run", F.col("to").alias("at"), (F.col("rank") + step).alias("rank"))
        # On a cycle a page is met again with a higher rank; the first one counts.
        ranked = stage(ranked.unionByName(ahead).groupBy("run", "at").agg(F.min("rank").alias("rank")), "chain-ranks")
        farther = jumps.select("run", F.col("at").alias("to"), F.col("to").alias("far"))
        jumps = stage(_shuffled(jumps, farther, ["run", "to"]).select("run", "at", F.col("far").alias("to")),
                      "chain-jumps")
        step *= 2
    after = ranked.select("run", F.col("at").alias("to"), F.col("rank").alias("to_rank"))
    state = (F.when(F.col("to").isNull(), "last").when(F.col("to_rank").isNull(), "gap")
             .when(F.col("to_rank") <= F.col("rank"), "repeated").otherwise("chained"))
    placed = _shuffled(_shuffled(nodes, ranked, ["run", "at"], "left"), after, ["run", "to"], "left").select(
        "run", "page", "at", "rank", F.when(F.col("rank").isNull(), "unreachable").otherwise(state).alias("state"))
    rest = _shuffled(rows.select("run", "page", "at").distinct(), placed.select("run", "page", "at"),
                     ["run", "page", "at"], "left_anti")
    return placed.select("run", "page", "rank", "state").unionByName(rest.select(
        "run", "page", F.lit(None).cast("long").alias("rank"), F.lit("duplicate").alias("state")))


def chain_gaps(chain: DataFrame) -> DataFrame:
    """(run, pages, ranked, complete): how many pages of each run landed, how many are on its chain,
    and whether the chain ends as it should."""
    return chain.groupBy("run").agg(
        F.count("*").alias("pages"), F.count("rank").alias("ranked"),
        F.coalesce(F.bool_or(F.col("state") == "last"), F.lit(False)).alias("complete"))
