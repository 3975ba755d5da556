"""Optimized dashboard: read the materialized topic view."""

from __future__ import annotations

from pyspark.sql import DataFrame

from civicflow.operators.ordering import asc, desc, top_k
from civicflow.plans.common import Tables
from civicflow.plans.registry import query

S = "optimized"


@query("mv_top10", section=S, oracle="""
SELECT field_of_interest, total_spend_max FROM mv_financial_tops
ORDER BY total_spend_max DESC NULLS FIRST, field_of_interest LIMIT 10""")
def mv_top10(t: Tables) -> DataFrame:
    mv = t["mv_financial_tops"].select("field_of_interest", "total_spend_max")
    return top_k(mv, 10, desc("total_spend_max"), asc("field_of_interest"))


@query("mv_all", section=S, oracle="""
SELECT * FROM mv_financial_tops ORDER BY total_spend_max DESC NULLS FIRST""")
def mv_all(t: Tables) -> DataFrame:
    return t["mv_financial_tops"].orderBy(desc("total_spend_max"), asc("field_of_interest"))
