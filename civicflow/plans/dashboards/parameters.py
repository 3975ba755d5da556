"""Dashboard parameter pickers (the value lists behind the drop-downs)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from civicflow.operators.ordering import asc
from civicflow.plans.common import Tables
from civicflow.plans.registry import query

S = "parameters"


@query("var_city", section=S, oracle="""
SELECT DISTINCT city FROM address WHERE city IS NOT NULL ORDER BY city""")
def var_city(t: Tables) -> DataFrame:
    """Every city of every address (clients' too), for the multi-select."""
    return (t["address"].filter(F.col("city").isNotNull()).select("city").distinct()
            .orderBy(asc("city")))


@query("var_sector", section=S, oracle="""
SELECT DISTINCT de FROM code_label WHERE domain = 'field_of_interest' ORDER BY de""")
def var_sector(t: Tables) -> DataFrame:
    return (t["code_label"].filter(F.col("domain") == "field_of_interest").select("de")
            .distinct().orderBy(asc("de")))


@query("var_organization", section=S, oracle="""
SELECT DISTINCT name_text FROM lobbyist_identity ORDER BY name_text""")
def var_organization(t: Tables) -> DataFrame:
    return t["lobbyist_identity"].select("name_text").distinct().orderBy(asc("name_text"))
