"""City dashboard: one or more selected cities (empty selection = all)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from civicflow.operators.ordering import asc, desc, top_k
from civicflow.plans.common import Tables, entry_topics, sql_list
from civicflow.plans.dashboards.geo import located
from civicflow.plans.registry import query

S = "city"
CITIES = ["NATION_1", "NATION_2"]
_IN = sql_list(CITIES)
_CHAIN = """FROM register_entry re
JOIN lobbyist_identity li ON re.id = li.entry_id
JOIN address a ON li.address_id = a.id"""


def in_cities(t: Tables, cities, *cols: str) -> DataFrame:
    df = located(t, "city", *cols)
    return df.filter(F.col("city").isin(list(cities))) if cities else df


@query("city_count", section=S, cities=CITIES, oracle=f"""
SELECT COUNT(DISTINCT re.id) AS lobbyists {_CHAIN} WHERE a.city IN ({_IN})""")
def city_count(t: Tables, cities=()) -> DataFrame:
    return in_cities(t, cities).agg(F.countDistinct("entry_id").alias("lobbyists"))


@query("city_budget", section=S, cities=CITIES, oracle=f"""
SELECT CAST(SUM(fe.expenses_to_eur) AS BIGINT) AS budget {_CHAIN}
JOIN financial_expenses fe ON re.id = fe.entry_id WHERE a.city IN ({_IN})""")
def city_budget(t: Tables, cities=()) -> DataFrame:
    fe = t["financial_expenses"].select("entry_id", "expenses_to_eur")
    return (in_cities(t, cities).join(fe, "entry_id")
            .agg(F.sum("expenses_to_eur").alias("budget")))


@query("city_top_topics", section=S, cities=CITIES, oracle=f"""
SELECT cl.de AS topic, COUNT(*) AS n {_CHAIN}
JOIN activities_interests ai ON re.id = ai.entry_id
JOIN field_of_interest foi ON ai.id = foi.activities_id
JOIN code_label cl ON foi.label_id = cl.id
WHERE a.city IN ({_IN}) GROUP BY cl.de ORDER BY 2 DESC, topic LIMIT 20""")
def city_top_topics(t: Tables, cities=()) -> DataFrame:
    agg = (in_cities(t, cities).join(entry_topics(t), "entry_id")
           .groupBy(F.col("de").alias("topic")).agg(F.count(F.lit(1)).alias("n")))
    return top_k(agg, 20, desc("n"), asc("topic"))


@query("city_top_players", section=S, cities=CITIES, oracle=f"""
SELECT li.name_text AS organisation, CAST(SUM(fe.expenses_to_eur) AS BIGINT) AS budget {_CHAIN}
JOIN financial_expenses fe ON re.id = fe.entry_id
WHERE a.city IN ({_IN}) GROUP BY li.name_text ORDER BY 2 DESC NULLS FIRST, organisation LIMIT 20""")
def city_top_players(t: Tables, cities=()) -> DataFrame:
    li = t["lobbyist_identity"].select(F.col("id").alias("identity_id"), "name_text")
    fe = t["financial_expenses"].select("entry_id", "expenses_to_eur")
    agg = (in_cities(t, cities).join(li, "identity_id").join(fe, "entry_id")
           .groupBy(F.col("name_text").alias("organisation"))
           .agg(F.sum("expenses_to_eur").alias("budget")))
    return top_k(agg, 20, desc("budget"), asc("organisation"))
