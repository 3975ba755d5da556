"""Geo dashboard: countries, postcode regions and cities."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from civicflow.operators.fanout import child_stats
from civicflow.operators.ordering import asc, desc, top_k
from civicflow.plans.common import Tables, addresses, countries, entries, identities, sql_list
from civicflow.plans.registry import query

S = "geo"
HOME = "DE"
SEVEN_CITIES = [f"NATION_{i}" for i in range(7)]

_CHAIN = """FROM register_entry re
JOIN lobbyist_identity li ON re.id = li.entry_id
JOIN address a ON li.address_id = a.id"""


def located(t: Tables, *cols: str) -> DataFrame:
    """Entries with their identity's address: (entry_id, identity_id, cols…)."""
    return (entries(t).join(identities(t, "address_id"), "entry_id")
            .join(addresses(t, *cols), "address_id"))


def located_country(t: Tables, *cols: str) -> DataFrame:
    return located(t, "country_id", *cols).join(countries(t), "country_id")


@query("geo_international", section=S, oracle=f"""
SELECT cl.code AS country, COUNT(DISTINCT re.id) AS entries
{_CHAIN} JOIN country_label cl ON a.country_id = cl.id
WHERE cl.code != '{HOME}' GROUP BY cl.code ORDER BY 2 DESC""")
def geo_international(t: Tables) -> DataFrame:
    return (located_country(t).filter(F.col("country_code") != HOME)
            .groupBy(F.col("country_code").alias("country"))
            .agg(F.countDistinct("entry_id").alias("entries"))
            .orderBy(desc("entries"), asc("country")))


@query("geo_zip_region", section=S, oracle=f"""
SELECT SUBSTRING(a.zip_code, 1, 1) || 'xxxx' AS zip_region, COUNT(DISTINCT re.id) AS organisations
{_CHAIN} JOIN country_label cl ON a.country_id = cl.id
WHERE cl.code = '{HOME}' AND a.zip_code IS NOT NULL
GROUP BY SUBSTRING(a.zip_code, 1, 1) ORDER BY 1 ASC""")
def geo_zip_region(t: Tables) -> DataFrame:
    return (located_country(t, "zip_code")
            .filter((F.col("country_code") == HOME) & F.col("zip_code").isNotNull())
            .groupBy(F.substring("zip_code", 1, 1).alias("d"))
            .agg(F.countDistinct("entry_id").alias("organisations"))
            .select(F.concat("d", F.lit("xxxx")).alias("zip_region"), "organisations")
            .orderBy(asc("zip_region")))


@query("geo_top_cities", section=S, oracle=f"""
SELECT a.city, COUNT(DISTINCT re.id) AS organisations, CAST(SUM(fe.expenses_to_eur) AS BIGINT) AS total_expenses
{_CHAIN} LEFT JOIN financial_expenses fe ON re.id = fe.entry_id
GROUP BY a.city ORDER BY 2 DESC, a.city LIMIT 20""")
def geo_top_cities(t: Tables) -> DataFrame:
    # Distinct count and plain sum in one aggregate: fiscal rows are reduced
    # per entry first, so no Expand over the (identity × year) rows is needed.
    fe = child_stats(t["financial_expenses"], "entry_id", "expenses_to_eur", "fe")
    agg = (located(t, "city").join(fe, "entry_id", "left")
           .groupBy("city")
           .agg(F.countDistinct("entry_id").alias("organisations"),
                F.sum("fe_sum").alias("total_expenses")))
    return top_k(agg, 20, desc("organisations"), asc("city"))


@query("geo_home_vs_abroad", section=S, oracle=f"""
SELECT
 (SELECT COUNT(DISTINCT re.id) {_CHAIN} JOIN country_label cl ON a.country_id = cl.id WHERE cl.code = '{HOME}') AS home,
 (SELECT COUNT(DISTINCT re.id) {_CHAIN} JOIN country_label cl ON a.country_id = cl.id WHERE cl.code != '{HOME}') AS international""")
def geo_home_vs_abroad(t: Tables) -> DataFrame:
    # Both scalar subqueries in one pass over the joined rows.
    code = F.col("country_code")
    return located_country(t).agg(
        F.countDistinct(F.when(code == HOME, F.col("entry_id"))).alias("home"),
        F.countDistinct(F.when(code != HOME, F.col("entry_id"))).alias("international"))


@query("geo_capital_offices", section=S, oracle="""
SELECT count(*) AS capital_offices FROM lobbyist_identity WHERE capital_city_repr_id IS NOT NULL""")
def geo_capital_offices(t: Tables) -> DataFrame:
    return t["lobbyist_identity"].agg(
        F.count_if(F.col("capital_city_repr_id").isNotNull()).alias("capital_offices"))


@query("geo_city_avg_spend", section=S, cities=SEVEN_CITIES, oracle=f"""
SELECT a.city, AVG(fe.expenses_to_eur) AS avg_expenses
{_CHAIN} JOIN financial_expenses fe ON re.id = fe.entry_id
WHERE a.city IN ({sql_list(SEVEN_CITIES)})
GROUP BY a.city ORDER BY 2 DESC""")
def geo_city_avg_spend(t: Tables, cities=("Berlin", "München", "Hamburg", "Frankfurt am Main",
                                          "Düsseldorf", "Köln", "Stuttgart")) -> DataFrame:
    fe = t["financial_expenses"].select("entry_id", "expenses_to_eur")
    return (located(t, "city").filter(F.col("city").isin(list(cities)))
            .join(fe, "entry_id")
            .groupBy("city").agg(F.avg("expenses_to_eur").alias("avg_expenses"))
            .orderBy(desc("avg_expenses")))
