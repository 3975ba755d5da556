"""Market dashboard: everything filtered to a set of sectors (topic labels).

Two families of queries:

* distinct-entry questions (actors, laws, cities, legal forms, versions) —
  the sector filter is a LEFT SEMI join, so an entry's many topic rows never
  multiply the other side;
* sums over the fan-out (volume, top organisations, trend, detail) — the
  reference sums an entry's expenses once per matching topic row; that
  multiplicity is counted per entry and multiplied in, never materialised.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from civicflow.operators.fanout import child_stats, exact
from civicflow.operators.ordering import asc, desc, top_k
from civicflow.plans.common import (Tables, addresses, entries, entry_topics,
                                    identities, sector_entries, sql_list)
from civicflow.plans.registry import query

S = "market"
SECTORS = ["ECONOMY 0", "LARGE 1", "PROMO 2"]
_IN = sql_list(SECTORS)
_SECTOR_JOIN = """JOIN activities_interests ai ON re.id = ai.entry_id
JOIN field_of_interest foi ON ai.id = foi.activities_id
JOIN code_label cl ON foi.label_id = cl.id"""
UNKNOWN = "Unbekannt"


def in_sector(df: DataFrame, t: Tables, sectors) -> DataFrame:
    """Rows of ``df`` whose entry has at least one topic in ``sectors``."""
    return df.join(sector_entries(t, sectors).select("entry_id"), "entry_id", "left_semi")


def sector_multiplicity(t: Tables, sectors) -> DataFrame:
    """(entry_id, n): topic rows of the entry inside the selected sectors."""
    return (entries(t).join(sector_entries(t, sectors), "entry_id")
            .groupBy("entry_id").agg(F.count(F.lit(1)).alias("n")))


def _projects(t: Tables) -> DataFrame:
    rp = t["regulatory_projects"].select(F.col("id").alias("parent_id"), "entry_id")
    return t["regulatory_project_item"].select("parent_id", "title").join(rp, "parent_id")


@query("mkt_actors", section=S, sectors=SECTORS, oracle=f"""
SELECT COUNT(DISTINCT re.id) AS actors FROM register_entry re {_SECTOR_JOIN}
WHERE cl.de IN ({_IN})""")
def mkt_actors(t: Tables, sectors=()) -> DataFrame:
    return in_sector(entries(t), t, sectors).agg(F.count(F.lit(1)).alias("actors"))


@query("mkt_volume", section=S, sectors=SECTORS, oracle=f"""
SELECT CAST(SUM(fe.expenses_to_eur) AS DECIMAL(38, 0)) AS volume FROM register_entry re
JOIN financial_expenses fe ON re.id = fe.entry_id {_SECTOR_JOIN}
WHERE cl.de IN ({_IN})""")
def mkt_volume(t: Tables, sectors=()) -> DataFrame:
    fe = child_stats(t["financial_expenses"], "entry_id", "expenses_to_eur", "fe")
    return (sector_multiplicity(t, sectors).join(fe, "entry_id")
            .agg(F.sum(exact("n", "fe_sum")).alias("volume")))


@query("mkt_laws_count", section=S, sectors=SECTORS, oracle=f"""
SELECT COUNT(DISTINCT rpi.title) AS laws FROM register_entry re {_SECTOR_JOIN}
JOIN regulatory_projects rp ON re.id = rp.entry_id
JOIN regulatory_project_item rpi ON rp.id = rpi.parent_id
WHERE cl.de IN ({_IN})""")
def mkt_laws_count(t: Tables, sectors=()) -> DataFrame:
    return in_sector(_projects(t), t, sectors).agg(F.countDistinct("title").alias("laws"))


def _laws(t: Tables, sectors) -> DataFrame:
    return (in_sector(_projects(t), t, sectors)
            .groupBy("title").agg(F.countDistinct("entry_id").alias("lobbyists")))


@query("mkt_top_law", section=S, sectors=SECTORS, oracle=f"""
SELECT rpi.title, COUNT(DISTINCT re.id) AS hits FROM register_entry re {_SECTOR_JOIN}
JOIN regulatory_projects rp ON re.id = rp.entry_id
JOIN regulatory_project_item rpi ON rp.id = rpi.parent_id
WHERE cl.de IN ({_IN}) GROUP BY rpi.title ORDER BY hits DESC, rpi.title NULLS LAST LIMIT 1""")
def mkt_top_law(t: Tables, sectors=()) -> DataFrame:
    return top_k(_laws(t, sectors).withColumnRenamed("lobbyists", "hits"), 1,
                 desc("hits"), asc("title"))


@query("mkt_top_orgs", section=S, sectors=SECTORS, oracle=f"""
SELECT li.name_text AS organisation, CAST(SUM(fe.expenses_to_eur) AS DECIMAL(38, 0)) AS expenses FROM register_entry re
JOIN lobbyist_identity li ON re.id = li.entry_id
JOIN financial_expenses fe ON re.id = fe.entry_id {_SECTOR_JOIN}
WHERE cl.de IN ({_IN}) GROUP BY li.name_text ORDER BY 2 DESC NULLS FIRST, 1 LIMIT 15""")
def mkt_top_orgs(t: Tables, sectors=()) -> DataFrame:
    fe = child_stats(t["financial_expenses"], "entry_id", "expenses_to_eur", "fe")
    per_entry = (sector_multiplicity(t, sectors).join(fe, "entry_id")
                 .select("entry_id", exact("n", "fe_sum").alias("s")))
    agg = (per_entry.join(identities(t, "name_text"), "entry_id")
           .groupBy(F.col("name_text").alias("organisation"))
           .agg(F.sum("s").alias("expenses")))
    return top_k(agg, 15, desc("expenses"), asc("organisation"))


@query("mkt_legal_forms", section=S, sectors=SECTORS, oracle=f"""
SELECT COALESCE(li.legal_form_text, '{UNKNOWN}') AS legal_form, COUNT(DISTINCT re.id) AS n FROM register_entry re
JOIN lobbyist_identity li ON re.id = li.entry_id {_SECTOR_JOIN}
WHERE cl.de IN ({_IN}) GROUP BY li.legal_form_text ORDER BY 2 DESC, li.legal_form_text NULLS LAST LIMIT 10""")
def mkt_legal_forms(t: Tables, sectors=()) -> DataFrame:
    agg = (in_sector(entries(t).join(identities(t, "legal_form_text"), "entry_id"), t, sectors)
           .groupBy("legal_form_text").agg(F.countDistinct("entry_id").alias("n")))
    return (top_k(agg, 10, desc("n"), asc("legal_form_text"))
            .select(F.coalesce("legal_form_text", F.lit(UNKNOWN)).alias("legal_form"), "n"))


@query("mkt_trend", section=S, sectors=SECTORS, oracle=f"""
SELECT CAST(strptime(fe.fiscal_year_start_ym, '%Y-%m') AS DATE) AS time,
       CAST(SUM(fe.expenses_to_eur) AS DECIMAL(38, 0)) AS sector_expenses FROM register_entry re
JOIN financial_expenses fe ON re.id = fe.entry_id {_SECTOR_JOIN}
WHERE cl.de IN ({_IN}) GROUP BY fe.fiscal_year_start_ym ORDER BY 1""")
def mkt_trend(t: Tables, sectors=()) -> DataFrame:
    fe = child_stats(t["financial_expenses"], ["entry_id", "fiscal_year_start_ym"],
                     "expenses_to_eur", "fe")
    return (sector_multiplicity(t, sectors).join(fe, "entry_id")
            .groupBy("fiscal_year_start_ym")
            .agg(F.sum(exact("n", "fe_sum")).alias("sector_expenses"))
            .select(F.to_date(F.try_to_timestamp("fiscal_year_start_ym", F.lit("yyyy-MM")))
                    .alias("time"), "sector_expenses")
            .orderBy(asc("time")))


@query("mkt_interest_overlap", section=S, sectors=SECTORS, oracle=f"""
WITH sector_entries AS (
    SELECT re.id FROM register_entry re {_SECTOR_JOIN} WHERE cl.de IN ({_IN})
)
SELECT cl.de AS other_topic, COUNT(*) AS overlaps
FROM sector_entries se
JOIN activities_interests ai ON se.id = ai.entry_id
JOIN field_of_interest foi ON ai.id = foi.activities_id
JOIN code_label cl ON foi.label_id = cl.id
WHERE cl.de NOT IN ({_IN})
GROUP BY cl.de ORDER BY 2 DESC, 1 LIMIT 20""")
def mkt_interest_overlap(t: Tables, sectors=()) -> DataFrame:
    """Topic co-occurrence; the sector CTE is not de-duplicated, so an entry
    counts (its sector rows) × (its rows of the other topic) times."""
    # No selection means all sectors, and then no other topic is left.
    unselected = ~F.col("de").isin(list(sectors)) if sectors else F.lit(False)
    other = (entry_topics(t).filter(unselected)
             .groupBy("entry_id", "de").agg(F.count(F.lit(1)).alias("m")))
    agg = (sector_multiplicity(t, sectors).join(other, "entry_id")
           .groupBy(F.col("de").alias("other_topic"))
           .agg(F.sum(F.col("n") * F.col("m")).alias("overlaps")))
    return top_k(agg, 20, desc("overlaps"), asc("other_topic"))


@query("mkt_laws", section=S, sectors=SECTORS, oracle=f"""
SELECT rpi.title, COUNT(DISTINCT re.id) AS lobbyists FROM register_entry re {_SECTOR_JOIN}
JOIN regulatory_projects rp ON re.id = rp.entry_id
JOIN regulatory_project_item rpi ON rp.id = rpi.parent_id
WHERE cl.de IN ({_IN}) GROUP BY rpi.title ORDER BY 2 DESC, rpi.title NULLS LAST LIMIT 50""")
def mkt_laws(t: Tables, sectors=(), k: int = 50) -> DataFrame:
    return top_k(_laws(t, sectors), k, desc("lobbyists"), asc("title"))


@query("mkt_cities", section=S, sectors=SECTORS, oracle=f"""
SELECT a.city, COUNT(DISTINCT re.id) AS n FROM register_entry re
JOIN lobbyist_identity li ON re.id = li.entry_id
JOIN address a ON li.address_id = a.id {_SECTOR_JOIN}
WHERE cl.de IN ({_IN}) GROUP BY a.city ORDER BY 2 DESC, a.city NULLS LAST LIMIT 10""")
def mkt_cities(t: Tables, sectors=()) -> DataFrame:
    rows = (entries(t).join(identities(t, "address_id"), "entry_id")
            .join(addresses(t, "city"), "address_id"))
    agg = (in_sector(rows, t, sectors).groupBy("city")
           .agg(F.countDistinct("entry_id").alias("n")))
    return top_k(agg, 10, desc("n"), asc("city"))


@query("mkt_detail", section=S, sectors=SECTORS, oracle=f"""
SELECT li.name_text AS organisation, li.legal_form_text AS legal_form, a.city,
       CAST(SUM(fe.expenses_to_eur) AS DECIMAL(38, 0)) AS finances FROM register_entry re
JOIN lobbyist_identity li ON re.id = li.entry_id
JOIN address a ON li.address_id = a.id
JOIN financial_expenses fe ON re.id = fe.entry_id {_SECTOR_JOIN}
WHERE cl.de IN ({_IN}) GROUP BY li.name_text, li.legal_form_text, a.city
ORDER BY 4 DESC NULLS FIRST, 1 NULLS LAST, 2 NULLS LAST, 3 NULLS LAST LIMIT 100""")
def mkt_detail(t: Tables, sectors=()) -> DataFrame:
    fe = child_stats(t["financial_expenses"], "entry_id", "expenses_to_eur", "fe")
    per_entry = (sector_multiplicity(t, sectors).join(fe, "entry_id")
                 .select("entry_id", exact("n", "fe_sum").alias("s")))
    agg = (per_entry.join(identities(t, "name_text", "legal_form_text", "address_id"), "entry_id")
           .join(addresses(t, "city"), "address_id")
           .groupBy(F.col("name_text").alias("organisation"),
                    F.col("legal_form_text").alias("legal_form"), "city")
           .agg(F.sum("s").alias("finances")))
    return top_k(agg, 100, desc("finances"), asc("organisation"), asc("legal_form"), asc("city"))


@query("mkt_most_versions", section=S, sectors=SECTORS, oracle=f"""
SELECT li.name_text AS organisation, COUNT(DISTINCT arev.id) AS versions FROM register_entry re
JOIN lobbyist_identity li ON re.id = li.entry_id {_SECTOR_JOIN}
JOIN account_details ad ON re.id = ad.entry_id
JOIN account_register_entry_version arev ON ad.id = arev.account_id
WHERE cl.de IN ({_IN}) GROUP BY li.name_text ORDER BY 2 DESC, 1 NULLS LAST LIMIT 20""")
def mkt_most_versions(t: Tables, sectors=()) -> DataFrame:
    ad = t["account_details"].select(F.col("id").alias("account_id"), "entry_id")
    arev = t["account_register_entry_version"].select(F.col("id").alias("version_id"),
                                                      "account_id")
    per_entry = in_sector(arev.join(ad, "account_id"), t, sectors)
    agg = (per_entry.join(entries(t), "entry_id")
           .join(identities(t, "name_text"), "entry_id")
           .groupBy(F.col("name_text").alias("organisation"))
           .agg(F.countDistinct("version_id").alias("versions")))
    return top_k(agg, 20, desc("versions"), asc("organisation"))


@query("mkt_most_statements", section=S, sectors=SECTORS, oracle=f"""
SELECT li.name_text AS organisation, s.statements_count FROM register_entry re
JOIN lobbyist_identity li ON re.id = li.entry_id {_SECTOR_JOIN}
JOIN statements s ON re.id = s.entry_id
WHERE cl.de IN ({_IN}) AND s.statements_count > 0
GROUP BY li.name_text, s.statements_count ORDER BY 2 DESC NULLS FIRST, 1 NULLS LAST LIMIT 20""")
def mkt_most_statements(t: Tables, sectors=()) -> DataFrame:
    s = (t["statements"].filter(F.col("statements_count") > 0)
         .select("entry_id", "statements_count"))
    rows = (in_sector(entries(t).join(s, "entry_id"), t, sectors)
            .join(identities(t, "name_text"), "entry_id")
            .select(F.col("name_text").alias("organisation"), "statements_count")
            .distinct())
    return top_k(rows, 20, desc("statements_count"), asc("organisation"))


REFUSED_FINANCE = "Finanzen"
REFUSED_DONORS = "Spender"


@query("mkt_refusers", section=S, sectors=SECTORS, oracle=f"""
SELECT li.name_text AS organisation,
       CASE WHEN fe.refuse_info THEN '{REFUSED_FINANCE}' ELSE '' END AS refuses_finance,
       CASE WHEN d.refuse_info THEN '{REFUSED_DONORS}' ELSE '' END AS refuses_donors
FROM register_entry re
JOIN lobbyist_identity li ON re.id = li.entry_id {_SECTOR_JOIN}
LEFT JOIN financial_expenses fe ON re.id = fe.entry_id
LEFT JOIN donators d ON re.id = d.entry_id
WHERE cl.de IN ({_IN}) AND (fe.refuse_info = true OR d.refuse_info = true)
GROUP BY li.name_text, fe.refuse_info, d.refuse_info
ORDER BY li.name_text NULLS LAST, fe.refuse_info NULLS LAST, d.refuse_info NULLS LAST LIMIT 20""")
def mkt_refusers(t: Tables, sectors=()) -> DataFrame:
    fe = t["financial_expenses"].select("entry_id", F.col("refuse_info").alias("fe_refuse"))
    d = t["donators"].select("entry_id", F.col("refuse_info").alias("d_refuse"))
    rows = (in_sector(entries(t), t, sectors)
            .join(identities(t, "name_text"), "entry_id")
            .join(fe, "entry_id", "left").join(d, "entry_id", "left")
            .filter((F.col("fe_refuse") == F.lit(True)) | (F.col("d_refuse") == F.lit(True)))
            .select("name_text", "fe_refuse", "d_refuse").distinct())
    # The reference has no ORDER BY; a total order on the group key makes the
    # 20 survivors well defined.
    return (top_k(rows, 20, asc("name_text"), asc("fe_refuse"), asc("d_refuse"))
            .select(F.col("name_text").alias("organisation"),
                    F.when(F.col("fe_refuse"), F.lit(REFUSED_FINANCE)).otherwise(F.lit(""))
                    .alias("refuses_finance"),
                    F.when(F.col("d_refuse"), F.lit(REFUSED_DONORS)).otherwise(F.lit(""))
                    .alias("refuses_donors")))
