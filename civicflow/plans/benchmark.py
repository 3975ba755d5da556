"""The six benchmark queries and the MV-based heatmap variant.

Ties in ORDER BY … LIMIT are broken on every output column (PostgreSQL
leaves them open), so the surviving rows are well defined.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from civicflow.operators.fanout import child_stats, exact
from civicflow.operators.ordering import asc, desc, top_k
from civicflow.plans.common import Tables, entries, entry_topics, identities
from civicflow.plans.registry import query

SEARCH_TERM = "0000001"


@query("bm_heatmap", section="benchmark", oracle="""
SELECT cl.de AS thema, COUNT(*) AS anzahl, CAST(SUM(fe.expenses_to_eur) AS DECIMAL(38, 0)) AS total_eur
FROM register_entry re
JOIN financial_expenses fe ON re.id = fe.entry_id
JOIN activities_interests ai ON re.id = ai.entry_id
JOIN field_of_interest foi ON ai.id = foi.activities_id
JOIN code_label cl ON foi.label_id = cl.id
GROUP BY cl.de
ORDER BY total_eur DESC NULLS FIRST, thema ASC NULLS LAST
LIMIT 20""")
def bm_heatmap(t: Tables) -> DataFrame:
    """Per topic COUNT(*) and SUM(expenses) over entry × years × topics.

    Topic rows are counted per (entry, topic), fiscal rows reduced per entry;
    COUNT(*) = Σ n·rows and SUM = Σ n·sum reproduce the 5-way join exactly.
    """
    topics = (entries(t).join(entry_topics(t), "entry_id")
              .groupBy("entry_id", "de").agg(F.count(F.lit(1)).alias("n")))
    fe = child_stats(t["financial_expenses"], "entry_id", "expenses_to_eur", "fe")
    agg = (topics.join(fe, "entry_id")
           .groupBy(F.col("de").alias("thema"))
           .agg(F.sum(F.col("n") * F.col("fe_rows")).alias("anzahl"),
                F.sum(exact("n", "fe_sum")).alias("total_eur")))
    return top_k(agg, 20, desc("total_eur"), asc("thema"))


@query("bm_top_lobbyists", section="benchmark", oracle="""
SELECT li.name_text, li.company_name, fe.expenses_to_eur
FROM register_entry re
JOIN lobbyist_identity li ON re.id = li.entry_id
JOIN financial_expenses fe ON re.id = fe.entry_id
WHERE fe.expenses_to_eur IS NOT NULL
ORDER BY fe.expenses_to_eur DESC NULLS FIRST, li.name_text ASC NULLS LAST, li.company_name ASC NULLS LAST
LIMIT 50""")
def bm_top_lobbyists(t: Tables) -> DataFrame:
    fe = (t["financial_expenses"].filter(F.col("expenses_to_eur").isNotNull())
          .select("entry_id", "expenses_to_eur"))
    rows = (entries(t).join(identities(t, "name_text", "company_name"), "entry_id")
            .join(fe, "entry_id")
            .select("name_text", "company_name", "expenses_to_eur"))
    return top_k(rows, 50, desc("expenses_to_eur"), asc("name_text"), asc("company_name"))


@query("bm_revolving_door", section="benchmark", oracle="""
SELECT li.last_name, li.first_name, rgf.end_year_month
FROM lobbyist_identity li
JOIN recent_government_function rgf ON li.recent_gov_function_id = rgf.id
WHERE rgf.ended = true
ORDER BY rgf.end_year_month DESC NULLS FIRST""")
def bm_revolving_door(t: Tables) -> DataFrame:
    rgf = (t["recent_government_function"].filter(F.col("ended") == F.lit(True))
           .select(F.col("id").alias("recent_gov_function_id"), "end_year_month"))
    return (t["lobbyist_identity"].select("last_name", "first_name", "recent_gov_function_id")
            .join(rgf, "recent_gov_function_id")
            .select("last_name", "first_name", "end_year_month")
            .orderBy(desc("end_year_month")))


@query("bm_clients", section="benchmark", oracle="""
SELECT re.register_number, co.name AS client_name, co.legal_form_text
FROM register_entry re
JOIN client_identity ci ON re.id = ci.entry_id
JOIN client_org co ON ci.id = co.client_identity_id
WHERE ci.clients_present = true
ORDER BY re.register_number, client_name, co.legal_form_text
LIMIT 1000""")
def bm_clients(t: Tables) -> DataFrame:
    ci = (t["client_identity"].filter(F.col("clients_present") == F.lit(True))
          .select(F.col("id").alias("client_identity_id"), "entry_id"))
    co = t["client_org"].select("client_identity_id", F.col("name").alias("client_name"),
                                "legal_form_text")
    # Every entry with a client gives a row at least, so the 1000 rows are those of the 1000
    # least such entries (a bounded list), found on keys alone; only their clients are joined.
    first = top_k(entries(t).join(ci.join(co, "client_identity_id", "left_semi"), "entry_id", "left_semi"),
                  1000, asc("register_number"))
    rows = ci.join(F.broadcast(first), "entry_id").join(co, "client_identity_id").select(
        "register_number", "client_name", "legal_form_text")
    # The reference takes any 1000 rows; a total order makes the result testable.
    return top_k(rows, 1000, asc("register_number"), asc("client_name"), asc("legal_form_text"))


def _ilike_contains(col: str, term: str):
    """``col ILIKE '%term%'`` with LIKE wildcards in ``term`` escaped."""
    esc = term.replace("\\", "\\\\").replace("%", "\\%").replace("_", "\\_")
    return F.col(col).ilike(f"%{esc}%")


@query("bm_text_search", section="benchmark", term=SEARCH_TERM, oracle=f"""
SELECT name_text, identity FROM lobbyist_identity
WHERE name_text ILIKE '%{SEARCH_TERM}%'
ORDER BY name_text, identity
LIMIT 100""")
def bm_text_search(t: Tables, term: str = "Energy") -> DataFrame:
    rows = t["lobbyist_identity"].filter(_ilike_contains("name_text", term)) \
        .select("name_text", "identity")
    return top_k(rows, 100, asc("name_text"), asc("identity"))


@query("bm_revolving_mv", section="benchmark", oracle="""
SELECT organization_name, last_name, gov_function_type
FROM mv_revolving_door_network
WHERE end_year_month > '2020-01'
ORDER BY end_year_month DESC NULLS FIRST, organization_name, last_name, gov_function_type
LIMIT 500""", since="2020-01")
def bm_revolving_mv(t: Tables, since: str = "2020-01") -> DataFrame:
    mv = t["mv_revolving_door_network"].filter(F.col("end_year_month") > F.lit(since))
    return top_k(mv, 500, desc("end_year_month"), asc("organization_name"), asc("last_name"),
                 asc("gov_function_type")).select("organization_name", "last_name",
                                                  "gov_function_type")


@query("bm_heatmap_optimized", section="benchmark", oracle="""
SELECT field_of_interest, total_spend_max FROM mv_financial_tops
ORDER BY total_spend_max DESC NULLS FIRST, field_of_interest
LIMIT 20""")
def bm_heatmap_optimized(t: Tables) -> DataFrame:
    mv = t["mv_financial_tops"].select("field_of_interest", "total_spend_max")
    return top_k(mv, 20, desc("total_spend_max"), asc("field_of_interest"))
