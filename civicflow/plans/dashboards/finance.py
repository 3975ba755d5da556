"""Finance-watch dashboard: allowances, contractors, revolving door, money mix."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from civicflow.operators.ordering import asc, desc, top_k
from civicflow.plans.common import Tables, entries, identities, labels
from civicflow.plans.registry import query

S = "finance"
UNKNOWN = "Unbekannt"

_GOV_FILTER = """rgf.id IN (SELECT recent_gov_function_id FROM lobbyist_identity WHERE recent_gov_function_present = true)
   OR rgf.id IN (SELECT recent_gov_function_id FROM entrusted_person WHERE recent_gov_function_present = true)"""


@query("fin_top_allowance_receivers", section=S, oracle="""
SELECT li.name_text AS receiver, CAST(SUM(pa.amount_to_eur) AS BIGINT) AS allowances_max
FROM public_allowance_item pa
JOIN public_allowances pas ON pa.parent_id = pas.id
JOIN register_entry re ON pas.entry_id = re.id
JOIN lobbyist_identity li ON re.id = li.entry_id
GROUP BY li.name_text ORDER BY 2 DESC NULLS FIRST, 1 LIMIT 20""")
def fin_top_allowance_receivers(t: Tables) -> DataFrame:
    # Reduce the items per entry first: one row per entry reaches the join.
    pas = t["public_allowances"].select(F.col("id").alias("parent_id"), "entry_id")
    per_entry = (t["public_allowance_item"].select("parent_id", "amount_to_eur")
                 .join(pas, "parent_id")
                 .groupBy("entry_id").agg(F.sum("amount_to_eur").alias("s")))
    agg = (per_entry.join(entries(t), "entry_id")
           .join(identities(t, "name_text"), "entry_id")
           .groupBy(F.col("name_text").alias("receiver"))
           .agg(F.sum("s").alias("allowances_max")))
    return top_k(agg, 20, desc("allowances_max"), asc("receiver"))


@query("fin_top_contractors", section=S, oracle=f"""
SELECT COALESCE(co.name, co.reference_name, '{UNKNOWN}') AS contractor, COUNT(ci.id) AS contracts
FROM contract_item ci
JOIN contract_contractors cc ON ci.id = cc.contract_item_id
JOIN contractor_org co ON cc.id = co.contractors_id
GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 20""")
def fin_top_contractors(t: Tables) -> DataFrame:
    ci = t["contract_item"].select(F.col("id").alias("contract_item_id"))
    cc = t["contract_contractors"].select(F.col("id").alias("contractors_id"), "contract_item_id")
    co = t["contractor_org"].select("contractors_id", "name", "reference_name")
    agg = (co.join(cc, "contractors_id").join(ci, "contract_item_id")
           .groupBy(F.coalesce("name", "reference_name", F.lit(UNKNOWN)).alias("contractor"))
           .agg(F.count("contract_item_id").alias("contracts")))
    return top_k(agg, 20, desc("contracts"), asc("contractor"))


def gov_functions_held(t: Tables) -> DataFrame:
    """Government functions held by a lobbyist OR an entrusted person.

    ``id IN (a) OR id IN (b)`` is one semi join against the union of both id
    lists — no ExistenceJoin pair, no de-duplication needed.
    """
    li = (t["lobbyist_identity"].filter(F.col("recent_gov_function_present") == F.lit(True))
          .select(F.col("recent_gov_function_id").alias("id")))
    ep = (t["entrusted_person"].filter(F.col("recent_gov_function_present") == F.lit(True))
          .select(F.col("recent_gov_function_id").alias("id")))
    return t["recent_government_function"].join(li.unionByName(ep), "id", "left_semi")


@query("fin_revolving_origin", section=S, oracle=f"""
SELECT COALESCE(cl.de, '{UNKNOWN}') AS gov_function, COUNT(*) AS switchers
FROM recent_government_function rgf LEFT JOIN code_label cl ON rgf.type_label_id = cl.id
WHERE {_GOV_FILTER}
GROUP BY cl.de ORDER BY 2 DESC, cl.de NULLS LAST LIMIT 15""")
def fin_revolving_origin(t: Tables) -> DataFrame:
    agg = (gov_functions_held(t).select(F.col("type_label_id").alias("label_id"))
           .join(labels(t), "label_id", "left")
           .groupBy("de").agg(F.count(F.lit(1)).alias("switchers")))
    return (top_k(agg, 15, desc("switchers"), asc("de"))
            .select(F.coalesce("de", F.lit(UNKNOWN)).alias("gov_function"), "switchers"))


@query("fin_ministry_ranking", section=S, oracle=f"""
SELECT dept.title AS ministry, COUNT(*) AS former_staff
FROM recent_government_function rgf
JOIN recent_gov_federal_gov rbfg ON rgf.id = rbfg.recent_gov_fn_id
JOIN department dept ON rbfg.department_id = dept.id
WHERE {_GOV_FILTER}
GROUP BY dept.title ORDER BY 2 DESC, 1 LIMIT 20""")
def fin_ministry_ranking(t: Tables) -> DataFrame:
    fg = t["recent_gov_federal_gov"].select(F.col("recent_gov_fn_id").alias("id"),
                                            F.col("department_id").alias("dept_id"))
    dept = t["department"].select(F.col("id").alias("dept_id"), F.col("title").alias("ministry"))
    agg = (gov_functions_held(t).select("id").join(fg, "id").join(dept, "dept_id")
           .groupBy("ministry").agg(F.count(F.lit(1)).alias("former_staff")))
    return top_k(agg, 20, desc("former_staff"), asc("ministry"))


MIX_DONATIONS = "Schenkungen"
MIX_FEES = "Mitgliedsbeiträge"
MIX_ALLOWANCES = "Staatliche Zuwendungen"


@query("fin_mix", section=S, oracle=f"""
SELECT '{MIX_DONATIONS}' AS source, CAST(SUM(total_to_eur) AS BIGINT) AS amount FROM donators WHERE info_present = true
UNION ALL SELECT '{MIX_FEES}', CAST(SUM(total_to_eur) AS BIGINT) FROM membership_fees WHERE related_year_finished = true
UNION ALL SELECT '{MIX_ALLOWANCES}', CAST(SUM(amount_to_eur) AS BIGINT) FROM public_allowance_item""")
def fin_mix(t: Tables) -> DataFrame:
    def labelled(df: DataFrame, label: str, col: str) -> DataFrame:
        return df.agg(F.sum(col).alias("amount")).select(F.lit(label).alias("source"), "amount")
    return (labelled(t["donators"].filter(F.col("info_present") == F.lit(True)), MIX_DONATIONS,
                     "total_to_eur")
            .unionByName(labelled(t["membership_fees"]
                                  .filter(F.col("related_year_finished") == F.lit(True)),
                                  MIX_FEES, "total_to_eur"))
            .unionByName(labelled(t["public_allowance_item"], MIX_ALLOWANCES, "amount_to_eur")))


@query("fin_top_donors", section=S, oracle="""
SELECT name, CAST(SUM(amount_to_eur) AS BIGINT) AS total FROM donator_item
GROUP BY name ORDER BY 2 DESC NULLS FIRST, 1 LIMIT 20""")
def fin_top_donors(t: Tables) -> DataFrame:
    agg = t["donator_item"].groupBy("name").agg(F.sum("amount_to_eur").alias("total"))
    return top_k(agg, 20, desc("total"), asc("name"))


@query("fin_allowance_sources", section=S, oracle="""
SELECT name, CAST(SUM(amount_to_eur) AS BIGINT) AS total FROM public_allowance_item
GROUP BY name ORDER BY 2 DESC NULLS FIRST, 1 LIMIT 20""")
def fin_allowance_sources(t: Tables) -> DataFrame:
    agg = t["public_allowance_item"].groupBy("name").agg(F.sum("amount_to_eur").alias("total"))
    return top_k(agg, 20, desc("total"), asc("name"))
