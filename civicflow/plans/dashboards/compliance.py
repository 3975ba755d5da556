"""Compliance dashboard: code-of-conduct violations and refusals."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from civicflow.operators.ordering import asc, desc, top_k
from civicflow.plans.common import Tables, entries, identities
from civicflow.plans.registry import query

S = "compliance"


@query("cmp_violations", section=S, oracle="""
SELECT COUNT(*) AS violations FROM account_details ad
JOIN codex_violation cv ON ad.id = cv.account_id WHERE ad.account_has_codex_violations = true""")
def cmp_violations(t: Tables) -> DataFrame:
    ad = (t["account_details"].filter(F.col("account_has_codex_violations") == F.lit(True))
          .select(F.col("id").alias("account_id")))
    return (t["codex_violation"].select("account_id").join(ad, "account_id")
            .agg(F.count(F.lit(1)).alias("violations")))


def _flag_count(df: DataFrame, flag: str, alias: str) -> DataFrame:
    return df.agg(F.count_if(F.col(flag) == F.lit(True)).alias(alias))


@query("cmp_refused_reports", section=S, oracle="""
SELECT count(*) AS refused_reports FROM annual_reports WHERE refuse_annual_fin_stmt = true""")
def cmp_refused_reports(t: Tables) -> DataFrame:
    return _flag_count(t["annual_reports"], "refuse_annual_fin_stmt", "refused_reports")


@query("cmp_refused_donors", section=S, oracle="""
SELECT COUNT(*) AS refused_donors FROM donators WHERE refuse_info = true""")
def cmp_refused_donors(t: Tables) -> DataFrame:
    return _flag_count(t["donators"], "refuse_info", "refused_donors")


@query("cmp_refused_finance", section=S, oracle="""
SELECT COUNT(*) AS refused_finance FROM financial_expenses WHERE refuse_info = true""")
def cmp_refused_finance(t: Tables) -> DataFrame:
    return _flag_count(t["financial_expenses"], "refuse_info", "refused_finance")


@query("cmp_missing_reasons", section=S, oracle="""
SELECT missing_annual_report_reason AS reason, count(*) AS n FROM annual_reports
WHERE missing_annual_report_reason IS NOT NULL GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 50""")
def cmp_missing_reasons(t: Tables) -> DataFrame:
    agg = (t["annual_reports"].filter(F.col("missing_annual_report_reason").isNotNull())
           .groupBy(F.col("missing_annual_report_reason").alias("reason"))
           .agg(F.count(F.lit(1)).alias("n")))
    return top_k(agg, 50, desc("n"), asc("reason"))


@query("cmp_refuser_list", section=S, oracle="""
SELECT li.name_text AS organisation, fe.refuse_reason AS reason_finance, d.refuse_reason AS reason_donors
FROM register_entry re
JOIN lobbyist_identity li ON re.id = li.entry_id
LEFT JOIN financial_expenses fe ON re.id = fe.entry_id
LEFT JOIN donators d ON re.id = d.entry_id
WHERE (fe.refuse_info = true OR d.refuse_info = true)
ORDER BY li.name_text, reason_finance, reason_donors LIMIT 100""")
def cmp_refuser_list(t: Tables) -> DataFrame:
    fe = t["financial_expenses"].select("entry_id", F.col("refuse_info").alias("fe_refuse"),
                                        F.col("refuse_reason").alias("reason_finance"))
    d = t["donators"].select("entry_id", F.col("refuse_info").alias("d_refuse"),
                             F.col("refuse_reason").alias("reason_donors"))
    # NULL flags: "NULL OR true" is true, "NULL OR false" is NULL → dropped.
    rows = (entries(t).join(identities(t, "name_text"), "entry_id")
            .join(fe, "entry_id", "left").join(d, "entry_id", "left")
            .filter((F.col("fe_refuse") == F.lit(True)) | (F.col("d_refuse") == F.lit(True)))
            .select(F.col("name_text").alias("organisation"), "reason_finance", "reason_donors"))
    return top_k(rows, 100, asc("organisation"), asc("reason_finance"), asc("reason_donors"))
