"""Overview dashboard: register-wide counts, shares and time series."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from civicflow.operators.ordering import asc, desc, top_k
from civicflow.plans.common import Tables, entries, identities
from civicflow.plans.registry import query

S = "overview"


def _count_value(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).cast("double").alias("value"))


@query("ov_total_entries", section=S, oracle="""
SELECT CAST(count(*) AS DOUBLE) AS value FROM register_entry""")
def ov_total_entries(t: Tables) -> DataFrame:
    return _count_value(t["register_entry"].select("id"))


@query("ov_active_accounts", section=S, oracle="""
SELECT CAST(count(*) AS DOUBLE) AS value FROM account_details WHERE active_lobbyist""")
def ov_active_accounts(t: Tables) -> DataFrame:
    return t["account_details"].agg(F.count_if(F.col("active_lobbyist")).cast("double").alias("value"))


@query("ov_codex_flagged", section=S, oracle="""
SELECT CAST(count(*) AS DOUBLE) AS value FROM account_details WHERE account_has_codex_violations""")
def ov_codex_flagged(t: Tables) -> DataFrame:
    return t["account_details"].agg(
        F.count_if(F.col("account_has_codex_violations")).cast("double").alias("value"))


@query("ov_total_fte", section=S, oracle="""
SELECT CAST(SUM(employee_fte) AS DECIMAL(38,4)) AS fte_total
FROM employees_involved WHERE related_year_finished = true""")
def ov_total_fte(t: Tables) -> DataFrame:
    return (t["employees_involved"].filter(F.col("related_year_finished") == F.lit(True))
            .agg(F.sum("employee_fte").cast("decimal(38,4)").alias("fte_total")))


@query("ov_operation_type", section=S, oracle="""
SELECT code AS operation_type, count(*) AS n
FROM activities_interests ai JOIN activity_operation_type aot ON ai.activity_operation_type = aot.code
GROUP BY code""")
def ov_operation_type(t: Tables) -> DataFrame:
    # Partial aggregation first, then the 3-row enum join (drops unknown codes).
    aot = t["activity_operation_type"].select(F.col("code").alias("operation_type"))
    counts = (t["activities_interests"]
              .groupBy(F.col("activity_operation_type").alias("operation_type"))
              .agg(F.count(F.lit(1)).alias("n")))
    return counts.join(aot, "operation_type").select("operation_type", "n")


IDENTITY_NATURAL = "Natürliche Personen"
IDENTITY_UNKNOWN_FORM = "Unbekannte Rechtsform"
IDENTITY_OTHER = "Sonstige Organisationen"


@query("ov_identity_type", section=S, oracle=f"""
SELECT CASE WHEN li.identity = 'NATURAL' THEN '{IDENTITY_NATURAL}'
            WHEN li.legal_form_type_label_id IS NOT NULL THEN COALESCE(cl.de, '{IDENTITY_UNKNOWN_FORM}')
            ELSE '{IDENTITY_OTHER}' END AS identity_type,
       CAST(count(*) AS DOUBLE) AS lobbyists
FROM lobbyist_identity li LEFT JOIN code_label cl ON li.legal_form_type_label_id = cl.id
GROUP BY 1 ORDER BY lobbyists DESC""")
def ov_identity_type(t: Tables) -> DataFrame:
    cl = t["code_label"].select(F.col("id").alias("legal_form_type_label_id"), "de")
    kind = (F.when(F.col("identity") == "NATURAL", F.lit(IDENTITY_NATURAL))
            .when(F.col("legal_form_type_label_id").isNotNull(),
                  F.coalesce(F.col("de"), F.lit(IDENTITY_UNKNOWN_FORM)))
            .otherwise(F.lit(IDENTITY_OTHER)))
    return (t["lobbyist_identity"].select("identity", "legal_form_type_label_id")
            .join(cl, "legal_form_type_label_id", "left")
            .groupBy(kind.alias("identity_type"))
            .agg(F.count(F.lit(1)).cast("double").alias("lobbyists"))
            .orderBy(desc("lobbyists")))


@query("ov_accounts_by_month", section=S, oracle="""
SELECT date_trunc('month', first_publication_date) AS time, CAST(count(*) AS DOUBLE) AS accounts
FROM account_details GROUP BY 1 ORDER BY 1""")
def ov_accounts_by_month(t: Tables) -> DataFrame:
    # Calendar-month buckets of the publication timestamp.
    month = F.date_trunc("month", F.col("first_publication_date"))
    month = month.cast(t["account_details"].schema["first_publication_date"].dataType)
    return (t["account_details"].groupBy(month.alias("time"))
            .agg(F.count(F.lit(1)).cast("double").alias("accounts"))
            .orderBy(asc("time")))


@query("ov_top_fields", section=S, oracle="""
SELECT COALESCE(cl.de, cl.en, foi.field_of_interest_text, 'Unspecified') AS field_label,
       CAST(count(*) AS DOUBLE) AS mentions
FROM field_of_interest foi
JOIN activities_interests ai ON ai.id = foi.activities_id
LEFT JOIN code_label cl ON cl.id = foi.label_id
GROUP BY field_label ORDER BY mentions DESC NULLS FIRST, field_label LIMIT 10""")
def ov_top_fields(t: Tables) -> DataFrame:
    cl = t["code_label"].select(F.col("id").alias("label_id"), "de", "en")
    ai = t["activities_interests"].select(F.col("id").alias("activities_id"))
    label = F.coalesce("de", "en", "field_of_interest_text", F.lit("Unspecified"))
    agg = (t["field_of_interest"].select("activities_id", "label_id", "field_of_interest_text")
           .join(ai, "activities_id")
           .join(cl, "label_id", "left")
           .groupBy(label.alias("field_label"))
           .agg(F.count(F.lit(1)).cast("double").alias("mentions")))
    return top_k(agg, 10, desc("mentions"), asc("field_label"))


@query("ov_client_landscape", section=S, oracle="""
SELECT metric, value FROM (
  SELECT 'Entries with listed clients' AS metric, CAST(count(*) AS DOUBLE) AS value FROM client_identity WHERE clients_present
  UNION ALL SELECT 'Total client organisations', CAST(count(*) AS DOUBLE) FROM client_org
  UNION ALL SELECT 'Total client persons', CAST(count(*) AS DOUBLE) FROM client_person
  UNION ALL SELECT 'Average clients per entry', CAST(AVG(COALESCE(clients_count, 0)) AS DOUBLE) FROM client_identity
) metrics ORDER BY metric""")
def ov_client_landscape(t: Tables) -> DataFrame:
    ci = t["client_identity"].agg(
        F.count_if(F.col("clients_present")).cast("double").alias("Entries with listed clients"),
        F.avg(F.coalesce(F.col("clients_count"), F.lit(0))).cast("double")
        .alias("Average clients per entry"))
    # The two other counts are scalar subqueries: evaluated once, inlined.
    orgs = t["client_org"].agg(F.count(F.lit(1)).cast("double")).scalar()
    persons = t["client_person"].agg(F.count(F.lit(1)).cast("double")).scalar()
    one = ci.select("*", orgs.alias("Total client organisations"),
                    persons.alias("Total client persons"))
    return (one.select(F.expr(
        "stack(4, 'Entries with listed clients', `Entries with listed clients`, "
        "'Total client organisations', `Total client organisations`, "
        "'Total client persons', `Total client persons`, "
        "'Average clients per entry', `Average clients per entry`) AS (metric, value)"))
        .orderBy(asc("metric")))


@query("ov_statements_per_year", section=S, oracle="""
SELECT CAST(EXTRACT(YEAR FROM sending_date) AS INTEGER) AS year, CAST(count(*) AS DOUBLE) AS statements
FROM statement_item WHERE sending_date IS NOT NULL GROUP BY year ORDER BY year""")
def ov_statements_per_year(t: Tables) -> DataFrame:
    return (t["statement_item"].filter(F.col("sending_date").isNotNull())
            .groupBy(F.year("sending_date").cast("int").alias("year"))
            .agg(F.count(F.lit(1)).cast("double").alias("statements"))
            .orderBy(asc("year")))


@query("ov_largest_expenses", section=S, oracle="""
SELECT COALESCE(li.name_text, li.company_name, re.register_number) AS organisation,
       strftime(fe.related_year_start, '%Y') AS year_start,
       strftime(fe.related_year_end, '%Y') AS year_end,
       COALESCE(fe.expenses_from_eur, 0) AS expenses_min,
       COALESCE(fe.expenses_to_eur, fe.expenses_from_eur, 0) AS expenses_max,
       CAST((COALESCE(fe.expenses_from_eur, fe.expenses_to_eur, 0) + COALESCE(fe.expenses_to_eur, fe.expenses_from_eur, 0)) / 2.0 AS DOUBLE) AS estimate
FROM financial_expenses fe
JOIN register_entry re ON re.id = fe.entry_id
LEFT JOIN lobbyist_identity li ON re.id = li.entry_id
WHERE fe.expenses_from_eur IS NOT NULL OR fe.expenses_to_eur IS NOT NULL
ORDER BY COALESCE(fe.expenses_to_eur, fe.expenses_from_eur, 0) DESC, organisation, year_start, year_end, expenses_min
LIMIT 20""")
def ov_largest_expenses(t: Tables) -> DataFrame:
    lo, hi = F.col("expenses_from_eur"), F.col("expenses_to_eur")
    fe = (t["financial_expenses"].filter(lo.isNotNull() | hi.isNotNull())
          .select("entry_id", "related_year_start", "related_year_end", lo, hi))
    li = identities(t, "name_text", "company_name").drop("identity_id")
    rows = (fe.join(entries(t), "entry_id").join(li, "entry_id", "left")
            .select(F.coalesce("name_text", "company_name", "register_number").alias("organisation"),
                    F.date_format("related_year_start", "yyyy").alias("year_start"),
                    F.date_format("related_year_end", "yyyy").alias("year_end"),
                    F.coalesce(lo, F.lit(0)).alias("expenses_min"),
                    F.coalesce(hi, lo, F.lit(0)).alias("expenses_max"),
                    ((F.coalesce(lo, hi, F.lit(0)) + F.coalesce(hi, lo, F.lit(0))) / F.lit(2.0))
                    .cast("double").alias("estimate")))
    return top_k(rows, 20, desc("expenses_max"), asc("organisation"), asc("year_start"),
                 asc("year_end"), asc("expenses_min"))
