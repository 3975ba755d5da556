"""Ingest round trip as registered queries (SRC-1 … SRC-7, FLT-*, NRM-*).

The register tables derived from the driver's data are nested into entry
documents, cut into pages in which every entry appears twice, and sent
through the whole ingest path: read pages → extract → merge metadata →
de-duplicate → flatten → quarantine → label dimensions.  Each query
projects one ingested table onto its natural columns (register number,
ordinal, values); the oracle computes the same projection straight from the
register tables, so equality proves the round trip.
"""

from __future__ import annotations

import re
import threading

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from civicflow.functions import normalize as N
from civicflow.operators.flatten import ENTRY
from civicflow.plans.common import Tables
from civicflow.plans.registry import query
from civicflow.sources import buckets
from civicflow.sources import pages as P
from civicflow.sources.chain import page_chain
from civicflow.sources.deltas import maintained_views, refresh_changed
from civicflow.sources.fixtures import shared_views
from civicflow.sources.nest import nest_documents, pages_text
from civicflow.session import shared_path
from civicflow.operators.flatten import flatten_entries
from civicflow.sources.store import (ENTRY_ROWS, PAGE_ROWS, cut, dealt, entry_rejects, ingest_to, placed_rejects, stage,
                                     upsert_entries)

S = "ingest"
SOURCE = "register-fixture"
_memo: dict[int, tuple] = {}
_lock = threading.Lock()


def ingested(t: Tables):
    """(tables, entries, pages) of the round trip, built once per table set."""
    key = id(t)
    with _lock:
        return (_memo[key] if key in _memo else _build(t, key))[:3]


def _build(t: Tables, key: int):
    if key not in _memo:
        # The pages read the documents four times (twice for the total); the joins behind them run once.
        docs = stage(nest_documents(shared_views(t, stage), SOURCE), "documents", ENTRY_ROWS)
        # Pages stay text: parsed, a row would be a hundred documents of some thousand columns.
        text = stage(pages_text(docs, copies=2), "pages", PAGE_ROWS)
        pages = P.pages_from_text(text, keys=True)
        found = P.merge_page_metadata(P.extract_entries(P.pages_from_text(text)))
        entries = stage(P.dedupe_entries(found, P.extract_entries(pages, keys=True)), "entries", ENTRY_ROWS)
        spark = entries.sparkSession
        tables, _ = ingest_to(entries, shared_path(spark, "ingest", unique=True), staged=True)
        # The table set is kept with its entry, so its id is never used again.
        _memo[key] = (tables, entries, pages, t)
    return _memo[key]


def _numbered(t: Tables, table: str) -> DataFrame:
    tables = ingested(t)[0]
    return tables[table].withColumnRenamed(ENTRY, "register_number")


@query("src_dedupe", section=S, oracle=f"""
SELECT register_number, '{SOURCE}' AS source FROM register_entry""")
def src_dedupe(t: Tables) -> DataFrame:
    """Every entry is landed twice; one survives per register number."""
    entries = ingested(t)[1]
    return entries.select(F.col(ENTRY).alias("register_number"), F.col("e.source").alias("source"))


@query("flt_register_entry", section=S, oracle=f"""
SELECT register_number, '{SOURCE}' AS source, TIMESTAMP '2025-01-01 00:00:00' AS source_date
FROM register_entry""")
def flt_register_entry(t: Tables) -> DataFrame:
    return ingested(t)[0]["register_entry"].select(
        "register_number", "source", F.col("source_date").cast("timestamp_ntz").alias("source_date"))


@query("flt_identity", section=S, oracle="""
SELECT re.register_number, li.identity, li.last_name, li.first_name, li.name_text, li.company_name,
       li.recent_gov_function_present, li.legal_form_text, a.city, a.zip_code,
       cl.code AS country_code, lf.de AS legal_form_type, mc.total_count AS members_total
FROM lobbyist_identity li JOIN register_entry re ON re.id = li.entry_id
LEFT JOIN address a ON a.id = li.address_id
LEFT JOIN country_label cl ON cl.id = a.country_id
LEFT JOIN code_label lf ON lf.id = li.legal_form_type_label_id
LEFT JOIN members_count mc ON mc.identity_id = li.id""")
def flt_identity(t: Tables) -> DataFrame:
    tb = ingested(t)[0]
    a = tb["address"].select(F.col("id").alias("address_id"), "city", "zip_code", "country_id")
    cl = tb["country_label"].select(F.col("id").alias("country_id"),
                                    F.col("code").alias("country_code"))
    lf = tb["code_label"].select(F.col("id").alias("legal_form_type_label_id"),
                                 F.col("de").alias("legal_form_type"))
    mc = tb["members_count"].select(F.col("identity_id").alias("id"),
                                    F.col("total_count").alias("members_total"))
    return (_numbered(t, "lobbyist_identity")
            .join(a, "address_id", "left").join(cl, "country_id", "left")
            .join(lf, "legal_form_type_label_id", "left").join(mc, "id", "left")
            .select("register_number", "identity", "last_name", "first_name", "name_text",
                    "company_name", "recent_gov_function_present", "legal_form_text", "city",
                    "zip_code", "country_code", "legal_form_type", "members_total"))


def _person_oracle(table: str, present: str) -> str:
    return f"""
SELECT re.register_number, CAST(row_number() OVER (PARTITION BY p.identity_id ORDER BY p.id) AS INTEGER) AS ordinal,
       p.last_name, p.first_name, {present} AS gov_present, rgf.end_year_month AS gov_until,
       rgf.ended AS gov_ended, cl.de AS gov_type, h.function_position
FROM {table} p JOIN lobbyist_identity li ON li.id = p.identity_id
JOIN register_entry re ON re.id = li.entry_id
LEFT JOIN recent_government_function rgf ON rgf.id = p.recent_gov_function_id
LEFT JOIN code_label cl ON cl.id = rgf.type_label_id
LEFT JOIN recent_gov_house_reps h ON h.recent_gov_fn_id = rgf.id"""


def _persons(t: Tables, table: str, present) -> DataFrame:
    tb = ingested(t)[0]
    rgf = tb["recent_government_function"].select(
        F.col("id").alias("recent_gov_function_id"), F.col("end_year_month").alias("gov_until"),
        F.col("ended").alias("gov_ended"), F.col("type_label_id"))
    cl = tb["code_label"].select(F.col("id").alias("type_label_id"), F.col("de").alias("gov_type"))
    house = tb["recent_gov_house_reps"].select(F.col("recent_gov_fn_id")
                                               .alias("recent_gov_function_id"),
                                               "function_position")
    return (_numbered(t, table).join(rgf, "recent_gov_function_id", "left")
            .join(cl, "type_label_id", "left").join(house, "recent_gov_function_id", "left")
            .select("register_number", "ordinal", "last_name", "first_name",
                    present.alias("gov_present"), "gov_until", "gov_ended", "gov_type",
                    "function_position"))


@query("flt_entrusted_person", section=S,
       oracle=_person_oracle("entrusted_person", "p.recent_gov_function_present"))
def flt_entrusted_person(t: Tables) -> DataFrame:
    return _persons(t, "entrusted_person", F.col("recent_gov_function_present"))


@query("flt_legal_representative", section=S,
       oracle=_person_oracle("legal_representative", "p.recent_gov_function_id IS NOT NULL"))
def flt_legal_representative(t: Tables) -> DataFrame:
    return _persons(t, "legal_representative", F.col("recent_gov_function_id").isNotNull())


@query("flt_field_of_interest", section=S, oracle="""
SELECT re.register_number, CAST(row_number() OVER (PARTITION BY foi.activities_id ORDER BY foi.id) AS INTEGER) AS ordinal,
       cl.de AS topic, foi.field_of_interest_text
FROM field_of_interest foi JOIN activities_interests ai ON ai.id = foi.activities_id
JOIN register_entry re ON re.id = ai.entry_id
LEFT JOIN code_label cl ON cl.id = foi.label_id""")
def flt_field_of_interest(t: Tables) -> DataFrame:
    cl = ingested(t)[0]["code_label"].select(F.col("id").alias("label_id"),
                                             F.col("de").alias("topic"))
    return (_numbered(t, "field_of_interest").join(cl, "label_id", "left")
            .select("register_number", "ordinal", "topic", "field_of_interest_text"))


@query("flt_financial_expenses", section=S, oracle="""
SELECT register_number, refuse_info, refuse_reason, fiscal_year_start_ym, related_year_start,
       related_year_end, expenses_from_eur, expenses_to_eur FROM (
  SELECT re.register_number, fe.*, row_number() OVER (PARTITION BY fe.entry_id
         ORDER BY fe.fiscal_year_start_ym DESC, fe.id DESC) AS r
  FROM financial_expenses fe JOIN register_entry re ON re.id = fe.entry_id) x
WHERE r = 1""")
def flt_financial_expenses(t: Tables) -> DataFrame:
    return _numbered(t, "financial_expenses").select(
        "register_number", "refuse_info", "refuse_reason", "fiscal_year_start_ym",
        "related_year_start", "related_year_end", "expenses_from_eur", "expenses_to_eur")


@query("flt_donator_item", section=S, oracle="""
SELECT re.register_number, CAST(row_number() OVER (PARTITION BY di.parent_id ORDER BY di.id) AS INTEGER) AS ordinal,
       di.name, di.amount_to_eur, di.description, d.info_present, d.refuse_info
FROM donator_item di JOIN donators d ON d.id = di.parent_id
JOIN register_entry re ON re.id = d.entry_id""")
def flt_donator_item(t: Tables) -> DataFrame:
    d = ingested(t)[0]["donators"].select(F.col("id").alias("parent_id"), "info_present",
                                          "refuse_info")
    return (_numbered(t, "donator_item").join(d, "parent_id")
            .select("register_number", "ordinal", "name", "amount_to_eur", "description",
                    "info_present", "refuse_info"))


@query("flt_public_allowance_item", section=S, oracle="""
SELECT re.register_number, CAST(row_number() OVER (PARTITION BY pa.parent_id ORDER BY pa.id) AS INTEGER) AS ordinal,
       pa.name, cl.de AS allowance_type, pa.location, pa.amount_to_eur, pa.description
FROM public_allowance_item pa JOIN public_allowances p ON p.id = pa.parent_id
JOIN register_entry re ON re.id = p.entry_id
LEFT JOIN code_label cl ON cl.id = pa.type_label_id""")
def flt_public_allowance_item(t: Tables) -> DataFrame:
    cl = ingested(t)[0]["code_label"].select(F.col("id").alias("type_label_id"),
                                             F.col("de").alias("allowance_type"))
    return (_numbered(t, "public_allowance_item").join(cl, "type_label_id", "left")
            .select("register_number", "ordinal", "name", "allowance_type", "location",
                    "amount_to_eur", "description"))


@query("flt_regulatory_project_item", section=S, oracle="""
SELECT re.register_number, CAST(row_number() OVER (PARTITION BY rpi.parent_id ORDER BY rpi.id) AS INTEGER) AS ordinal,
       rpi.title, db.title AS draft_title, db.publication_date,
       (SELECT COUNT(*) FROM reg_project_field_of_interest f WHERE f.project_item_id = rpi.id) AS topics,
       (SELECT COUNT(*) FROM reg_project_printed_matter m WHERE m.project_item_id = rpi.id) AS printed_matters
FROM regulatory_project_item rpi JOIN regulatory_projects rp ON rp.id = rpi.parent_id
JOIN register_entry re ON re.id = rp.entry_id
LEFT JOIN draft_bill db ON db.project_item_id = rpi.id""")
def flt_regulatory_project_item(t: Tables) -> DataFrame:
    tb = ingested(t)[0]
    db = tb["draft_bill"].select(F.col("project_item_id").alias("id"),
                                 F.col("title").alias("draft_title"), "publication_date")
    nf = tb["reg_project_field_of_interest"].groupBy(F.col("project_item_id").alias("id")) \
        .agg(F.count(F.lit(1)).alias("topics"))
    nm = tb["reg_project_printed_matter"].groupBy(F.col("project_item_id").alias("id")) \
        .agg(F.count(F.lit(1)).alias("printed_matters"))
    return (_numbered(t, "regulatory_project_item").join(db, "id", "left")
            .join(nf, "id", "left").join(nm, "id", "left")
            .select("register_number", "ordinal", "title", "draft_title", "publication_date",
                    F.coalesce(F.col("topics"), F.lit(0)).alias("topics"),
                    F.coalesce(F.col("printed_matters"), F.lit(0)).alias("printed_matters")))


@query("flt_statement_item", section=S, oracle="""
SELECT re.register_number, CAST(row_number() OVER (PARTITION BY si.parent_id ORDER BY si.id) AS INTEGER) AS ordinal,
       si.regulatory_project_title, si.text_body, si.sending_date, s.statements_count
FROM statement_item si JOIN statements s ON s.id = si.parent_id
JOIN register_entry re ON re.id = s.entry_id""")
def flt_statement_item(t: Tables) -> DataFrame:
    s = ingested(t)[0]["statements"].select(F.col("id").alias("parent_id"), "statements_count")
    return (_numbered(t, "statement_item").join(s, "parent_id")
            .select("register_number", "ordinal", "regulatory_project_title", "text_body",
                    "sending_date", "statements_count"))


@query("flt_contract_item", section=S, oracle="""
SELECT re.register_number, CAST(row_number() OVER (PARTITION BY ci.parent_id ORDER BY ci.id) AS INTEGER) AS ordinal,
       ci.description,
       (SELECT COUNT(*) FROM contract_field_of_interest f WHERE f.contract_item_id = ci.id) AS topics,
       (SELECT COUNT(*) FROM contract_client_org o JOIN contract_clients c ON c.id = o.clients_id
         WHERE c.contract_item_id = ci.id) AS client_orgs,
       (SELECT COUNT(*) FROM contractor_org o JOIN contract_contractors c ON c.id = o.contractors_id
         WHERE c.contract_item_id = ci.id) AS contractor_orgs
FROM contract_item ci JOIN contracts c ON c.id = ci.parent_id
JOIN register_entry re ON re.id = c.entry_id""")
def flt_contract_item(t: Tables) -> DataFrame:
    tb = ingested(t)[0]

    def per_item(df: DataFrame, link: str, parent: str, name: str) -> DataFrame:
        wrap = tb[link].select(F.col("id").alias(parent), F.col("contract_item_id").alias("id"))
        return df.select(parent).join(wrap, parent).groupBy("id") \
            .agg(F.count(F.lit(1)).alias(name))
    nf = tb["contract_field_of_interest"].groupBy(F.col("contract_item_id").alias("id")) \
        .agg(F.count(F.lit(1)).alias("topics"))
    nc = per_item(tb["contract_client_org"], "contract_clients", "clients_id", "client_orgs")
    no = per_item(tb["contractor_org"], "contract_contractors", "contractors_id",
                  "contractor_orgs")
    return (_numbered(t, "contract_item").join(nf, "id", "left").join(nc, "id", "left")
            .join(no, "id", "left")
            .select("register_number", "ordinal", "description",
                    *[F.coalesce(F.col(c), F.lit(0)).alias(c)
                      for c in ("topics", "client_orgs", "contractor_orgs")]))


@query("flt_code_label", section=S, oracle="""
SELECT DISTINCT cl.domain, cl.code, cl.de FROM code_label cl
WHERE cl.domain = 'field_of_interest' AND cl.id IN (
    SELECT label_id FROM field_of_interest UNION SELECT label_id FROM reg_project_field_of_interest
    UNION SELECT label_id FROM contract_field_of_interest)""")
def flt_code_label(t: Tables) -> DataFrame:
    return (ingested(t)[0]["code_label"].filter(F.col("domain") == "field_of_interest")
            .select("domain", "code", "de"))


@query("flt_account_versions", section=S, oracle="""
SELECT re.register_number, ad.active_lobbyist, ad.account_has_codex_violations,
       ad.first_publication_date,
       (SELECT COUNT(*) FROM account_register_entry_version v WHERE v.account_id = ad.id) AS versions,
       (SELECT MAX(v.version) FROM account_register_entry_version v WHERE v.account_id = ad.id) AS last_version,
       (SELECT COUNT(*) FROM codex_violation v WHERE v.account_id = ad.id) AS violations
FROM account_details ad JOIN register_entry re ON re.id = ad.entry_id""")
def flt_account_versions(t: Tables) -> DataFrame:
    tb = ingested(t)[0]
    v = tb["account_register_entry_version"].groupBy(F.col("account_id").alias("id")).agg(
        F.count(F.lit(1)).alias("versions"), F.max("version").alias("last_version"))
    cv = tb["codex_violation"].groupBy(F.col("account_id").alias("id")) \
        .agg(F.count(F.lit(1)).alias("violations"))
    return (_numbered(t, "account_details").join(v, "id", "left").join(cv, "id", "left")
            .select("register_number", "active_lobbyist", "account_has_codex_violations",
                    F.col("first_publication_date").cast("timestamp_ntz")
                    .alias("first_publication_date"),
                    F.coalesce(F.col("versions"), F.lit(0)).alias("versions"), "last_version",
                    F.coalesce(F.col("violations"), F.lit(0)).alias("violations")))


@query("src_reconcile", section=S, oracle="""
SELECT COUNT(*) AS expected, COUNT(*) AS processed, 0 AS missing FROM register_entry""")
def src_reconcile(t: Tables) -> DataFrame:
    """SRC-8: the total the pages announce against the entries processed."""
    _, entries, pages = ingested(t)
    return P.reconcile_totals(entries, pages).select(
        "expected", "processed", F.col("missing").cast("int").alias("missing"))


@query("flt_client_org", section=S, oracle="""
SELECT re.register_number, CAST(row_number() OVER (PARTITION BY co.client_identity_id ORDER BY co.id) AS INTEGER) AS ordinal,
       co.name, co.legal_form_text, ci.clients_present, ci.clients_count
FROM client_org co JOIN client_identity ci ON ci.id = co.client_identity_id
JOIN register_entry re ON re.id = ci.entry_id""")
def flt_client_org(t: Tables) -> DataFrame:
    """FLT-5: client organisations with their header."""
    ci = ingested(t)[0]["client_identity"].select(F.col("id").alias("client_identity_id"),
                                                  "clients_present", "clients_count")
    return (_numbered(t, "client_org").join(ci, "client_identity_id")
            .select("register_number", "ordinal", "name", "legal_form_text", "clients_present",
                    "clients_count"))


@query("flt_client_person", section=S, oracle="""
SELECT re.register_number, CAST(cp.id AS VARCHAR) AS last_name
FROM client_person cp JOIN client_identity ci ON ci.id = cp.client_identity_id
JOIN register_entry re ON re.id = ci.entry_id""")
def flt_client_person(t: Tables) -> DataFrame:
    """FLT-5: client persons."""
    return _numbered(t, "client_person").select("register_number", "last_name")


@query("flt_employees", section=S, oracle="""
SELECT re.register_number, ei.related_year_finished, ei.related_year_end, ei.employee_fte
FROM employees_involved ei JOIN register_entry re ON re.id = ei.entry_id""")
def flt_employees(t: Tables) -> DataFrame:
    """FLT-6: employees involved in lobbying."""
    return _numbered(t, "employees_involved").select(
        "register_number", "related_year_finished", "related_year_end", "employee_fte")


@query("flt_membership_fees", section=S, oracle="""
SELECT re.register_number, mf.related_year_finished, mf.total_to_eur
FROM membership_fees mf JOIN register_entry re ON re.id = mf.entry_id""")
def flt_membership_fees(t: Tables) -> DataFrame:
    """FLT-11: membership fees."""
    return _numbered(t, "membership_fees").select("register_number", "related_year_finished",
                                                  "total_to_eur")


@query("flt_annual_reports", section=S, oracle="""
SELECT re.register_number, ar.refuse_annual_fin_stmt, ar.missing_annual_report_reason
FROM annual_reports ar JOIN register_entry re ON re.id = ar.entry_id""")
def flt_annual_reports(t: Tables) -> DataFrame:
    """FLT-12: annual reports."""
    return _numbered(t, "annual_reports").select("register_number", "refuse_annual_fin_stmt",
                                                 "missing_annual_report_reason")


@query("flt_contract_parties", section=S, oracle="""
SELECT re.register_number, 'client' AS side, i.description, o.name, CAST(NULL AS VARCHAR) AS reference_name
FROM contract_client_org o JOIN contract_clients k ON k.id = o.clients_id
JOIN contract_item i ON i.id = k.contract_item_id JOIN contracts c ON c.id = i.parent_id
JOIN register_entry re ON re.id = c.entry_id
UNION ALL
SELECT re.register_number, 'contractor', i.description, o.name, o.reference_name
FROM contractor_org o JOIN contract_contractors k ON k.id = o.contractors_id
JOIN contract_item i ON i.id = k.contract_item_id JOIN contracts c ON c.id = i.parent_id
JOIN register_entry re ON re.id = c.entry_id""")
def flt_contract_parties(t: Tables) -> DataFrame:
    """FLT-15: client and contractor organisations of the contracts."""
    tb = ingested(t)[0]
    items = tb["contract_item"].select(F.col("id").alias("contract_item_id"), "description")

    def side(name: str, header: str, orgs: str, key: str, reference) -> DataFrame:
        link = tb[header].select(F.col("id").alias(key), "contract_item_id")
        return (_numbered(t, orgs).join(link, key).join(items, "contract_item_id")
                .select("register_number", F.lit(name).alias("side"), "description", "name",
                        reference.alias("reference_name")))
    return side("client", "contract_clients", "contract_client_org", "clients_id",
                F.lit(None).cast("string")).unionByName(
        side("contractor", "contract_contractors", "contractor_org", "contractors_id",
             F.col("reference_name")))


@query("src_enums", section=S, oracle="""
SELECT aot.code, COUNT(ai.id) AS entries
FROM activity_operation_type aot LEFT JOIN activities_interests ai ON ai.activity_operation_type = aot.code
GROUP BY aot.code""")
def src_enums(t: Tables) -> DataFrame:
    """SRC-12: the seeded codes of the ingested store and the entries that use each."""
    tb = ingested(t)[0]
    used = tb["activities_interests"].groupBy(F.col("activity_operation_type").alias("code")) \
        .agg(F.count(F.lit(1)).alias("n"))
    return tb["activity_operation_type"].select("code").join(used, "code", "left").select(
        "code", F.coalesce("n", F.lit(0)).alias("entries"))


@query("mv_refresh", section=S, oracle="""
SELECT 'mv_financial_tops' AS view, field_of_interest AS name, lobbyist_count AS n,
       CAST(total_spend_max AS VARCHAR) AS total, avg_spend AS average, CAST(NULL AS VARCHAR) AS detail
FROM mv_financial_tops
UNION ALL
SELECT 'mv_revolving_door_network', register_number, COUNT(*), NULL, NULL,
       concat_ws('|', organization_name, last_name, first_name, role, end_year_month, gov_function_type)
FROM mv_revolving_door_network GROUP BY ALL""")
def mv_refresh(t: Tables) -> DataFrame:
    """SRC-11: both views after two incremental refreshes.  The first run sees every third entry without
    expenses and people; a second run brings these entries alone, as they are."""
    spark = t["register_entry"].sparkSession
    out = shared_path(spark, "mv-deltas", unique=True)
    late = t["register_entry"].where(F.col("id") % 3 == 0).select(F.col("id").alias("entry_id"))

    def early(name: str) -> DataFrame:
        return t[name].join(late, "entry_id", "left_anti")

    refresh_changed(spark, out, t.with_tables(financial_expenses=early("financial_expenses"),
                                              lobbyist_identity=early("lobbyist_identity")))
    only = {name: t[name].join(late, "entry_id", "left_semi")
            for name in ("activities_interests", "financial_expenses", "lobbyist_identity")}
    refresh_changed(spark, out, t.with_tables(
        **only, register_entry=t["register_entry"].where(F.col("id") % 3 == 0)))
    views = maintained_views(spark, out)
    tops = views["mv_financial_tops"].select(
        F.lit("mv_financial_tops").alias("view"), F.col("field_of_interest").alias("name"),
        F.col("lobbyist_count").alias("n"), F.col("total_spend_max").cast("string").alias("total"),
        F.col("avg_spend").alias("average"), F.lit(None).cast("string").alias("detail"))
    people = views["mv_revolving_door_network"].groupBy(
        F.col("register_number").alias("name"), F.concat_ws(
            "|", "organization_name", "last_name", "first_name", "role", "end_year_month", "gov_function_type")
        .alias("detail")).agg(F.count(F.lit(1)).alias("n"))
    return tops.unionByName(people.select(
        F.lit("mv_revolving_door_network").alias("view"), "name", "n", F.lit(None).cast("string").alias("total"),
        F.lit(None).cast("double").alias("average"), "detail"))


@query("src_upsert", section=S, oracle="""
SELECT register_number, CASE WHEN id % 3 = 0 THEN 'second run' ELSE 'first run' END AS source
FROM register_entry""")
def src_upsert(t: Tables) -> DataFrame:
    """SRC-5: a third of the entries comes again in a second run, which wins."""
    first = t["register_entry"].select("id", "register_number", F.lit("first run").alias("source"))
    again = (t["register_entry"].where(F.col("id") % 3 == 0)
             .select("id", "register_number", F.lit("second run").alias("source")))
    return upsert_entries(first, again).select("register_number", "source")


def _from_entries(t: Tables, sql: str) -> DataFrame:
    """Rows that ``sql`` makes from the register's entries."""
    entries = t["register_entry"].select("id", "register_number")
    # Braces of JSON text are no parameters.
    sql = sql.replace("{", "{{").replace("}", "}}").replace("AS VARCHAR", "AS STRING")
    return entries.sparkSession.sql(re.sub(r"\bregister_entry\b", "{entries}", sql), entries=entries)


#: Landed pages made from the entries, as SQL for Spark and DuckDB: five runs whose cursors chain every
#: fifth entry.  Run 1 turns back now and then, run 2 has lost pages, run 3 landed each page twice.
_LANDED = """
SELECT id % 5 AS run, 'page ' || md5(register_number) AS page,
       CASE WHEN id > 5 THEN 'c' || CAST(id AS VARCHAR) END AS cursor,
       CASE WHEN id % 5 = 4 AND id + 5 > (SELECT MAX(id) FROM register_entry) THEN NULL
            WHEN id % 5 = 1 AND id > 60 AND (id - id % 5) % 35 = 0 THEN 'c' || CAST(id - 20 AS VARCHAR)
            ELSE 'c' || CAST(id + 5 AS VARCHAR) END AS next_cursor
FROM register_entry WHERE NOT (id % 5 = 2 AND id > 100 AND (id - id % 5) % 55 = 0)
UNION ALL
SELECT id % 5, 'page ' || md5(register_number) || ' again', CASE WHEN id > 5 THEN 'c' || CAST(id AS VARCHAR) END, NULL
FROM register_entry WHERE id % 5 = 3"""


@query("src_page_chain", section=S, oracle=f"""
WITH RECURSIVE landed AS ({_LANDED}),
nodes AS (SELECT run, coalesce(cursor, '') AS cur, MIN(page) AS page, arg_min(next_cursor, page) AS dest
          FROM (SELECT run, cursor, page, coalesce(next_cursor, '') AS next_cursor FROM landed) x GROUP BY 1, 2),
walk AS (SELECT run, cur, page, dest, 0 AS rank, [cur] AS seen FROM nodes WHERE cur = ''
  UNION ALL
  SELECT n.run, n.cur, n.page, n.dest, w.rank + 1, list_append(w.seen, n.cur)
  FROM walk w JOIN nodes n ON n.run = w.run AND n.cur = w.dest
  WHERE w.dest <> '' AND NOT list_contains(w.seen, n.cur))
SELECT l.run, l.page, CAST(w.rank AS BIGINT) AS rank,
       CASE WHEN w.rank IS NULL AND n.page IS NULL THEN 'duplicate' WHEN w.rank IS NULL THEN 'unreachable'
            WHEN w.dest = '' THEN 'last' WHEN t.rank IS NULL THEN 'gap'
            WHEN t.rank <= w.rank THEN 'repeated' ELSE 'chained' END AS state
FROM landed l LEFT JOIN nodes n ON n.run = l.run AND n.page = l.page
LEFT JOIN walk w ON w.run = l.run AND w.page = l.page
LEFT JOIN walk t ON t.run = w.run AND t.cur = w.dest""")
def src_page_chain(t: Tables) -> DataFrame:
    """SRC-1/8: order of landed pages along their cursors, with gaps, cycles and pages out of reach."""
    return page_chain(_from_entries(t, _LANDED))


#: Entry documents with planted faults, by id modulo 8, as SQL for Spark and DuckDB: a wrong type, a quoted number, an
#: integral float, a bad nullable date, an object for a text, a wrong boolean, a bad fiscal year.
_FAULTY = """
SELECT id, register_number, 'page-' || CAST(CAST(floor(id / 10) AS INT) AS VARCHAR) AS page,
       CAST(row_number() OVER (PARTITION BY floor(id / 10) ORDER BY id) - 1 AS INT) AS position,
       '{"registerNumber":"' || register_number || '"' || CASE id % 8
         WHEN 1 THEN ',"financialExpenses":{"financialExpensesEuro":{"to":"abc"}}'
         WHEN 2 THEN ',"financialExpenses":{"financialExpensesEuro":{"to":"1200"}}'
         WHEN 3 THEN ',"financialExpenses":{"financialExpensesEuro":{"to":1200.0}}'
         WHEN 4 THEN ',"financialExpenses":{"relatedFiscalYearStart":"not a day"}'
         WHEN 5 THEN ',"codeOfConduct":{"ownCodeOfConduct":true,"codeOfConductPdfUrl":{"a":1}}'
         WHEN 6 THEN ',"codeOfConduct":{"ownCodeOfConduct":"maybe"}'
         WHEN 7 THEN ',"financialExpenses":{"fiscalYearStart":"2021"}'
         ELSE '' END || '}' AS json
FROM register_entry"""


#: Spellings that ``nrm_dates`` writes and reads, as format patterns.
SPELLINGS = ["yyyy-MM-dd", "d MMMM yyyy", "MMM d, yyyy", "M/d/yyyy", "yyyy/M/d", "yyyyMMdd",
             "EEEE, d MMM yyyy", "dd-MMM-yy", "M.d.yyyy", "yyyy MMM d", "MMMM d'th', yyyy",
             "M-d-yyyy HH:mm"]


@query("nrm_dates", section=S, oracle="""
SELECT id, publication_date AS day, strftime(publication_date, '%Y-%m') AS year_month,
       false AS unreadable
FROM draft_bill""")
def nrm_dates(t: Tables) -> DataFrame:
    """Every bill's date, written in one of the spellings and read again by NRM-3 and NRM-4."""
    number = F.pmod("id", F.lit(len(SPELLINGS)))
    text = F.coalesce(*[F.when(number == i, F.date_format("publication_date", f))
                        for i, f in enumerate(SPELLINGS)])
    return t["draft_bill"].select("id", text.alias("text")).select(
        "id", N.day("text").alias("day"), N.year_month("text").alias("year_month"),
        F.coalesce(N.day_invalid("text"), F.lit(False)).alias("unreadable"))


@query("src_rejects", section=S, oracle=f"""
WITH docs AS ({_FAULTY}), cut AS (SELECT page, string_agg(json, ',' ORDER BY id) AS body FROM docs GROUP BY page),
broken AS (SELECT page FROM cut WHERE CAST(replace(page, 'page-', '') AS INT) % 6 = 5),
found AS (SELECT page, position, register_number AS entry, CASE id % 8
            WHEN 1 THEN 'type: financialExpenses.financialExpensesEuro.to' WHEN 4 THEN 'expenses.relatedFiscalYearStart'
            WHEN 6 THEN 'type: codeOfConduct.ownCodeOfConduct' WHEN 7 THEN 'expenses.fiscalYearStart' END AS rule,
          CASE id % 8 WHEN 1 THEN '"abc"' WHEN 4 THEN 'not a day' WHEN 6 THEN '"maybe"' WHEN 7 THEN '2021' END AS raw
          FROM docs WHERE page NOT IN (SELECT page FROM broken))
SELECT page, position, entry, rule, raw FROM found WHERE rule IS NOT NULL
UNION ALL SELECT page, NULL, NULL, 'unreadable page', NULL FROM broken
UNION ALL SELECT NULL, NULL, NULL, 'accepted entries', CAST(COUNT(*) AS VARCHAR) FROM found WHERE rule IS NULL""")
def src_rejects(t: Tables) -> DataFrame:
    """SRC-1/7: the ledger's rows of pages with planted faults, and the number of entries that were accepted."""
    docs = _from_entries(t, _FAULTY)
    whole = docs.groupBy("page").agg(F.concat(
        F.lit('{"source":"s","sourceUrl":"u","sourceDate":"2025-01-01T00:00:00Z","jsonDocumentationUrl":"d",'
              '"results":['), F.concat_ws(",", F.transform(
            F.sort_array(F.collect_list(F.struct("id", "json"))), lambda x: x["json"])), F.lit("]}")).alias("value"))
    broken = F.regexp_replace("page", "page-", "").cast("int") % 6 == 5
    text = whole.select(F.col("page").alias("_page"), F.when(broken, F.substring("value", 1, 20)).otherwise(
        F.col("value")).alias("value"))
    # Pages of ten entries.
    found, unreadable = P.split_pages(stage(P.pages_from_text(dealt(text)), "pages", ENTRY_ROWS // 4))
    entries = stage(dealt(P.dedupe_entries(found)), "entries", ENTRY_ROWS)
    tables, _, rejects = flatten_entries(entries, cut)
    rejects = stage(entry_rejects(entries, tables, rejects), "rejects")
    rows = placed_rejects(entries, rejects, unreadable)
    # Keys of rejects that are just small enough, packed, to be broadcast fill the driver.
    accepted = entries.join(rejects.select(ENTRY).distinct().hint("shuffle_hash"), ENTRY, "left_anti").agg(
        F.count("*").cast("string").alias("raw"))
    none = F.lit(None).cast("string")
    return rows.withColumn("raw", F.when(F.col("entry").isNotNull(), F.col("raw"))).unionByName(accepted.select(
        none.alias("page"), F.lit(None).cast("int").alias("position"), none.alias("entry"),
        F.lit("accepted entries").alias("rule"), "raw"))


@query("src_replace", section=S, oracle="""
SELECT e.register_number, CASE WHEN e.id % 4 = 0 THEN 'again ' || i.name ELSE i.name END AS name, i.amount_to_eur
FROM donator_item i JOIN donators d ON d.id = i.parent_id JOIN register_entry e ON e.id = d.entry_id
WHERE e.id % 8 <> 0""")
def src_replace(t: Tables) -> DataFrame:
    """SRC-6: a quarter of the entries comes again to the bucketed store, half of these without donors."""
    spark = t["register_entry"].sparkSession
    entry = t["register_entry"].select("id", "register_number", F.col("register_number").alias(ENTRY))
    donors = (t["donator_item"].join(t["donators"].select(F.col("id").alias("parent_id"), "entry_id"), "parent_id")
              .join(entry.select(F.col("id").alias("entry_id"), ENTRY), "entry_id")
              .select("entry_id", "name", "amount_to_eur", ENTRY))
    out = shared_path(spark, "replace", unique=True)
    buckets.apply(spark, out, {"register_entry": entry, "donator_item": donors})
    buckets.apply(spark, out, {
        "register_entry": entry.where("id % 4 = 0"),
        "donator_item": donors.where("entry_id % 4 = 0 AND entry_id % 8 <> 0")
        .withColumn("name", F.concat(F.lit("again "), F.col("name")))}, epoch=1)
    return buckets.read_store(spark, out)["donator_item"].select(
        F.col(ENTRY).alias("register_number"), "name", "amount_to_eur")
