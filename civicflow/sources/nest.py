"""Register tables → nested register documents (the inverse of flattening).

Used to feed the ingest path with data derived from the driver's tables:
every register-shaped table is folded back into the JSON document of its
entry (one document per entry, lists ordered by child id), the documents
are cut into API-like pages, and the flatteners must give the tables back.

Each fold is a ``groupBy(parent).agg(collect_list)`` — the children of one
parent land in one row because they form one document; a document is
bounded by what one register filing contains.  Single-object sections
(financial expenses) keep the entry's latest fiscal year.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from civicflow.plans.common import Tables
from civicflow.sources.store import ENTRY_ROWS, stage

#: Sections that one stage joins to the documents: it sorts all of them at once.
JOINED = 3
#: Sections that are nested at once.
PARALLEL = 4

# Fixed value: the register tables carry no legislation per version; the
# documents state the first legislation code for all of them.
LEGISLATION = "GL2022"


def _label(t: Tables, id_col: str) -> Column:
    """A ``{code, de, en}`` object from code_label (NULL when no label)."""
    return F.when(F.col(f"{id_col}__code").isNotNull(),
                  F.struct(F.col(f"{id_col}__code").alias("code"),
                           F.col(f"{id_col}__de").alias("de"),
                           F.col(f"{id_col}__en").alias("en")))


def _with_label(t: Tables, df: DataFrame, id_col: str) -> DataFrame:
    cl = t["code_label"].select(F.col("id").alias(id_col),
                                F.col("code").alias(f"{id_col}__code"),
                                F.col("de").alias(f"{id_col}__de"),
                                F.col("en").alias(f"{id_col}__en"))
    return df.join(cl, id_col, "left")


def _fold(df: DataFrame, parent: str, item: Column, name: str) -> DataFrame:
    """(parent, array of items ordered by the child's id)."""
    return (df.groupBy(parent)
            .agg(F.sort_array(F.collect_list(F.struct(F.col("id").alias("_k"),
                                                      item.alias("v")))).alias("_a"))
            .select(parent, F.transform("_a", lambda x: x["v"]).alias(name)))


def _iso(c: str) -> Column:
    return F.date_format(F.col(c), "yyyy-MM-dd'T'HH:mm:ss")


def _gov(t: Tables, df: DataFrame, fn_col: str, out: str) -> DataFrame:
    """Attach the government-function object referenced by ``fn_col``."""
    rgf = t["recent_government_function"].select(
        F.col("id").alias(fn_col), "ended", "end_year_month", F.col("type_label_id"))
    rgf = _with_label(t, rgf, "type_label_id")
    house = t["recent_gov_house_reps"].select(F.col("recent_gov_fn_id").alias(fn_col),
                                              "function_position")
    rgf = rgf.join(house, fn_col, "left").select(
        fn_col, F.struct(_label(t, "type_label_id").alias("type"), F.col("ended").alias("ended"),
                         F.col("end_year_month").alias("endDate"),
                         F.when(F.col("function_position").isNotNull(), F.struct(
                             F.struct(F.lit("MdB").alias("code"), F.lit(None).cast("string")
                                      .alias("de"), F.lit(None).cast("string").alias("en"))
                             .alias("function"),
                             F.col("function_position").alias("functionPosition")))
                         .alias("houseOfRepresentatives")).alias(out))
    return df.join(rgf, fn_col, "left")


def joined(doc: DataFrame, parts: list[DataFrame], key: str) -> DataFrame:
    """``doc`` left-joined to all ``parts``, written after every ``JOINED`` of them."""
    for i, part in enumerate(parts, 1):
        doc = doc.join(part, key, "left")
        if i % JOINED == 0 and i < len(parts):
            doc = stage(doc, "joined", ENTRY_ROWS)
    return doc


def nest_documents(t: Tables, source: str = "register-fixture") -> DataFrame:
    """One row per entry: ``registerNumber`` and the entry document as JSON."""
    re = t["register_entry"].select(F.col("id").alias("entry_id"), "register_number")

    # accountDetails
    ad = t["account_details"]
    versions = _fold(t["account_register_entry_version"], "account_id",
                     F.struct(F.col("id").alias("registerEntryId"), F.col("version"),
                              F.lit(LEGISLATION).alias("legislation"),
                              _iso("valid_from_date").alias("validFromDate"),
                              F.col("version_active_lobbyist").alias("versionActiveLobbyist")),
                     "registerEntryVersions")
    codex = _fold(t["codex_violation"], "account_id",
                  F.struct(F.col("name").alias("codexViolationName")), "codexViolations")
    account = (ad.select(F.col("id").alias("account_id"), "entry_id", "active_lobbyist",
                         "first_publication_date", "account_has_codex_violations")
               .join(versions, "account_id", "left").join(codex, "account_id", "left")
               .select("entry_id", F.struct(
                   F.col("active_lobbyist").alias("activeLobbyist"),
                   _iso("first_publication_date").alias("firstPublicationDate"),
                   F.col("account_has_codex_violations").alias("accountHasCodexViolations"),
                   F.col("registerEntryVersions"), F.col("codexViolations"))
                   .alias("accountDetails")))

    # lobbyistIdentity with people and address
    li = t["lobbyist_identity"]
    ep = _gov(t, t["entrusted_person"], "recent_gov_function_id", "g")
    eps = _fold(ep, "identity_id", F.struct(
        F.col("last_name").alias("lastName"), F.col("first_name").alias("firstName"),
        F.col("recent_gov_function_present").alias("recentGovernmentFunctionPresent"),
        F.col("g").alias("recentGovernmentFunction")), "entrustedPersons")
    lr = _gov(t, t["legal_representative"], "recent_gov_function_id", "g")
    lrs = _fold(lr, "identity_id", F.struct(
        F.col("last_name").alias("lastName"), F.col("first_name").alias("firstName"),
        F.col("recent_gov_function_id").isNotNull().alias("recentGovernmentFunctionPresent"),
        F.col("g").alias("recentGovernmentFunction")), "legalRepresentatives")
    nes = _fold(t["named_employee"], "identity_id",
                F.struct(F.col("id").cast("string").alias("lastName")), "namedEmployees")
    mc = t["members_count"].select("identity_id", F.struct(F.col("total_count").alias("total"))
                                   .alias("membersCount"))
    addr = t["address"].select(F.col("id").alias("address_id"), "zip_code", "city",
                               F.col("country_id"))
    country = t["country_label"].select(F.col("id").alias("country_id"),
                                        F.col("code").alias("c_code"),
                                        F.col("de").alias("c_de"),
                                        F.col("en").alias("c_en"))
    addr = addr.join(country, "country_id", "left").select(
        "address_id", F.struct(F.col("zip_code").alias("zipCode"), F.col("city"),
                               F.when(F.col("c_code").isNotNull(), F.struct(
                                   F.col("c_code").alias("code"), F.col("c_de").alias("de"),
                                   F.col("c_en").alias("en"))).alias("country")).alias("address"))
    ident = _gov(t, _with_label(t, li.withColumnRenamed("id", "identity_id"),
                                "legal_form_type_label_id"), "recent_gov_function_id", "g")
    identity = (ident.join(addr, "address_id", "left")
                .join(eps, "identity_id", "left").join(lrs, "identity_id", "left")
                .join(nes, "identity_id", "left").join(mc, "identity_id", "left")
                .select("entry_id", F.struct(
                    F.col("identity"), F.col("last_name").alias("lastName"),
                    F.col("first_name").alias("firstName"), F.col("name_text").alias("name"),
                    F.col("company_name").alias("companyName"),
                    F.col("recent_gov_function_present").alias("recentGovernmentFunctionPresent"),
                    F.col("g").alias("recentGovernmentFunction"), F.col("address"),
                    _label(t, "legal_form_type_label_id").alias("legalFormType"),
                    F.when(F.col("legal_form_text").isNotNull(),
                           F.struct(F.col("legal_form_text").alias("legalFormText")))
                    .alias("legalForm"),
                    F.col("entrustedPersons"), F.col("legalRepresentatives"),
                    F.col("namedEmployees"), F.col("membersCount")).alias("lobbyistIdentity")))

    # activitiesAndInterests
    foi = _with_label(t, t["field_of_interest"], "label_id")
    fields = _fold(foi, "activities_id", F.struct(
        F.col("label_id__code").alias("code"), F.col("label_id__de").alias("de"),
        F.col("label_id__en").alias("en"),
        F.col("field_of_interest_text").alias("fieldOfInterestText")), "fieldsOfInterest")
    activities = (t["activities_interests"].withColumnRenamed("id", "activities_id")
                  .join(fields, "activities_id", "left")
                  .select("entry_id", F.struct(
                      F.col("activity_operation_type").alias("activityOperationType"),
                      F.col("activity_description").alias("activityDescription"),
                      F.col("fieldsOfInterest")).alias("activitiesAndInterests")))

    # clientIdentity
    orgs = _fold(t["client_org"], "client_identity_id", F.struct(
        F.col("name"), F.when(F.col("legal_form_text").isNotNull(),
                              F.struct(F.col("legal_form_text").alias("legalFormText")))
        .alias("legalForm")), "clientOrganizations")
    persons = _fold(t["client_person"], "client_identity_id",
                    F.struct(F.col("id").cast("string").alias("lastName")), "clientPersons")
    clients = (t["client_identity"].withColumnRenamed("id", "client_identity_id")
               .join(orgs, "client_identity_id", "left").join(persons, "client_identity_id", "left")
               .select("entry_id", F.struct(
                   F.col("clients_present").alias("clientsPresent"),
                   F.col("clients_count").alias("clientsCount"), F.col("clientOrganizations"),
                   F.col("clientPersons")).alias("clientIdentity")))

    employees = t["employees_involved"].select("entry_id", F.struct(
        F.col("related_year_finished").alias("relatedFiscalYearFinished"),
        F.date_format("related_year_end", "yyyy-MM-dd").alias("relatedFiscalYearEnd"),
        F.col("employee_fte").alias("employeeFTE")).alias("employeesInvolvedInLobbying"))

    # financialExpenses: the latest fiscal year of the entry
    fe = t["financial_expenses"]
    latest = fe.groupBy("entry_id").agg(F.max_by(F.struct(*[c for c in fe.columns]),
                                                 F.struct("fiscal_year_start_ym", "id")).alias("x"))
    expenses = latest.select("entry_id", F.struct(
        F.col("x.refuse_info").alias("refuseFinancialExpensesInformation"),
        F.col("x.refuse_reason").alias("refuseFinancialExpensesInformationReason"),
        F.date_format("x.related_year_start", "yyyy-MM-dd").alias("relatedFiscalYearStart"),
        F.date_format("x.related_year_end", "yyyy-MM-dd").alias("relatedFiscalYearEnd"),
        F.col("x.fiscal_year_start_ym").alias("fiscalYearStart"),
        F.struct(F.col("x.expenses_from_eur").alias("from"),
                 F.col("x.expenses_to_eur").alias("to")).alias("financialExpensesEuro"))
        .alias("financialExpenses"))

    items = _fold(t["donator_item"], "parent_id", F.struct(
        F.col("name"), F.struct(F.col("amount_to_eur").alias("to")).alias("donationEuro"),
        F.col("description")), "donators")
    donators = (t["donators"].withColumnRenamed("id", "parent_id").join(items, "parent_id", "left")
                .select("entry_id", F.struct(
                    F.col("refuse_info").alias("refuseDonatorsInformation"),
                    F.col("refuse_reason").alias("refuseDonatorsInformationReason"),
                    F.col("info_present").alias("donatorsInformationPresent"),
                    F.struct(F.col("total_to_eur").alias("to")).alias("totalDonationsEuro"),
                    F.col("donators")).alias("donators")))

    pai = _with_label(t, t["public_allowance_item"], "type_label_id")
    pitems = _fold(pai, "parent_id", F.struct(
        F.col("name"), _label(t, "type_label_id").alias("type"), F.col("location"),
        F.struct(F.col("amount_to_eur").alias("to")).alias("publicAllowanceEuro"),
        F.col("description")), "publicAllowances")
    allowances = (t["public_allowances"].withColumnRenamed("id", "parent_id")
                  .join(pitems, "parent_id", "left")
                  .select("entry_id", F.struct(
                      F.coalesce(F.col("publicAllowances"), F.array().cast(
                          pitems.schema["publicAllowances"].dataType)).alias("publicAllowances"))
                      .alias("publicAllowances")))

    fees = t["membership_fees"].select("entry_id", F.struct(
        F.col("related_year_finished").alias("relatedFiscalYearFinished"),
        F.struct(F.col("total_to_eur").alias("to")).alias("totalMembershipFees"))
        .alias("membershipFees"))
    reports = t["annual_reports"].select("entry_id", F.struct(
        F.col("refuse_annual_fin_stmt").alias("refuseAnnualFinanceStatement"),
        F.col("missing_annual_report_reason").alias("missingAnnualReportReason"))
        .alias("annualReports"))

    # regulatoryProjects
    lm = t["leading_ministry"].select(F.col("id").alias("ministry_id"), "title", "short_title")
    pm_min = _fold(t["reg_project_printed_matter_ministry"].join(lm, "ministry_id", "left")
                   .withColumnRenamed("printed_matter_id", "pm_id"), "pm_id",
                   F.struct(F.col("title"), F.col("short_title").alias("shortTitle")),
                   "leadingMinistries")
    matters = _fold(t["reg_project_printed_matter"].withColumnRenamed("id", "pm_id")
                    .join(pm_min, "pm_id", "left").withColumnRenamed("pm_id", "id"),
                    "project_item_id",
                    F.struct(F.coalesce(F.col("leadingMinistries"), F.array().cast(
                        pm_min.schema["leadingMinistries"].dataType)).alias("leadingMinistries")),
                    "printedMatters")
    db_min = _fold(t["draft_bill_ministry"], "draft_bill_id",
                   F.struct(F.col("id").cast("string").alias("url")), "leadingMinistries")
    bills = (t["draft_bill"].withColumnRenamed("id", "draft_bill_id")
             .join(db_min, "draft_bill_id", "left")
             .select("project_item_id", F.struct(
                 F.col("title"), F.date_format("publication_date", "yyyy-MM-dd")
                 .alias("publicationDate"), F.col("leadingMinistries")).alias("draftBill")))
    rpf = _with_label(t, t["reg_project_field_of_interest"], "label_id")
    pfields = _fold(rpf, "project_item_id", _label(t, "label_id"), "fieldsOfInterest")
    items_p = (t["regulatory_project_item"].withColumnRenamed("id", "project_item_id")
               .join(matters, "project_item_id", "left").join(bills, "project_item_id", "left")
               .join(pfields, "project_item_id", "left")
               .withColumnRenamed("project_item_id", "id"))
    projects_list = _fold(items_p, "parent_id", F.struct(
        F.col("title"), F.col("printedMatters"),
        F.col("draftBill").isNotNull().alias("draftBillPresent"), F.col("draftBill"),
        F.col("fieldsOfInterest")), "regulatoryProjects")
    projects = (t["regulatory_projects"].withColumnRenamed("id", "parent_id")
                .join(projects_list, "parent_id", "left")
                .select("entry_id", F.struct(F.coalesce(F.col("regulatoryProjects"), F.array()
                                                        .cast(projects_list.schema[
                                                            "regulatoryProjects"].dataType))
                                             .alias("regulatoryProjects"))
                        .alias("regulatoryProjects")))

    st_items = _fold(t["statement_item"], "parent_id", F.struct(
        F.col("regulatory_project_title").alias("regulatoryProjectTitle"),
        F.struct(F.col("text_body").alias("text")).alias("text"),
        F.array(F.struct(F.date_format("sending_date", "yyyy-MM-dd").alias("sendingDate")))
        .alias("recipientGroups")), "statements")
    statements = (t["statements"].withColumnRenamed("id", "parent_id")
                  .join(st_items, "parent_id", "left")
                  .select("entry_id", F.struct(F.col("statements_count").alias("statementsCount"),
                                               F.col("statements")).alias("statements")))

    cfoi = _with_label(t, t["contract_field_of_interest"], "label_id")
    cfields = _fold(cfoi, "contract_item_id", _label(t, "label_id"), "fieldsOfInterest")
    cco = _fold(t["contract_client_org"].join(
        t["contract_clients"].select(F.col("id").alias("clients_id"), "contract_item_id"),
        "clients_id"), "contract_item_id", F.struct(F.col("name")), "clientOrganizations")
    cor = _fold(t["contractor_org"].join(
        t["contract_contractors"].select(F.col("id").alias("contractors_id"), "contract_item_id"),
        "contractors_id"), "contract_item_id",
        F.struct(F.col("name"), F.col("reference_name").alias("referenceName")),
        "contractorOrganizations")
    c_items = (t["contract_item"].withColumnRenamed("id", "contract_item_id")
               .join(cfields, "contract_item_id", "left").join(cco, "contract_item_id", "left")
               .join(cor, "contract_item_id", "left").withColumnRenamed("contract_item_id", "id"))
    contracts_list = _fold(c_items, "parent_id", F.struct(
        F.col("description"), F.col("fieldsOfInterest"),
        F.struct(F.col("clientOrganizations")).alias("clients"),
        F.struct(F.col("contractorOrganizations")).alias("contractors")), "contracts")
    contracts = (t["contracts"].withColumnRenamed("id", "parent_id")
                 .join(contracts_list, "parent_id", "left")
                 .select("entry_id", F.struct(F.coalesce(F.col("contracts"), F.array().cast(
                     contracts_list.schema["contracts"].dataType)).alias("contracts"))
                     .alias("contracts")))

    # Joined as text: nested, each join would sort and write again all children of all entries.
    sections = [account, identity, activities, clients, employees, expenses, donators, allowances, fees, reports,
                projects, statements, contracts]
    names = [part.columns[1] for part in sections]
    # The sections share nothing: one is planned while another runs.
    with ThreadPoolExecutor(max_workers=PARALLEL) as pool:
        parts = list(pool.map(lambda part: stage(part.select(
            "entry_id", F.to_json(part.columns[1]).alias(part.columns[1])), "section"), sections))
    doc = joined(re, parts, "entry_id")
    head = F.to_json(F.struct(
        F.lit(source).alias("source"), F.lit("https://example.invalid/register").alias("sourceUrl"),
        F.lit("2025-01-01T00:00:00Z").alias("sourceDate"),
        F.lit("https://example.invalid/doc").alias("jsonDocumentationUrl"),
        F.col("register_number").alias("registerNumber")))
    # An entry without a section does not name it.
    body = F.concat_ws(",", F.substring(head, F.lit(2), F.length(head) - 2),
                       *[F.concat(F.lit(f'"{name}":'), F.col(name)) for name in names])
    return doc.select(F.col("register_number").alias("registerNumber"),
                      F.concat(F.lit("{"), body, F.lit("}")).alias("json"))


def pages_text(docs: DataFrame, page_size: int = 100, copies: int = 1) -> DataFrame:
    """Cut documents into API-like pages: (``_page``, ``value`` JSON text).

    The page of a document is a hash bucket of its register number, so no
    global numbering is needed; ``copies`` > 1 lands every entry again on
    a later page (the API repeats entries across cursors), which the
    de-duplication must remove.
    """
    n = docs.select("registerNumber", "json")
    # The API states the total on every page; it is a scalar subquery.
    total = n.agg(F.count(F.lit(1))).scalar()
    pages = F.greatest(F.ceil(total / F.lit(page_size)), F.lit(1))
    bucket = F.pmod(F.xxhash64("registerNumber"), pages)
    parts = [n.select(F.format_string("page-%02d-%010d", F.lit(k), bucket).alias("_page"), "json")
             for k in range(copies)]
    rows = parts[0]
    for p in parts[1:]:
        rows = rows.unionByName(p)
    return (rows.groupBy("_page")
            .agg(F.count(F.lit(1)).alias("n"),
                 F.concat_ws(",", F.sort_array(F.collect_list("json"))).alias("body"))
            .select("_page", F.concat(F.lit('{"source":"register-fixture","resultCount":'),
                                      F.col("n").cast("string"),
                                      F.lit(',"totalResultCount":'), total.cast("string"),
                                      F.lit(',"results":['), F.col("body"),
                                      F.lit("]}")).alias("value")))
