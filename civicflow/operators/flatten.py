"""Section flatteners (FLT-*): nested register entries → 84 typed tables.

Set-based instead of row-at-a-time: every list is one ``posexplode`` over
the whole entry DataFrame, so the 84 outputs are narrow projections of the
(persisted) entries — no shuffle except for the two label dimensions.

An entry has some thousand columns, and an exploded list is read whole, however
few of its fields a projection takes.  So ``cut`` (a lineage cut, such as
``civicflow.sources.store.stage``) is applied to each section, to each list that
several projections read and to each dimension: the projections scan a few
columns of narrow files.

Ids are deterministic: ``xxhash64`` of the register number, the table and
the ordinals on the path.  A re-run gives the same ids; no sequence, no
global ordering, and a child knows its parent's id without a lookup.

Every output carries ``_entry`` (the register number) so that an entry
rejected by any rule can be removed from all tables with one anti join
(``civicflow.sources.store.quarantine``).
"""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from functools import lru_cache

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from civicflow.functions import normalize as N
from civicflow.schema import TABLES, conform
from civicflow.sources.document import SECTION_ORDER, entry_schema

ENTRY = "_entry"
SEQ = "_seq"
#: Sections that are cut and flattened at once.
PARALLEL = 8


def _fields(path: list[str]) -> list[str]:
    """Field names of a nested struct of the entry schema."""
    return list(_fields_cached(tuple(path)))


@lru_cache(maxsize=None)
def _fields_cached(path: tuple[str, ...]) -> tuple[str, ...]:
    dt = entry_schema()
    for p in path:
        dt = dt[p].dataType
        while hasattr(dt, "elementType"):
            dt = dt.elementType
    return tuple(f.name for f in dt.fields)


def hid(*parts) -> Column:
    """Deterministic surrogate key."""
    return F.xxhash64(*[F.lit(p) if isinstance(p, (str, int)) else p for p in parts])


@dataclass
class Flattener:
    """Collects output tables, dimension occurrences and label uses."""

    docs: DataFrame                       # _entry, _seq, e (entry struct)
    cut: Callable[[DataFrame, str], DataFrame] = lambda df, name: df
    tables: dict[str, list[DataFrame]] = field(default_factory=dict)
    addresses: list[DataFrame] = field(default_factory=list)
    contacts: list[DataFrame] = field(default_factory=list)
    gov_functions: list[DataFrame] = field(default_factory=list)
    labels: dict[int, tuple[DataFrame, list]] = field(default_factory=dict)
    rejects: dict[int, tuple[DataFrame, list]] = field(default_factory=dict)

    # ------------------------------------------------------------ helpers
    def add(self, other: Flattener) -> None:
        """All that ``other`` has collected, after what is here."""
        for name, parts in other.tables.items():
            self.tables.setdefault(name, []).extend(parts)
        self.addresses += other.addresses
        self.contacts += other.contacts
        self.gov_functions += other.gov_functions
        self.labels |= other.labels
        self.rejects |= other.rejects

    def rows(self, df: DataFrame, arr: Column, alias: str, pos: str, name: str) -> DataFrame:
        """One row per list element, cut: for lists that several projections read."""
        keys = [c for c in df.columns if c in (ENTRY, SEQ) or c.startswith("o")]
        return self.cut(_explode(df, arr, alias, pos).select(*keys, pos, alias), name)

    def emit(self, table: str, df: DataFrame) -> None:
        self.tables.setdefault(table, []).append(df)

    def reject(self, df: DataFrame, cond: Column, rule: str, raw: Column | None = None) -> None:
        """A check of rows; ``raw`` is the value that fails it."""
        # Checks are grouped per source DataFrame and evaluated in one pass.
        self.rejects.setdefault(id(df), (df, []))[1].append((cond, rule, raw))

    def reject_times(self, df: DataFrame, alias: str, names: list[str], rule: str, invalid=N.ts_invalid) -> None:
        """Nullable times (or days) of a struct that are given but cannot be read."""
        for name in names:
            value = F.col(f"{alias}.{name}")
            self.reject(df, invalid(value), f"{rule}.{name}", value)

    def label(self, df: DataFrame, domain: str, obj: Column, site: int | Column, *ords) -> Column:
        """Record a label use; return its id column expression."""
        path = F.array(F.lit(site).cast("long"), *[o.cast("long") for o in ords],
                       *[F.lit(0).cast("long") for _ in range(4 - len(ords))])
        key = N.label_key(obj)
        self.use(df, domain, key, obj, path)
        return F.when(key.isNotNull(), F.xxhash64(F.lit(domain), key))

    def use(self, df: DataFrame, domain: str, key: Column, obj: Column, path: Column) -> None:
        # Uses are grouped per source DataFrame; those without a key are dropped there (label_uses).
        self.labels.setdefault(id(df), (df, []))[1].append(F.struct(
            F.lit(domain).alias("domain"), key.alias("code"), obj["de"].alias("de"), obj["en"].alias("en"),
            F.struct(F.col(SEQ).alias("o"), path.alias("path")).alias("seq")))

    def label_uses(self) -> DataFrame:
        """(entry, domain, code, de, en, seq) of all label uses, in one pass over each source."""
        return _union([df.select(ENTRY, F.inline(F.filter(F.array(*uses), lambda x: x["code"].isNotNull())))
                       for df, uses in self.labels.values()])

    def address(self, df: DataFrame, obj: Column, key: Column) -> Column:
        present = N.any_field(obj, _ADDRESS_FIELDS)
        self.addresses.append(df.filter(present).select(ENTRY, SEQ, key.alias("id"), obj.alias("a")))
        return F.when(present, key)

    def label_country(self, df: DataFrame, obj: Column) -> None:
        self.use(df, "__country__", F.when(N.country_present(obj), obj["code"]), obj,
                 F.array(*[F.lit(0).cast("long")] * 5))
        self.reject(df, N.country_invalid(obj), "country_without_code")

    def contact(self, df: DataFrame, obj: Column, key: Column) -> Column:
        present = N.any_field(obj, ["phoneNumber", "phone", "emails", "websites"])
        self.contacts.append(df.filter(present).select(ENTRY, key.alias("id"), obj.alias("c")))
        return F.when(present, key)

    def gov(self, df: DataFrame, flag: Column, obj: Column, key: Column, site: int) -> Column:
        """Government function behind a presence flag (NRM-10, NRM-11)."""
        gated = N.gate(flag, obj)
        present = N.any_field(gated, _GOV_FIELDS)
        self.gov_functions.append(df.filter(present).select(
            ENTRY, SEQ, key.alias("id"), gated.alias("g"), F.lit(site).alias("site")))
        return F.when(present, key)


_ADDRESS_FIELDS = ["type", "nationalAdditional1", "nationalAdditional2",
                   "internationalAdditional1", "internationalAdditional2", "street",
                   "streetNumber", "zipCode", "city", "postBox", "country"]
_GOV_FIELDS = ["type", "ended", "endDate", "houseOfRepresentatives", "federalGovernment",
               "federalAdministration"]


def _explode(df: DataFrame, arr: Column, alias: str, pos: str) -> DataFrame:
    """One row per list element with its 1-based ordinal."""
    return df.select("*", F.posexplode(arr).alias(pos, alias)) \
        .withColumn(pos, F.col(pos) + 1)


def _section(f: Flattener, name: str) -> DataFrame:
    """Entries whose section ``name`` is a non-empty object."""
    s = F.col(f"e.{name}")
    return f.cut(f.docs.filter(N.any_field(s, _fields([name]))).select(ENTRY, SEQ, s.alias("s")), name)


def _sid(name: str) -> Column:
    return hid(F.col(ENTRY), name)


# ------------------------------------------------------------------ FLT-0
def flt_register_entry(f: Flattener) -> None:
    e = F.col("e")
    fields = [n for n in _fields([]) if n not in SECTION_ORDER]
    df = f.cut(f.docs.select(ENTRY, SEQ, F.struct(*[e[n].alias(n) for n in fields]).alias("e")), "head")
    f.reject(df, N.ts_invalid(e["sourceDate"]), "source_date", e["sourceDate"])
    f.emit("register_entry", df.select(
        ENTRY, hid(F.col(ENTRY)).alias("id"), e.getField("$schema").alias("schema_uri"),
        e["source"].alias("source"), e["sourceUrl"].alias("source_url"),
        N.ts(e["sourceDate"]).alias("source_date"),
        e["jsonDocumentationUrl"].alias("json_doc_url"),
        e["registerNumber"].alias("register_number")))


# ------------------------------------------------------------------ FLT-1
def flt_account(f: Flattener) -> None:
    s = _section(f, "accountDetails")
    aid = _sid("account")
    for c in ("inactiveLobbyistStartDate", "firstPublicationDate", "lastUpdateDate"):
        f.reject(s, N.ts_invalid(F.col(f"s.{c}")), f"account.{c}", F.col(f"s.{c}"))
    f.emit("account_details", s.select(
        ENTRY, aid.alias("id"), hid(F.col(ENTRY)).alias("entry_id"),
        F.col("s.activeLobbyist").alias("active_lobbyist"),
        N.ts("s.inactiveLobbyistStartDate").alias("inactive_lobbyist_start"),
        N.ts("s.firstPublicationDate").alias("first_publication_date"),
        N.ts("s.lastUpdateDate").alias("last_update_date"),
        F.col("s.accountHasCodexViolations").alias("account_has_codex_violations")))
    for key, table in (("activeDateRanges", "account_active_range"),
                       ("inactiveDateRanges", "account_inactive_range")):
        r = _explode(s, F.col(f"s.{key}"), "r", "o")
        f.reject_times(r, "r", ["fromDate", "untilDate"], f"account.{key}")
        f.emit(table, r.select(
            ENTRY, hid(F.col(ENTRY), table, F.col("o")).alias("id"), aid.alias("account_id"),
            F.col("o").alias("ordinal"), N.ts("r.fromDate").alias("from_date"),
            N.ts("r.untilDate").alias("until_date")))
    v = f.rows(s, F.col("s.registerEntryVersions"), "v", "o", "versions")
    f.reject_times(v, "v", ["validFromDate", "validUntilDate", "activeUntilDate"], "account.version")
    f.emit("account_register_entry_version", v.select(
        ENTRY, hid(F.col(ENTRY), "version", F.col("o")).alias("id"), aid.alias("account_id"),
        F.col("o").alias("ordinal"), F.col("v.registerEntryId").alias("register_entry_id_num"),
        F.col("v.jsonDetailUrl").alias("json_detail_url"), F.col("v.version").alias("version"),
        F.col("v.legislation").alias("legislation"),
        N.ts("v.validFromDate").alias("valid_from_date"),
        N.ts("v.validUntilDate").alias("valid_until_date"),
        N.ts("v.activeUntilDate").alias("active_until_date"),
        F.col("v.versionActiveLobbyist").alias("version_active_lobbyist")))
    cv = _explode(s, F.col("s.codexViolations"), "v", "o") \
        .filter(N.truthy_str(F.col("v.codexViolationName")))
    f.emit("codex_violation", cv.select(
        ENTRY, hid(F.col(ENTRY), "codex", F.col("o")).alias("id"), aid.alias("account_id"),
        F.col("o").alias("ordinal"), F.col("v.codexViolationName").alias("name")))


# ------------------------------------------------------------------ FLT-2
def flt_details(f: Flattener) -> None:
    s = _section(f, "registerEntryDetails")
    did = _sid("details")
    f.reject_times(s, "s", ["validFromDate", "validUntilDate"], "details")
    f.emit("register_entry_details", s.select(
        ENTRY, did.alias("id"), hid(F.col(ENTRY)).alias("entry_id"),
        F.col("s.registerEntryId").alias("register_entry_id_num"),
        F.col("s.legislation").alias("legislation"), F.col("s.version").alias("version"),
        F.col("s.detailsPageUrl").alias("details_page_url"), F.col("s.pdfUrl").alias("pdf_url"),
        N.ts("s.validFromDate").alias("valid_from_date"),
        N.ts("s.validUntilDate").alias("valid_until_date"),
        F.col("s.refusedAnything").alias("refused_anything")))
    for key, table, col in (("annualUpdate", "register_entry_annual_update", "lastAnnualUpdate"),
                            ("fiscalYearUpdate", "register_entry_fiscal_year_update",
                             "lastFiscalYearUpdate")):
        u = s.filter(N.any_field(F.col(f"s.{key}"), ["updateMissing", col]))
        f.reject_times(u, f"s.{key}", [col], f"details.{key}")
        out_col = "last_annual_update" if key == "annualUpdate" else "last_fiscal_year_update"
        f.emit(table, u.select(
            ENTRY, hid(F.col(ENTRY), table).alias("id"), did.alias("details_id"),
            F.col(f"s.{key}.updateMissing").alias("update_missing"),
            N.ts(F.col(f"s.{key}.{col}")).alias(out_col)))


def _person_gov(f: Flattener, df: DataFrame, alias: str, key: Column, site: int) -> Column:
    return f.gov(df, F.col(f"{alias}.recentGovernmentFunctionPresent"),
                 F.col(f"{alias}.recentGovernmentFunction"), key, site)


# ------------------------------------------------------------------ FLT-3
def flt_identity(f: Flattener) -> None:
    s = _section(f, "lobbyistIdentity")
    iid = _sid("identity")
    lf = F.col("s.legalForm")
    addr = f.address(s, F.col("s.address"), hid(F.col(ENTRY), "identity.address"))
    cont = f.contact(s, F.col("s.contactDetails"), hid(F.col(ENTRY), "identity.contact"))
    rgf = f.gov(s, F.col("s.recentGovernmentFunctionPresent"),
                F.col("s.recentGovernmentFunction"), hid(F.col(ENTRY), "identity.gov"), 40)
    ccr = F.col("s.capitalCityRepresentation")
    ccr_present = N.any_field(ccr, ["address", "contactDetails"])
    ccr_id = hid(F.col(ENTRY), "capital_city")
    f.emit("lobbyist_identity", s.select(
        ENTRY, iid.alias("id"), hid(F.col(ENTRY)).alias("entry_id"),
        F.col("s.identity").alias("identity"),
        f.label(s, "natural_person_type", F.col("s.naturalPersonType"), 31)
        .alias("natural_person_type_label_id"),
        F.col("s.academicDegreeBefore").alias("academic_degree_before"),
        F.col("s.academicDegreeAfter").alias("academic_degree_after"),
        F.col("s.lastName").alias("last_name"), F.col("s.firstName").alias("first_name"),
        F.col("s.commonFirstName").alias("common_first_name"),
        F.col("s.artistName").alias("artist_name"), F.col("s.companyName").alias("company_name"),
        F.col("s.recentGovernmentFunctionPresent").alias("recent_gov_function_present"),
        rgf.alias("recent_gov_function_id"), addr.alias("address_id"),
        cont.alias("contact_id"),
        f.label(s, "legal_form_type", F.col("s.legalFormType"), 32)
        .alias("legal_form_type_label_id"),
        f.label(s, "legal_form", lf, 33).alias("legal_form_label_id"),
        lf["legalFormText"].alias("legal_form_text"),
        F.when(ccr_present, ccr_id).alias("capital_city_repr_id"),
        F.col("s.entrustedPersonsPresent").alias("entrusted_persons_present"),
        F.col("s.name").alias("name_text"), F.col("s.membersPresent").alias("members_present"),
        F.col("s.membershipsPresent").alias("memberships_present")))
    c = s.filter(ccr_present)
    f.emit("capital_city_representation", c.select(
        ENTRY, ccr_id.alias("id"),
        f.address(c, ccr["address"], hid(F.col(ENTRY), "capital.address")).alias("address_id"),
        f.contact(c, ccr["contactDetails"], hid(F.col(ENTRY), "capital.contact"))
        .alias("contact_id")))

    ep = f.rows(s, F.col("s.entrustedPersons"), "p", "o", "entrusted")
    k = hid(F.col(ENTRY), "ep.gov", F.col("o"))
    f.emit("entrusted_person", ep.select(
        ENTRY, hid(F.col(ENTRY), "ep", F.col("o")).alias("id"), iid.alias("identity_id"),
        F.col("o").alias("ordinal"), F.col("p.academicDegreeBefore").alias("academic_degree_before"),
        F.col("p.academicDegreeAfter").alias("academic_degree_after"),
        F.col("p.lastName").alias("last_name"), F.col("p.firstName").alias("first_name"),
        F.col("p.artistName").alias("artist_name"),
        F.col("p.recentGovernmentFunctionPresent").alias("recent_gov_function_present"),
        _person_gov(f, ep, "p", k, 41).alias("recent_gov_function_id")))

    lr = f.rows(s, F.col("s.legalRepresentatives"), "p", "o", "representatives")
    f.emit("legal_representative", lr.select(
        ENTRY, hid(F.col(ENTRY), "lr", F.col("o")).alias("id"), iid.alias("identity_id"),
        F.col("o").alias("ordinal"), F.col("p.academicDegreeBefore").alias("academic_degree_before"),
        F.col("p.academicDegreeAfter").alias("academic_degree_after"),
        F.col("p.lastName").alias("last_name"), F.col("p.firstName").alias("first_name"),
        F.col("p.commonFirstName").alias("common_first_name"),
        F.col("p.artistName").alias("artist_name"), F.col("p.function").alias("function_text"),
        _person_gov(f, lr, "p", hid(F.col(ENTRY), "lr.gov", F.col("o")), 44)
        .alias("recent_gov_function_id"),
        # The representative's contact is read from ``contact``.
        f.contact(lr, F.col("p.contact"), hid(F.col(ENTRY), "lr.contact", F.col("o")))
        .alias("contact_id")))

    ne = _explode(s, F.col("s.namedEmployees"), "p", "o")
    f.emit("named_employee", ne.select(
        ENTRY, hid(F.col(ENTRY), "ne", F.col("o")).alias("id"), iid.alias("identity_id"),
        F.col("o").alias("ordinal"), F.col("p.academicDegreeBefore").alias("academic_degree_before"),
        F.col("p.academicDegreeAfter").alias("academic_degree_after"),
        F.col("p.lastName").alias("last_name"),
        F.col("p.commonFirstName").alias("common_first_name")))

    mc = s.filter(N.any_field(F.col("s.membersCount"),
                              ["naturalPersons", "organizations", "total", "date"]))
    f.reject(mc, N.day_invalid(F.col("s.membersCount.date")), "members_count.date", F.col("s.membersCount.date"))
    f.emit("members_count", mc.select(
        ENTRY, hid(F.col(ENTRY), "members_count").alias("id"), iid.alias("identity_id"),
        F.col("s.membersCount.naturalPersons").alias("natural_persons"),
        F.col("s.membersCount.organizations").alias("organizations"),
        F.col("s.membersCount.total").alias("total_count"),
        N.day(F.col("s.membersCount.date")).alias("date_count")))

    m = _explode(s, F.col("s.memberships"), "m", "o")
    value = F.when(F.trim(F.col("m")).startswith("{"),
                   F.get_json_object(F.col("m"), "$.membership")).otherwise(F.col("m"))
    f.emit("membership", m.select(
        ENTRY, hid(F.col(ENTRY), "membership", F.col("o")).alias("id"), iid.alias("identity_id"),
        F.col("o").alias("ordinal"), value.alias("membership")))


# ------------------------------------------------------------------ FLT-4
def flt_activities(f: Flattener) -> None:
    s = _section(f, "activitiesAndInterests")
    aid = _sid("activities")
    act = F.col("s.activity")
    f.emit("activities_interests", s.select(
        ENTRY, aid.alias("id"), hid(F.col(ENTRY)).alias("entry_id"),
        f.label(s, "activity", act, 50).alias("activity_label_id"),
        act["activityText"].alias("activity_text"),
        act["activityLegalBasis"].alias("activity_legal_basis"),
        F.col("s.activityOperationType").alias("activity_operation_type"),
        F.col("s.activityDescription").alias("activity_description")))
    t = f.rows(s, F.col("s.typesOfExercisingLobbyWork"), "x", "o", "exercising")
    f.emit("activity_exercising_type", t.select(
        ENTRY, hid(F.col(ENTRY), "exercising", F.col("o")).alias("id"), aid.alias("activities_id"),
        F.col("o").alias("ordinal"),
        f.label(t, "exercising_type", F.col("x"), 51, F.col("o")).alias("label_id")))
    fi = f.rows(s, F.col("s.fieldsOfInterest"), "x", "o", "fields")
    f.emit("field_of_interest", fi.select(
        ENTRY, hid(F.col(ENTRY), "foi", F.col("o")).alias("id"), aid.alias("activities_id"),
        F.col("o").alias("ordinal"),
        f.label(fi, "field_of_interest", F.col("x"), 52, F.col("o")).alias("label_id"),
        F.col("x.fieldOfInterestText").alias("field_of_interest_text")))
    lp = _explode(s, F.col("s.legislativeProjects"), "x", "o")
    f.emit("legislative_project", lp.select(
        ENTRY, hid(F.col(ENTRY), "legislative", F.col("o")).alias("id"),
        aid.alias("activities_id"), F.col("o").alias("ordinal"), F.col("x.name").alias("name"),
        F.col("x.printingNumber").alias("printing_number"),
        F.col("x.documentTitle").alias("document_title"),
        F.col("x.documentUrl").alias("document_url")))


def _org_columns(f: Flattener, df: DataFrame, tag: str, site: int, *ords) -> list[Column]:
    """Columns shared by client / contract-client / contractor organisations."""
    key = [F.col(ENTRY), tag, *ords]
    return [F.col("x.referenceName").alias("reference_name"),
            F.col("x.referenceDetailsPageUrl").alias("reference_details_url"),
            F.col("x.name").alias("name"),
            f.label(df, "legal_form_type", F.col("x.legalFormType"), site, *ords)
            .alias("legal_form_type_label_id"),
            f.label(df, "legal_form", F.col("x.legalForm"), site + 1, *ords)
            .alias("legal_form_label_id"),
            F.col("x.legalForm.legalFormText").alias("legal_form_text"),
            f.address(df, F.col("x.address"), hid(*key, "address")).alias("address_id"),
            f.contact(df, F.col("x.contactDetails"), hid(*key, "contact")).alias("contact_id")]


# ------------------------------------------------------------------ FLT-5
def flt_clients(f: Flattener) -> None:
    s = _section(f, "clientIdentity")
    cid = _sid("clients")
    f.emit("client_identity", s.select(
        ENTRY, cid.alias("id"), hid(F.col(ENTRY)).alias("entry_id"),
        F.col("s.clientsPresent").alias("clients_present"),
        F.col("s.clientsCount").alias("clients_count")))
    o = f.rows(s, F.col("s.clientOrganizations"), "x", "o", "client-orgs")
    org_id = hid(F.col(ENTRY), "client_org", F.col("o"))
    f.emit("client_org", o.select(
        ENTRY, org_id.alias("id"), cid.alias("client_identity_id"), F.col("o").alias("ordinal"),
        *_org_columns(f, o, "client_org", 60, F.col("o"))))
    r = f.rows(o, F.col("x.legalRepresentatives"), "r", "q", "client-org-reps")
    f.emit("client_org_legal_rep", r.select(
        ENTRY, hid(F.col(ENTRY), "client_org_rep", F.col("o"), F.col("q")).alias("id"),
        org_id.alias("client_org_id"), F.col("q").alias("ordinal"),
        F.col("r.academicDegreeBefore").alias("academic_degree_before"),
        F.col("r.academicDegreeAfter").alias("academic_degree_after"),
        F.col("r.commonFirstName").alias("common_first_name"),
        F.col("r.lastName").alias("last_name"), F.col("r.function").alias("function_text"),
        f.contact(r, F.col("r.contactDetails"),
                  hid(F.col(ENTRY), "client_org_rep.contact", F.col("o"), F.col("q")))
        .alias("contact_id")))
    p = _explode(s, F.col("s.clientPersons"), "x", "o")
    f.emit("client_person", p.select(
        ENTRY, hid(F.col(ENTRY), "client_person", F.col("o")).alias("id"),
        cid.alias("client_identity_id"), F.col("o").alias("ordinal"),
        F.col("x.referenceName").alias("reference_name"),
        F.col("x.referenceDetailsPageUrl").alias("reference_details_url"),
        F.col("x.academicDegreeBefore").alias("academic_degree_before"),
        F.col("x.academicDegreeAfter").alias("academic_degree_after"),
        F.col("x.lastName").alias("last_name"),
        F.col("x.commonFirstName").alias("common_first_name")))


def _fiscal(prefix: str = "s") -> list[Column]:
    return [F.col(f"{prefix}.relatedFiscalYearFinished").alias("related_year_finished"),
            N.day(F.col(f"{prefix}.relatedFiscalYearStart")).alias("related_year_start"),
            N.day(F.col(f"{prefix}.relatedFiscalYearEnd")).alias("related_year_end")]


def _fiscal_ym() -> list[Column]:
    return [F.col("s.fiscalYearCompleted").alias("fiscal_year_completed"),
            F.col("s.fiscalYearStart").alias("fiscal_year_start_ym"),
            F.col("s.fiscalYearEnd").alias("fiscal_year_end_ym")]


def _reject_fiscal(f: Flattener, s: DataFrame, name: str, ym: bool) -> None:
    for c in ("relatedFiscalYearStart", "relatedFiscalYearEnd"):
        f.reject(s, N.day_invalid(F.col(f"s.{c}")), f"{name}.{c}", F.col(f"s.{c}"))
    if ym:
        for c in ("fiscalYearStart", "fiscalYearEnd"):
            v = F.col(f"s.{c}")
            f.reject(s, v.isNotNull() & ~v.rlike(N.YEAR_MONTH), f"{name}.{c}", v)


# ------------------------------------------------------------------ FLT-6..11
def flt_employees(f: Flattener) -> None:
    s = _section(f, "employeesInvolvedInLobbying")
    _reject_fiscal(f, s, "employees", False)
    f.emit("employees_involved", s.select(
        ENTRY, _sid("employees").alias("id"), hid(F.col(ENTRY)).alias("entry_id"), *_fiscal(),
        F.col("s.employeesCount.from").alias("employees_from"),
        F.col("s.employeesCount.to").alias("employees_to"),
        F.col("s.employeeFTE").alias("employee_fte")))


def flt_expenses(f: Flattener) -> None:
    s = _section(f, "financialExpenses")
    _reject_fiscal(f, s, "expenses", True)
    f.emit("financial_expenses", s.select(
        ENTRY, _sid("expenses").alias("id"), hid(F.col(ENTRY)).alias("entry_id"),
        F.col("s.refuseFinancialExpensesInformation").alias("refuse_info"),
        F.col("s.refuseFinancialExpensesInformationReason").alias("refuse_reason"),
        *_fiscal(), *_fiscal_ym(),
        F.col("s.financialExpensesEuro.from").alias("expenses_from_eur"),
        F.col("s.financialExpensesEuro.to").alias("expenses_to_eur")))


def flt_funding_sources(f: Flattener) -> None:
    s = _section(f, "mainFundingSources")
    pid = _sid("funding")
    _reject_fiscal(f, s, "funding", False)
    f.emit("main_funding_sources", s.select(
        ENTRY, pid.alias("id"), hid(F.col(ENTRY)).alias("entry_id"), *_fiscal()))
    i = f.rows(s, F.col("s.mainFundingSources"), "x", "o", "funding")
    f.emit("main_funding_source_item", i.select(
        ENTRY, hid(F.col(ENTRY), "funding", F.col("o")).alias("id"), pid.alias("parent_id"),
        F.col("o").alias("ordinal"),
        f.label(i, "main_funding_source", F.col("x"), 80, F.col("o")).alias("label_id")))


def flt_allowances(f: Flattener) -> None:
    s = _section(f, "publicAllowances")
    pid = _sid("allowances")
    _reject_fiscal(f, s, "allowances", True)
    f.emit("public_allowances", s.select(
        ENTRY, pid.alias("id"), hid(F.col(ENTRY)).alias("entry_id"),
        F.col("s.refusePublicAllowancesInformation").alias("refuse_info"),
        F.col("s.refusePublicAllowancesInformationReason").alias("refuse_reason"),
        F.col("s.publicAllowancesPresent").alias("allowances_present"),
        *_fiscal(), *_fiscal_ym()))
    i = f.rows(s, F.col("s.publicAllowances"), "x", "o", "allowances")
    f.label_country(i, F.col("x.country"))
    f.emit("public_allowance_item", i.select(
        ENTRY, hid(F.col(ENTRY), "allowance", F.col("o")).alias("id"), pid.alias("parent_id"),
        F.col("o").alias("ordinal"), F.col("x.name").alias("name"),
        f.label(i, "public_allowance_type", F.col("x.type"), 90, F.col("o"))
        .alias("type_label_id"),
        N.country_id(F.col("x.country")).alias("country_id"),
        F.col("x.location").alias("location"),
        F.col("x.publicAllowanceEuro.from").alias("amount_from_eur"),
        F.col("x.publicAllowanceEuro.to").alias("amount_to_eur"),
        F.col("x.description").alias("description")))


def flt_donations(f: Flattener) -> None:
    s = _section(f, "donators")
    pid = _sid("donators")
    _reject_fiscal(f, s, "donators", True)
    f.emit("donators", s.select(
        ENTRY, pid.alias("id"), hid(F.col(ENTRY)).alias("entry_id"),
        F.col("s.refuseDonatorsInformation").alias("refuse_info"),
        F.col("s.refuseDonatorsInformationReason").alias("refuse_reason"),
        F.col("s.donatorsInformationPresent").alias("info_present"), *_fiscal(), *_fiscal_ym(),
        F.col("s.totalDonationsEuro.from").alias("total_from_eur"),
        F.col("s.totalDonationsEuro.to").alias("total_to_eur")))
    i = _explode(s, F.col("s.donators"), "x", "o")
    f.emit("donator_item", i.select(
        ENTRY, hid(F.col(ENTRY), "donator", F.col("o")).alias("id"), pid.alias("parent_id"),
        F.col("o").alias("ordinal"), F.col("x.name").alias("name"),
        F.col("x.donationEuro.from").alias("amount_from_eur"),
        F.col("x.donationEuro.to").alias("amount_to_eur"),
        F.col("x.description").alias("description")))


def flt_membership_fees(f: Flattener) -> None:
    s = _section(f, "membershipFees")
    pid = _sid("fees")
    _reject_fiscal(f, s, "fees", False)
    f.emit("membership_fees", s.select(
        ENTRY, pid.alias("id"), hid(F.col(ENTRY)).alias("entry_id"), *_fiscal(),
        F.col("s.totalMembershipFees.from").alias("total_from_eur"),
        F.col("s.totalMembershipFees.to").alias("total_to_eur"),
        F.col("s.individualContributorsPresent").alias("individual_contributors_present")))
    i = _explode(s, F.col("s.individualContributors"), "x", "o")
    f.emit("individual_contributor", i.select(
        ENTRY, hid(F.col(ENTRY), "contributor", F.col("o")).alias("id"), pid.alias("fees_id"),
        F.col("o").alias("ordinal"), F.col("x.name").alias("name")))


# ------------------------------------------------------------------ FLT-12
def flt_annual_reports(f: Flattener) -> None:
    s = _section(f, "annualReports")
    for c in ("lastFiscalYearStart", "lastFiscalYearEnd", "previousLastFiscalYearStart",
              "previousLastFiscalYearEnd"):
        f.reject(s, N.day_invalid(F.col(f"s.{c}")), f"annual_reports.{c}", F.col(f"s.{c}"))
    f.emit("annual_reports", s.select(
        ENTRY, _sid("annual_reports").alias("id"), hid(F.col(ENTRY)).alias("entry_id"),
        F.col("s.disclosureRequirementsExist").alias("disclosure_requirements_exist"),
        F.col("s.refuseAnnualFinanceStatement").alias("refuse_annual_fin_stmt"),
        F.col("s.refuseAnnualFinanceStatementReason").alias("refuse_annual_fin_stmt_reason"),
        F.col("s.annualReportExists").alias("annual_report_exists"),
        F.col("s.annualReportLastFiscalYearExists").alias("annual_report_last_fy_exists"),
        F.col("s.annualReportPreviousLastFiscalYearExists")
        .alias("annual_report_prev_last_fy_exists"),
        F.col("s.finishedFiscalYearExists").alias("finished_fy_exists"),
        N.day("s.lastFiscalYearStart").alias("last_fy_start"),
        N.day("s.lastFiscalYearEnd").alias("last_fy_end"),
        N.day("s.previousLastFiscalYearStart").alias("prev_last_fy_start"),
        N.day("s.previousLastFiscalYearEnd").alias("prev_last_fy_end"),
        F.col("s.annualReportPdfUrl").alias("annual_report_pdf_url"),
        F.col("s.missingAnnualReportReason").alias("missing_annual_report_reason"),
        F.col("s.reportWasPublishedElsewhere").alias("report_was_published_elsewhere"),
        F.col("s.locationOfReportPublication").alias("location_of_report_publication")))


def _ministries(f: Flattener, df: DataFrame, arr: Column, link: str, parent: Column,
                tag: str, extra: list[Column] | None = None) -> None:
    """leading_ministry rows (one per occurrence) and their link rows."""
    m = f.rows(df, arr, "m", "mo", link)
    mid = hid(F.col(ENTRY), tag, *[F.col(c) for c in df.columns if c.startswith("o")],
              F.col("mo"))
    f.emit("leading_ministry", m.select(
        ENTRY, mid.alias("id"), F.col("m.title").alias("title"),
        F.col("m.shortTitle").alias("short_title"), F.col("m.url").alias("url"),
        F.col("m.electionPeriod").alias("election_period")))
    f.emit(link, m.select(
        ENTRY, hid(mid, "link").alias("id"), parent, F.col("mo").alias("ordinal"),
        mid.alias("ministry_id"), *(extra or [])))


# ------------------------------------------------------------------ FLT-13
def flt_projects(f: Flattener) -> None:
    s = _section(f, "regulatoryProjects")
    pid = _sid("projects")
    f.emit("regulatory_projects", s.select(
        ENTRY, pid.alias("id"), hid(F.col(ENTRY)).alias("entry_id"),
        F.col("s.regulatoryProjectsPresent").alias("projects_present"),
        F.col("s.regulatoryProjectsCount").alias("projects_count")))
    p = f.rows(s, F.col("s.regulatoryProjects"), "x", "o", "projects")
    item = hid(F.col(ENTRY), "project", F.col("o"))
    f.emit("regulatory_project_item", p.select(
        ENTRY, item.alias("id"), pid.alias("parent_id"), F.col("o").alias("ordinal"),
        F.col("x.regulatoryProjectNumber").alias("regulatory_project_number"),
        F.col("x.title").alias("title"),
        F.col("x.printedMattersPresent").alias("printed_matters_present"),
        F.col("x.draftBillPresent").alias("draft_bill_present"),
        F.col("x.description").alias("description")))
    pm = f.rows(p, F.col("x.printedMatters"), "pm", "o2", "matters")
    matter = hid(F.col(ENTRY), "matter", F.col("o"), F.col("o2"))
    f.emit("reg_project_printed_matter", pm.select(
        ENTRY, matter.alias("id"), item.alias("project_item_id"), F.col("o2").alias("ordinal"),
        F.col("pm.title").alias("title"), F.col("pm.printingNumber").alias("printing_number"),
        F.col("pm.issuer").alias("issuer"), F.col("pm.documentUrl").alias("document_url"),
        F.col("pm.projectUrl").alias("project_url")))
    _ministries(f, pm.select(ENTRY, SEQ, "o", "o2", "pm"), F.col("pm.leadingMinistries"),
                "reg_project_printed_matter_ministry", matter.alias("printed_matter_id"),
                "matter.ministry")
    mig = pm.filter(N.any_field(F.col("pm.migratedDraftBill"),
                                ["title", "publicationDate", "leadingMinistries"]))
    mig_id = hid(F.col(ENTRY), "migrated", F.col("o"), F.col("o2"))
    f.reject(mig, N.day_invalid(F.col("pm.migratedDraftBill.publicationDate")), "migrated.date", F.col("pm.migratedDraftBill.publicationDate"))
    f.emit("migrated_draft_bill", mig.select(
        ENTRY, mig_id.alias("id"), matter.alias("printed_matter_id"),
        F.col("pm.migratedDraftBill.title").alias("title"),
        N.day(F.col("pm.migratedDraftBill.publicationDate")).alias("publication_date")))
    _ministries(f, mig.select(ENTRY, SEQ, "o", "o2", "pm"),
                F.col("pm.migratedDraftBill.leadingMinistries"), "migrated_draft_bill_ministry",
                mig_id.alias("migrated_db_id"), "migrated.ministry",
                [F.col("m.draftBillDocumentUrl").alias("draft_bill_document_url"),
                 F.col("m.draftBillProjectUrl").alias("draft_bill_project_url")])
    db = p.filter((F.col("x.draftBillPresent") == F.lit(True))
                  & N.any_field(F.col("x.draftBill"), _fields(["regulatoryProjects",
                                                               "regulatoryProjects",
                                                               "draftBill"])))
    db_id = hid(F.col(ENTRY), "draft", F.col("o"))
    for c in ("publicationDate", "customDate"):
        f.reject(db, N.day_invalid(F.col(f"x.draftBill.{c}")), f"draft_bill.{c}", F.col(f"x.draftBill.{c}"))
    f.emit("draft_bill", db.select(
        ENTRY, db_id.alias("id"), item.alias("project_item_id"),
        F.col("x.draftBill.title").alias("title"),
        N.day(F.col("x.draftBill.publicationDate")).alias("publication_date"),
        F.col("x.draftBill.customTitle").alias("custom_title"),
        N.day(F.col("x.draftBill.customDate")).alias("custom_date")))
    # The draft bill's ministry links carry no URLs (not loaded for this path).
    _ministries(f, db.select(ENTRY, SEQ, "o", "x"), F.col("x.draftBill.leadingMinistries"),
                "draft_bill_ministry", db_id.alias("draft_bill_id"), "draft.ministry")
    law = _explode(p, F.col("x.affectedLaws"), "l", "o2")
    f.emit("reg_project_affected_law", law.select(
        ENTRY, hid(F.col(ENTRY), "law", F.col("o"), F.col("o2")).alias("id"),
        item.alias("project_item_id"), F.col("o2").alias("ordinal"),
        F.col("l.title").alias("title"), F.col("l.shortTitle").alias("short_title"),
        F.col("l.url").alias("url")))
    fi = f.rows(p, F.col("x.fieldsOfInterest"), "l", "o2", "project-fields")
    # The free text of a project's topic is not loaded (always NULL).
    f.emit("reg_project_field_of_interest", fi.select(
        ENTRY, hid(F.col(ENTRY), "project.foi", F.col("o"), F.col("o2")).alias("id"),
        item.alias("project_item_id"), F.col("o2").alias("ordinal"),
        f.label(fi, "field_of_interest", F.col("l"), 130, F.col("o"), F.col("o2"))
        .alias("label_id")))


# ------------------------------------------------------------------ FLT-14
def flt_statements(f: Flattener) -> None:
    s = _section(f, "statements")
    pid = _sid("statements")
    f.emit("statements", s.select(
        ENTRY, pid.alias("id"), hid(F.col(ENTRY)).alias("entry_id"),
        F.col("s.statementsPresent").alias("statements_present"),
        F.col("s.statementsCount").alias("statements_count")))
    st = f.rows(s, F.col("s.statements"), "x", "o", "statement-items")
    item = hid(F.col(ENTRY), "statement", F.col("o"))
    first = F.element_at(F.col("x.recipientGroups"), 1)["sendingDate"]
    f.reject(st, N.day_invalid(first), "statement.sending_date", first)
    f.emit("statement_item", st.select(
        ENTRY, item.alias("id"), pid.alias("parent_id"), F.col("o").alias("ordinal"),
        F.col("x.statementNumber").alias("statement_number"),
        F.col("x.regulatoryProjectNumber").alias("regulatory_project_number"),
        F.col("x.regulatoryProjectTitle").alias("regulatory_project_title"),
        F.col("x.pdfUrl").alias("pdf_url"), F.col("x.pdfPageCount").alias("pdf_page_count"),
        F.col("x.text.copyrightAcknowledgement").alias("copyright_acknowledgement"),
        F.col("x.text.text").alias("text_body"),
        # Only the first recipient group's date is kept.
        N.day(first).alias("sending_date")))
    g = f.rows(st, F.col("x.recipientGroups"), "g", "o2", "groups")
    gid = hid(F.col(ENTRY), "group", F.col("o"), F.col("o2"))
    f.emit("statement_recipient_group", g.select(
        ENTRY, gid.alias("id"), item.alias("statement_item_id"), F.col("o2").alias("ordinal")))
    pa = f.rows(g, F.col("g.recipients.parliament"), "l", "o3", "parliament")
    f.emit("statement_recipient_parliament", pa.select(
        ENTRY, hid(F.col(ENTRY), "parliament", F.col("o"), F.col("o2"), F.col("o3")).alias("id"),
        gid.alias("group_id"), F.col("o3").alias("ordinal"),
        f.label(pa, "recipient_parliament", F.col("l"), 140, F.col("o"), F.col("o2"),
                F.col("o3")).alias("label_id")))
    fg = f.rows(g, F.col("g.recipients.federalGovernment"), "d", "o3", "federal")
    dep = hid(F.col(ENTRY), "statement.department", F.col("o"), F.col("o2"), F.col("o3"))
    # A department row is written for every entry of the list, even empty.
    f.emit("department", fg.select(
        ENTRY, dep.alias("id"), F.col("d.department.title").alias("title"),
        F.col("d.department.shortTitle").alias("short_title"),
        F.col("d.department.url").alias("url"),
        F.col("d.department.electionPeriod").alias("election_period")))
    f.emit("statement_recipient_federal_gov", fg.select(
        ENTRY, hid(dep, "link").alias("id"), gid.alias("group_id"),
        F.col("o3").alias("ordinal"), dep.alias("department_id")))


def _financial_resources(f: Flattener, df: DataFrame, table: str, parent: str,
                         parent_id: Column) -> None:
    """FLT-16: a row only if any value is truthy (0, false, '' do not count)."""
    r = F.col("x.financialResourcesReceived")
    any_truthy = ((r["lastFiscalYearFinished"] == F.lit(True))
                  | N.truthy_str(r["lastFiscalYearStart"]) | N.truthy_str(r["lastFiscalYearEnd"])
                  | (F.coalesce(r["from"], F.lit(0)) != 0) | (F.coalesce(r["to"], F.lit(0)) != 0))
    x = df.filter(r.isNotNull() & any_truthy)
    f.reject_times(x, "x.financialResourcesReceived", ["lastFiscalYearStart", "lastFiscalYearEnd"], "resources",
                   N.day_invalid)
    f.emit(table, x.select(
        ENTRY, hid(parent_id, "resources").alias("id"), parent_id.alias(parent),
        r["lastFiscalYearFinished"].alias("last_fiscal_year_finished"),
        N.day(r["lastFiscalYearStart"]).alias("last_fiscal_year_start"),
        N.day(r["lastFiscalYearEnd"]).alias("last_fiscal_year_end"),
        r["from"].alias("amount_from_eur"), r["to"].alias("amount_to_eur")))


def _gov_person(prefix: str) -> list[Column]:
    return [F.col(f"{prefix}.academicDegreeBefore").alias("academic_degree_before"),
            F.col(f"{prefix}.academicDegreeAfter").alias("academic_degree_after"),
            F.col(f"{prefix}.firstName").alias("first_name"),
            F.col(f"{prefix}.lastName").alias("last_name"),
            F.col(f"{prefix}.artistName").alias("artist_name")]


# ------------------------------------------------------------------ FLT-15
def flt_contracts(f: Flattener) -> None:
    s = _section(f, "contracts")
    pid = _sid("contracts")
    f.emit("contracts", s.select(
        ENTRY, pid.alias("id"), hid(F.col(ENTRY)).alias("entry_id"),
        F.col("s.contractsPresent").alias("contracts_present"),
        F.col("s.contractsCount").alias("contracts_count")))
    c = f.rows(s, F.col("s.contracts"), "ct", "o", "contract-items")
    item = hid(F.col(ENTRY), "contract", F.col("o"))
    f.emit("contract_item", c.select(
        ENTRY, item.alias("id"), pid.alias("parent_id"), F.col("o").alias("ordinal"),
        F.col("ct.description").alias("description")))
    fi = f.rows(c, F.col("ct.fieldsOfInterest"), "l", "o2", "contract-fields")
    f.emit("contract_field_of_interest", fi.select(
        ENTRY, hid(F.col(ENTRY), "contract.foi", F.col("o"), F.col("o2")).alias("id"),
        item.alias("contract_item_id"), F.col("o2").alias("ordinal"),
        f.label(fi, "field_of_interest", F.col("l"), 150, F.col("o"), F.col("o2"))
        .alias("label_id"),
        F.col("l.fieldOfInterestText").alias("field_of_interest_text")))
    rp = _explode(c, F.col("ct.regulatoryProjects"), "r", "o2")
    f.emit("contract_reg_project_ref", rp.select(
        ENTRY, hid(F.col(ENTRY), "contract.ref", F.col("o"), F.col("o2")).alias("id"),
        item.alias("contract_item_id"), F.col("o2").alias("ordinal"),
        F.col("r.regulatoryProjectNumber").alias("regulatory_project_number"),
        F.col("r.regulatoryProjectTitle").alias("regulatory_project_title")))

    # Exactly one clients row and one contractors row per contract.
    clients = hid(F.col(ENTRY), "contract.clients", F.col("o"))
    f.emit("contract_clients", c.select(ENTRY, clients.alias("id"),
                                        item.alias("contract_item_id")))
    co = f.rows(c, F.col("ct.clients.clientOrganizations"), "x", "o2", "contract-client-orgs")
    co_id = hid(F.col(ENTRY), "contract.client_org", F.col("o"), F.col("o2"))
    f.emit("contract_client_org", co.select(
        ENTRY, co_id.alias("id"), clients.alias("clients_id"), F.col("o2").alias("ordinal"),
        *_org_columns(f, co, "contract.client_org", 151, F.col("o"), F.col("o2"))))
    cr = _explode(co, F.col("x.legalRepresentatives"), "r", "o3")
    f.emit("contract_client_org_legal_rep", cr.select(
        ENTRY, hid(co_id, "rep", F.col("o3")).alias("id"), co_id.alias("client_org_id"),
        F.col("o3").alias("ordinal"), *_gov_person("r"),
        F.col("r.function").alias("function_text")))
    _financial_resources(f, co, "contract_client_org_financial_resources", "client_org_id", co_id)
    cp = f.rows(c, F.col("ct.clients.clientPersons"), "x", "o2", "contract-client-persons")
    cp_id = hid(F.col(ENTRY), "contract.client_person", F.col("o"), F.col("o2"))
    f.emit("contract_client_person", cp.select(
        ENTRY, cp_id.alias("id"), clients.alias("clients_id"), F.col("o2").alias("ordinal"),
        F.col("x.referenceName").alias("reference_name"),
        F.col("x.referenceDetailsPageUrl").alias("reference_details_url"),
        F.col("x.academicDegreeBefore").alias("academic_degree_before"),
        F.col("x.academicDegreeAfter").alias("academic_degree_after"),
        F.col("x.lastName").alias("last_name"), F.col("x.firstName").alias("first_name"),
        F.col("x.artistName").alias("artist_name"), F.col("x.companyName").alias("company_name")))
    _financial_resources(f, cp, "contract_client_person_financial_resources", "client_person_id",
                         cp_id)

    ctr = hid(F.col(ENTRY), "contract.contractors", F.col("o"))
    f.emit("contract_contractors", c.select(
        ENTRY, ctr.alias("id"), item.alias("contract_item_id"),
        F.col("ct.contractors.lobbyingIsCarriedOutByLobbyist")
        .alias("lobbying_is_carried_out_by_lobbyist")))
    ep = f.rows(c, F.col("ct.contractors.entrustedPersons"), "p", "o2", "contractor-entrusted")
    f.emit("contractor_entrusted_person", ep.select(
        ENTRY, hid(ctr, "ep", F.col("o2")).alias("id"), ctr.alias("contractors_id"),
        F.col("o2").alias("ordinal"), *_gov_person("p"), F.col("p.function").alias("function_text"),
        F.col("p.recentGovernmentFunctionPresent").alias("recent_gov_function_present"),
        _person_gov(f, ep, "p", hid(ctr, "ep.gov", F.col("o2")), 152)
        .alias("recent_gov_function_id")))
    org = f.rows(c, F.col("ct.contractors.contractorOrganizations"), "x", "o2", "contractor-orgs")
    org_id = hid(ctr, "org", F.col("o2"))
    ccr = F.col("x.capitalCityRepresentation")
    has_ccr = N.any_field(ccr, ["address", "contactDetails"])
    ccr_rows = org.filter(has_ccr)
    f.emit("contractor_org", org.select(
        ENTRY, org_id.alias("id"), ctr.alias("contractors_id"), F.col("o2").alias("ordinal"),
        *_org_columns(f, org, "contractor_org", 160, F.col("o"), F.col("o2")),
        F.when(has_ccr, f.address(ccr_rows, ccr["address"], hid(org_id, "ccr.address")))
        .alias("capital_city_repr_address_id"),
        F.when(has_ccr, f.contact(ccr_rows, ccr["contactDetails"], hid(org_id, "ccr.contact")))
        .alias("capital_city_repr_contact_id")))
    olr = f.rows(org, F.col("x.legalRepresentatives"), "p", "o3", "contractor-org-reps")
    f.emit("contractor_org_legal_rep", olr.select(
        ENTRY, hid(org_id, "rep", F.col("o3")).alias("id"), org_id.alias("contractor_org_id"),
        F.col("o3").alias("ordinal"), *_gov_person("p"),
        F.col("p.function").alias("function_text"),
        F.col("p.recentGovernmentFunctionPresent").alias("recent_gov_function_present"),
        _person_gov(f, olr, "p", hid(org_id, "rep.gov", F.col("o3")), 165)
        .alias("recent_gov_function_id")))
    # Assigned persons hang on the contractors wrapper; ordinals restart per
    # organisation.
    ap = f.rows(org, F.col("x.assignedPersons"), "p", "o3", "assigned")
    f.emit("assigned_person", ap.select(
        ENTRY, hid(org_id, "assigned", F.col("o3")).alias("id"), ctr.alias("contractors_id"),
        F.col("o3").alias("ordinal"), *_gov_person("p"),
        F.col("p.recentGovernmentFunctionPresent").alias("recent_gov_function_present"),
        _person_gov(f, ap, "p", hid(org_id, "assigned.gov", F.col("o3")), 168)
        .alias("recent_gov_function_id")))
    cpn = f.rows(c, F.col("ct.contractors.contractorPersons"), "p", "o2", "contractor-persons")
    f.emit("contractor_person", cpn.select(
        ENTRY, hid(ctr, "person", F.col("o2")).alias("id"), ctr.alias("contractors_id"),
        F.col("o2").alias("ordinal"), F.col("p.referenceName").alias("reference_name"),
        F.col("p.referenceDetailsPageUrl").alias("reference_details_url"),
        F.col("p.academicDegreeBefore").alias("academic_degree_before"),
        F.col("p.academicDegreeAfter").alias("academic_degree_after"),
        F.col("p.lastName").alias("last_name"), F.col("p.firstName").alias("first_name"),
        F.col("p.artistName").alias("artist_name"), F.col("p.companyName").alias("company_name"),
        F.col("p.recentGovernmentFunctionPresent").alias("recent_gov_function_present"),
        _person_gov(f, cpn, "p", hid(ctr, "person.gov", F.col("o2")), 171)
        .alias("recent_gov_function_id")))


# ------------------------------------------------------------------ FLT-17
def flt_code_of_conduct(f: Flattener) -> None:
    s = _section(f, "codeOfConduct")
    f.emit("code_of_conduct", s.select(
        ENTRY, _sid("code_of_conduct").alias("id"), hid(F.col(ENTRY)).alias("entry_id"),
        F.col("s.ownCodeOfConduct").alias("own_code_of_conduct"),
        F.col("s.codeOfConductPdfUrl").alias("code_of_conduct_pdf_url")))


SECTION_FLATTENERS = {
    "accountDetails": flt_account,
    "registerEntryDetails": flt_details,
    "lobbyistIdentity": flt_identity,
    "activitiesAndInterests": flt_activities,
    "clientIdentity": flt_clients,
    "employeesInvolvedInLobbying": flt_employees,
    "financialExpenses": flt_expenses,
    "mainFundingSources": flt_funding_sources,
    "publicAllowances": flt_allowances,
    "donators": flt_donations,
    "membershipFees": flt_membership_fees,
    "annualReports": flt_annual_reports,
    "regulatoryProjects": flt_projects,
    "statements": flt_statements,
    "contracts": flt_contracts,
    "codeOfConduct": flt_code_of_conduct,
}
assert list(SECTION_FLATTENERS) == SECTION_ORDER


# ------------------------------------------------------- dimension tables
def _dimension_tables(f: Flattener) -> None:
    if f.addresses:
        a = f.cut(_union(f.addresses), "address")
        f.label_country(a, F.col("a.country"))
        f.emit("address", a.select(
            ENTRY, "id", F.col("a.type").alias("kind"),
            F.col("a.nationalAdditional1").alias("national_additional1"),
            F.col("a.nationalAdditional2").alias("national_additional2"),
            F.col("a.internationalAdditional1").alias("international_additional1"),
            F.col("a.internationalAdditional2").alias("international_additional2"),
            F.col("a.street").alias("street"), F.col("a.streetNumber").alias("street_number"),
            F.col("a.zipCode").alias("zip_code"), F.col("a.city").alias("city"),
            F.col("a.postBox").alias("post_box"),
            N.country_id(F.col("a.country")).alias("country_id")))
    if f.contacts:
        c = f.cut(_union(f.contacts), "contact")
        f.emit("contact", c.select(ENTRY, "id", N.phone(F.col("c")).alias("phone_number")))
        for key, table in (("emails", "contact_email"), ("websites", "contact_website")):
            col = "email" if key == "emails" else "website"
            x = c.select(ENTRY, F.col("id").alias("contact_id"),
                         F.explode(N.simple_list(F.col(f"c.{key}"), col)).alias("v"))
            f.emit(table, x.select(
                ENTRY, hid(F.col("contact_id"), col, F.col("v.ordinal")).alias("id"),
                "contact_id", F.col("v.ordinal").alias("ordinal"), F.col("v.value").alias(col)))
    if f.gov_functions:
        g = f.cut(_union(f.gov_functions), "gov-function")
        type_id = f.label(g, "recent_gov_function_type", F.col("g.type"), F.col("site"))
        house_fn = f.label(g, "house_reps_function", F.col("g.houseOfRepresentatives.function"), F.col("site") + 1)
        fed_fn = f.label(g, "federal_gov_function", F.col("g.federalGovernment.function"), F.col("site") + 2)
        f.emit("recent_government_function", g.select(
            ENTRY, "id", F.col("g.ended").alias("ended"),
            N.year_month(F.col("g.endDate")).alias("end_year_month"), type_id.alias("type_label_id")))
        house = g.filter(F.col("g.houseOfRepresentatives").isNotNull() & house_fn.isNotNull())
        f.emit("recent_gov_house_reps", house.select(
            ENTRY, hid(F.col("id"), "house").alias("id"), F.col("id").alias("recent_gov_fn_id"),
            house_fn.alias("function_label_id"),
            F.col("g.houseOfRepresentatives.functionPosition").alias("function_position")))
        fed = g.filter(F.col("g.federalGovernment").isNotNull() & fed_fn.isNotNull())
        dep = F.col("g.federalGovernment.department")
        has_dep = N.any_field(dep, ["title", "shortTitle", "url", "electionPeriod"])
        dep_id = hid(F.col("id"), "department")
        f.emit("department", fed.filter(has_dep).select(
            ENTRY, dep_id.alias("id"), dep["title"].alias("title"),
            dep["shortTitle"].alias("short_title"), dep["url"].alias("url"),
            dep["electionPeriod"].alias("election_period")))
        f.emit("recent_gov_federal_gov", fed.select(
            ENTRY, hid(F.col("id"), "federal").alias("id"), F.col("id").alias("recent_gov_fn_id"),
            fed_fn.alias("function_label_id"),
            F.when(has_dep, dep_id).alias("department_id")))
        adm = g.filter(F.col("g.federalAdministration").isNotNull())
        fa = F.col("g.federalAdministration")
        f.emit("recent_gov_federal_admin", adm.select(
            ENTRY, hid(F.col("id"), "admin").alias("id"), F.col("id").alias("recent_gov_fn_id"),
            fa["supremeFederalAuthority"].alias("supreme_federal_authority"),
            fa["supremeFederalAuthorityShort"].alias("supreme_federal_authority_short"),
            fa["supremeFederalAuthorityElectionPeriod"]
            .alias("supreme_federal_authority_elect_prd"),
            fa["function"].alias("function_text")))


def _union(dfs: list[DataFrame]) -> DataFrame:
    out = dfs[0]
    for d in dfs[1:]:
        out = out.unionByName(d, allowMissingColumns=True)
    return out


def label_dimensions(uses: DataFrame, cut: Callable[[DataFrame, str], DataFrame] = lambda df, name: df
                     ) -> tuple[DataFrame, DataFrame]:
    """NRM-6 / NRM-7: code_label and country_label from all label uses, which are aggregated once if ``cut``.

    "First writer wins, later writers only fill NULL labels": per key the
    text of the first use if it is not NULL (even ''), else the first
    non-empty text of a later use.  ``min_by`` over the use order is a
    partial aggregate, so a label used by a third of all entries costs one
    small state per partition, not a third of the rows in one task.
    """
    def first_writer(c: str) -> Column:
        filled = F.when(N.truthy_str(F.col(c)), F.col("seq"))
        return F.coalesce(F.min_by(F.col(c), F.col("seq")),
                          F.min_by(F.when(N.truthy_str(F.col(c)), F.col(c)), filled))
    dims = cut(uses.groupBy("domain", "code")
               .agg(first_writer("de").alias("de"), first_writer("en").alias("en")), "labels")
    code_label = dims.filter(F.col("domain") != "__country__").select(
        hid(F.col("domain"), F.col("code")).alias("id"), "domain", "code", "de", "en")
    country = dims.filter(F.col("domain") == "__country__").select(
        hid(F.lit("country"), F.col("code")).alias("id"), "code", "de", "en")
    return code_label, country


def flatten_entries(docs: DataFrame, cut: Callable[[DataFrame, str], DataFrame] | None = None
                    ) -> tuple[dict[str, DataFrame], DataFrame, list[DataFrame]]:
    """FLT-18: all sections in registry order.

    ``docs`` has ``_entry`` (register number), ``_seq`` (first-seen order)
    and ``e`` (the entry struct); ``cut`` cuts the lineage of a DataFrame under a name.
    Returns (tables keyed by name with an ``_entry`` column, label uses, the rejects of
    each set of checked rows).
    """
    cut = cut or (lambda df, name: df)

    def flattened(flat: Callable[[Flattener], None]) -> Flattener:
        one = Flattener(docs, cut)
        flat(one)
        return one

    f = Flattener(docs, cut)
    # The sections share nothing; cut, each is a chain of small jobs.  Those with most fields have the longest chains.
    order = sorted(SECTION_ORDER, key=lambda name: -len(entry_schema()[name].dataType.simpleString()))
    with ThreadPoolExecutor(max_workers=PARALLEL) as pool:
        found = {name: pool.submit(flattened, SECTION_FLATTENERS[name]) for name in order}
        f.add(flattened(flt_register_entry))
        for name in SECTION_ORDER:
            f.add(found[name].result())
    _dimension_tables(f)
    from civicflow.sources.store import violations

    def table(name: str) -> DataFrame:
        return conform(_union(f.tables[name]), name).select(*[c for c, *_ in TABLES[name]], ENTRY)
    with ThreadPoolExecutor(max_workers=PARALLEL) as pool:
        tables = dict(zip(f.tables, pool.map(table, f.tables)))
        rejects = list(pool.map(lambda x: violations(*x), f.rejects.values()))
    return tables, f.label_uses(), rejects
