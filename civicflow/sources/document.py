"""Explicit schema of the register's JSON pages and entries.

Pages are read with this schema — never inferred — in PERMISSIVE mode with a
corrupt-record column.  Fields whose JSON shape varies (a list of strings or
of objects, or a bare value) are declared STRING: Spark then keeps the raw
JSON text of a list or object, and ``civicflow.functions.normalize`` parses
it.  Names are the API's keys.
"""

from __future__ import annotations

from functools import lru_cache

from pyspark.sql import types as T

# Reusable shapes (DDL fragments).
LABEL = "STRUCT<code: STRING, de: STRING, en: STRING>"
FIELD = "STRUCT<code: STRING, de: STRING, en: STRING, fieldOfInterestText: STRING>"
LEGAL_FORM = "STRUCT<code: STRING, de: STRING, en: STRING, legalFormText: STRING>"
ACTIVITY = ("STRUCT<code: STRING, de: STRING, en: STRING, activityText: STRING, "
            "activityLegalBasis: STRING>")
RANGE = "STRUCT<`from`: BIGINT, `to`: BIGINT>"
ADDRESS = ("STRUCT<type: STRING, nationalAdditional1: STRING, nationalAdditional2: STRING, "
           "internationalAdditional1: STRING, internationalAdditional2: STRING, street: STRING, "
           f"streetNumber: STRING, zipCode: STRING, city: STRING, postBox: STRING, country: {LABEL}>")
CONTACT = "STRUCT<phoneNumber: STRING, phone: STRING, emails: STRING, websites: STRING>"
MINISTRY = "STRUCT<title: STRING, shortTitle: STRING, url: STRING, electionPeriod: INT>"
GOV_FUNCTION = (
    f"STRUCT<type: {LABEL}, ended: BOOLEAN, endDate: STRING, "
    f"houseOfRepresentatives: STRUCT<function: {LABEL}, functionPosition: STRING>, "
    f"federalGovernment: STRUCT<function: {LABEL}, department: {MINISTRY}>, "
    "federalAdministration: STRUCT<supremeFederalAuthority: STRING, "
    "supremeFederalAuthorityShort: STRING, supremeFederalAuthorityElectionPeriod: INT, "
    "function: STRING>>")
GOV = f"recentGovernmentFunctionPresent: BOOLEAN, recentGovernmentFunction: {GOV_FUNCTION}"
DEGREES = "academicDegreeBefore: STRING, academicDegreeAfter: STRING"
FIN_RESOURCES = ("STRUCT<lastFiscalYearFinished: BOOLEAN, lastFiscalYearStart: STRING, "
                 "lastFiscalYearEnd: STRING, `from`: BIGINT, `to`: BIGINT>")
FISCAL = ("relatedFiscalYearFinished: BOOLEAN, relatedFiscalYearStart: STRING, "
          "relatedFiscalYearEnd: STRING")
FISCAL_YM = "fiscalYearCompleted: BOOLEAN, fiscalYearStart: STRING, fiscalYearEnd: STRING"
ORG = (f"referenceName: STRING, referenceDetailsPageUrl: STRING, name: STRING, "
       f"legalFormType: {LABEL}, legalForm: {LEGAL_FORM}, address: {ADDRESS}, "
       f"contactDetails: {CONTACT}")

SECTIONS: list[tuple[str, str]] = [
    ("accountDetails", (
        "STRUCT<activeLobbyist: BOOLEAN, inactiveLobbyistStartDate: STRING, "
        "firstPublicationDate: STRING, lastUpdateDate: STRING, accountHasCodexViolations: BOOLEAN, "
        "activeDateRanges: ARRAY<STRUCT<fromDate: STRING, untilDate: STRING>>, "
        "inactiveDateRanges: ARRAY<STRUCT<fromDate: STRING, untilDate: STRING>>, "
        "registerEntryVersions: ARRAY<STRUCT<registerEntryId: BIGINT, jsonDetailUrl: STRING, "
        "version: INT, legislation: STRING, validFromDate: STRING, validUntilDate: STRING, "
        "activeUntilDate: STRING, versionActiveLobbyist: BOOLEAN>>, "
        "codexViolations: ARRAY<STRUCT<codexViolationName: STRING>>>")),
    ("registerEntryDetails", (
        "STRUCT<registerEntryId: BIGINT, legislation: STRING, version: INT, "
        "detailsPageUrl: STRING, pdfUrl: STRING, validFromDate: STRING, validUntilDate: STRING, "
        "refusedAnything: BOOLEAN, "
        "annualUpdate: STRUCT<updateMissing: BOOLEAN, lastAnnualUpdate: STRING>, "
        "fiscalYearUpdate: STRUCT<updateMissing: BOOLEAN, lastFiscalYearUpdate: STRING>>")),
    ("lobbyistIdentity", (
        f"STRUCT<identity: STRING, naturalPersonType: {LABEL}, {DEGREES}, lastName: STRING, "
        "firstName: STRING, commonFirstName: STRING, artistName: STRING, companyName: STRING, "
        f"name: STRING, {GOV}, address: {ADDRESS}, contactDetails: {CONTACT}, "
        f"legalFormType: {LABEL}, legalForm: {LEGAL_FORM}, "
        f"capitalCityRepresentation: STRUCT<address: {ADDRESS}, contactDetails: {CONTACT}>, "
        "entrustedPersonsPresent: BOOLEAN, "
        f"entrustedPersons: ARRAY<STRUCT<{DEGREES}, lastName: STRING, firstName: STRING, "
        f"artistName: STRING, {GOV}>>, "
        f"legalRepresentatives: ARRAY<STRUCT<{DEGREES}, lastName: STRING, firstName: STRING, "
        "commonFirstName: STRING, artistName: STRING, function: STRING, "
        f"{GOV}, contact: {CONTACT}>>, "
        f"namedEmployees: ARRAY<STRUCT<{DEGREES}, lastName: STRING, commonFirstName: STRING>>, "
        "membersPresent: BOOLEAN, membersCount: STRUCT<naturalPersons: INT, organizations: INT, "
        "total: INT, date: STRING>, membershipsPresent: BOOLEAN, memberships: ARRAY<STRING>>")),
    ("activitiesAndInterests", (
        f"STRUCT<activity: {ACTIVITY}, activityOperationType: STRING, "
        f"activityDescription: STRING, typesOfExercisingLobbyWork: ARRAY<{LABEL}>, "
        f"fieldsOfInterest: ARRAY<{FIELD}>, legislativeProjects: ARRAY<STRUCT<name: STRING, "
        "printingNumber: STRING, documentTitle: STRING, documentUrl: STRING>>>")),
    ("clientIdentity", (
        "STRUCT<clientsPresent: BOOLEAN, clientsCount: INT, "
        f"clientOrganizations: ARRAY<STRUCT<{ORG}, legalRepresentatives: ARRAY<STRUCT<"
        f"{DEGREES}, commonFirstName: STRING, lastName: STRING, function: STRING, "
        f"contactDetails: {CONTACT}>>>>, "
        "clientPersons: ARRAY<STRUCT<referenceName: STRING, referenceDetailsPageUrl: STRING, "
        f"{DEGREES}, lastName: STRING, commonFirstName: STRING>>>")),
    ("employeesInvolvedInLobbying", (
        f"STRUCT<{FISCAL}, employeesCount: STRUCT<`from`: INT, `to`: INT>, "
        "employeeFTE: DECIMAL(18,4)>")),
    ("financialExpenses", (
        "STRUCT<refuseFinancialExpensesInformation: BOOLEAN, "
        f"refuseFinancialExpensesInformationReason: STRING, {FISCAL}, {FISCAL_YM}, "
        f"financialExpensesEuro: {RANGE}>")),
    ("mainFundingSources", f"STRUCT<{FISCAL}, mainFundingSources: ARRAY<{LABEL}>>"),
    ("publicAllowances", (
        "STRUCT<refusePublicAllowancesInformation: BOOLEAN, "
        "refusePublicAllowancesInformationReason: STRING, publicAllowancesPresent: BOOLEAN, "
        f"{FISCAL}, {FISCAL_YM}, publicAllowances: ARRAY<STRUCT<name: STRING, type: {LABEL}, "
        f"country: {LABEL}, location: STRING, publicAllowanceEuro: {RANGE}, "
        "description: STRING>>>")),
    ("donators", (
        "STRUCT<refuseDonatorsInformation: BOOLEAN, refuseDonatorsInformationReason: STRING, "
        f"donatorsInformationPresent: BOOLEAN, {FISCAL}, {FISCAL_YM}, "
        f"totalDonationsEuro: {RANGE}, donators: ARRAY<STRUCT<name: STRING, "
        f"donationEuro: {RANGE}, description: STRING>>>")),
    ("membershipFees", (
        f"STRUCT<{FISCAL}, totalMembershipFees: {RANGE}, individualContributorsPresent: BOOLEAN, "
        "individualContributors: ARRAY<STRUCT<name: STRING>>>")),
    ("annualReports", (
        "STRUCT<disclosureRequirementsExist: BOOLEAN, refuseAnnualFinanceStatement: BOOLEAN, "
        "refuseAnnualFinanceStatementReason: STRING, annualReportExists: BOOLEAN, "
        "annualReportLastFiscalYearExists: BOOLEAN, "
        "annualReportPreviousLastFiscalYearExists: BOOLEAN, finishedFiscalYearExists: BOOLEAN, "
        "lastFiscalYearStart: STRING, lastFiscalYearEnd: STRING, "
        "previousLastFiscalYearStart: STRING, previousLastFiscalYearEnd: STRING, "
        "annualReportPdfUrl: STRING, missingAnnualReportReason: STRING, "
        "reportWasPublishedElsewhere: BOOLEAN, locationOfReportPublication: STRING>")),
    ("regulatoryProjects", (
        "STRUCT<regulatoryProjectsPresent: BOOLEAN, regulatoryProjectsCount: INT, "
        "regulatoryProjects: ARRAY<STRUCT<regulatoryProjectNumber: STRING, title: STRING, "
        "printedMattersPresent: BOOLEAN, draftBillPresent: BOOLEAN, description: STRING, "
        "printedMatters: ARRAY<STRUCT<title: STRING, printingNumber: STRING, issuer: STRING, "
        f"documentUrl: STRING, projectUrl: STRING, leadingMinistries: ARRAY<{MINISTRY}>, "
        "migratedDraftBill: STRUCT<title: STRING, publicationDate: STRING, "
        "leadingMinistries: ARRAY<STRUCT<title: STRING, shortTitle: STRING, url: STRING, "
        "electionPeriod: INT, draftBillDocumentUrl: STRING, draftBillProjectUrl: STRING>>>>>, "
        "draftBill: STRUCT<title: STRING, publicationDate: STRING, customTitle: STRING, "
        f"customDate: STRING, leadingMinistries: ARRAY<{MINISTRY}>>, "
        f"fieldsOfInterest: ARRAY<{LABEL}>, "
        "affectedLaws: ARRAY<STRUCT<title: STRING, shortTitle: STRING, url: STRING>>>>>")),
    ("statements", (
        "STRUCT<statementsPresent: BOOLEAN, statementsCount: INT, "
        "statements: ARRAY<STRUCT<statementNumber: STRING, regulatoryProjectNumber: STRING, "
        "regulatoryProjectTitle: STRING, pdfUrl: STRING, pdfPageCount: INT, "
        "text: STRUCT<copyrightAcknowledgement: STRING, text: STRING>, "
        "recipientGroups: ARRAY<STRUCT<sendingDate: STRING, "
        f"recipients: STRUCT<parliament: ARRAY<{LABEL}>, "
        f"federalGovernment: ARRAY<STRUCT<department: {MINISTRY}>>>>>>>>")),
    ("contracts", (
        "STRUCT<contractsPresent: BOOLEAN, contractsCount: INT, "
        f"contracts: ARRAY<STRUCT<description: STRING, fieldsOfInterest: ARRAY<{FIELD}>, "
        "regulatoryProjects: ARRAY<STRUCT<regulatoryProjectNumber: STRING, "
        "regulatoryProjectTitle: STRING>>, "
        f"clients: STRUCT<clientOrganizations: ARRAY<STRUCT<{ORG}, "
        f"legalRepresentatives: ARRAY<STRUCT<{DEGREES}, firstName: STRING, lastName: STRING, "
        "artistName: STRING, function: STRING>>, "
        f"financialResourcesReceived: {FIN_RESOURCES}>>, "
        "clientPersons: ARRAY<STRUCT<referenceName: STRING, referenceDetailsPageUrl: STRING, "
        f"{DEGREES}, lastName: STRING, firstName: STRING, artistName: STRING, "
        f"companyName: STRING, financialResourcesReceived: {FIN_RESOURCES}>>>, "
        "contractors: STRUCT<lobbyingIsCarriedOutByLobbyist: BOOLEAN, "
        f"entrustedPersons: ARRAY<STRUCT<{DEGREES}, firstName: STRING, lastName: STRING, "
        f"artistName: STRING, function: STRING, {GOV}>>, "
        f"contractorOrganizations: ARRAY<STRUCT<{ORG}, "
        f"capitalCityRepresentation: STRUCT<address: {ADDRESS}, contactDetails: {CONTACT}>, "
        f"legalRepresentatives: ARRAY<STRUCT<{DEGREES}, firstName: STRING, lastName: STRING, "
        f"artistName: STRING, function: STRING, {GOV}>>, "
        f"assignedPersons: ARRAY<STRUCT<{DEGREES}, firstName: STRING, lastName: STRING, "
        f"artistName: STRING, {GOV}>>>>, "
        "contractorPersons: ARRAY<STRUCT<referenceName: STRING, "
        f"referenceDetailsPageUrl: STRING, {DEGREES}, lastName: STRING, firstName: STRING, "
        f"artistName: STRING, companyName: STRING, {GOV}>>>>>>")),
    ("codeOfConduct", "STRUCT<ownCodeOfConduct: BOOLEAN, codeOfConductPdfUrl: STRING>"),
]

SECTION_ORDER = [name for name, _ in SECTIONS]

META = ("source: STRING, sourceUrl: STRING, sourceDate: STRING, "
        "jsonDocumentationUrl: STRING")

ENTRY_DDL = ("`$schema`: STRING, " + META + ", registerNumber: STRING, "
             + ", ".join(f"{n}: {ddl}" for n, ddl in SECTIONS))

# A landed page: envelope metadata and the entry list under one of two keys.
PAGE_DDL = (META + ", resultCount: BIGINT, totalResultCount: BIGINT, cursor: STRING, "
            f"results: ARRAY<STRUCT<{ENTRY_DDL}>>, "
            f"registerEntries: ARRAY<STRUCT<{ENTRY_DDL}>>, "
            "_corrupt_record: STRING")


@lru_cache(maxsize=None)
def page_schema() -> T.StructType:
    return T.StructType.fromDDL(PAGE_DDL)


@lru_cache(maxsize=None)
def entry_schema() -> T.StructType:
    return T.StructType.fromDDL(ENTRY_DDL)
