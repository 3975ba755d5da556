"""A document that uses every section fills every table of the model."""

import json

from civicflow.schema import TABLES
from civicflow.sources import pages as P
from civicflow.sources.store import ingest_entries

L = lambda code, de=None: {"code": code, "de": de or code, "en": None}
ADDR = {"type": "NATIONAL", "street": "S", "zipCode": "10115", "city": "Berlin",
        "country": {"code": "DE", "de": "Deutschland", "en": "Germany"}}
CONTACT = {"phoneNumber": "", "phone": "1", "emails": ["a@x", "", {"email": "b@x"}],
           "websites": "w.example"}
MINISTRY = {"title": "Ministry", "shortTitle": "M", "url": "u", "electionPeriod": 20}
GOV = {"type": L("MEMBER"), "ended": True, "endDate": "2021-05-17",
       "houseOfRepresentatives": {"function": L("MDB"), "functionPosition": "MdB (SPD)"},
       "federalGovernment": {"function": L("MIN"), "department": MINISTRY},
       "federalAdministration": {"supremeFederalAuthority": "A", "function": "f"}}
PERSON = {"lastName": "L", "firstName": "F", "recentGovernmentFunctionPresent": True,
          "recentGovernmentFunction": GOV}
FIN = {"lastFiscalYearFinished": True, "lastFiscalYearStart": "2022-01-01", "to": 5}
ORG = {"name": "O", "legalFormType": L("GMBH"), "legalForm": {**L("GMBH"), "legalFormText": "x"},
       "address": ADDR, "contactDetails": CONTACT}

ENTRY = {
    "$schema": "s", "registerNumber": "R000001",
    "accountDetails": {
        "activeLobbyist": True, "firstPublicationDate": "2022-01-01T10:00:00+01:00",
        "accountHasCodexViolations": True,
        "activeDateRanges": [{"fromDate": "2022-01-01"}],
        "inactiveDateRanges": [{"fromDate": "2021-01-01", "untilDate": "2021-12-31"}],
        "registerEntryVersions": [{"registerEntryId": 1, "version": 1, "legislation": "GL2022",
                                   "validFromDate": "2022-01-01", "versionActiveLobbyist": True}],
        "codexViolations": [{"codexViolationName": ""}, {"codexViolationName": "late"}]},
    "registerEntryDetails": {"registerEntryId": 1, "legislation": "GL2024", "version": 2,
                             "validFromDate": "2024-03-01",
                             "annualUpdate": {"updateMissing": False,
                                              "lastAnnualUpdate": "2024-06-01"},
                             "fiscalYearUpdate": {"updateMissing": True}},
    "lobbyistIdentity": {
        "identity": "ORGANIZATION", "name": "Org", "naturalPersonType": L("NP"),
        "recentGovernmentFunctionPresent": True, "recentGovernmentFunction": GOV,
        "address": ADDR, "contactDetails": CONTACT, "legalFormType": L("EV"),
        "legalForm": {**L("EV"), "legalFormText": "e.V."},
        "capitalCityRepresentation": {"address": ADDR, "contactDetails": CONTACT},
        "entrustedPersons": [PERSON], "legalRepresentatives": [{**PERSON, "contact": CONTACT}],
        "namedEmployees": [{"lastName": "N"}], "membersCount": {"total": 3, "date": "2024-01-01"},
        "memberships": ["m1", {"membership": "m2"}]},
    "activitiesAndInterests": {
        "activity": {**L("ACT"), "activityText": "t"}, "activityOperationType": "BOTH",
        "typesOfExercisingLobbyWork": [L("T1")],
        "fieldsOfInterest": [{**L("FOI"), "fieldOfInterestText": "free"}],
        "legislativeProjects": [{"name": "p"}]},
    "clientIdentity": {"clientsPresent": True, "clientsCount": 1,
                       "clientOrganizations": [{**ORG, "legalRepresentatives": [
                           {"lastName": "R", "contactDetails": CONTACT}]}],
                       "clientPersons": [{"lastName": "P"}]},
    "employeesInvolvedInLobbying": {"relatedFiscalYearFinished": True,
                                    "employeesCount": {"from": 1, "to": 2}, "employeeFTE": 1.5},
    "financialExpenses": {"fiscalYearStart": "2023-01", "financialExpensesEuro": {"from": 1,
                                                                                   "to": 2}},
    "mainFundingSources": {"mainFundingSources": [L("MF")]},
    "publicAllowances": {"publicAllowances": [{"name": "g", "type": L("PT"),
                                               "country": {"code": "DE"},
                                               "publicAllowanceEuro": {"to": 9}}]},
    "donators": {"donators": [{"name": "d", "donationEuro": {"to": 3}}]},
    "membershipFees": {"relatedFiscalYearFinished": True,
                       "individualContributors": [{"name": "i"}]},
    "annualReports": {"annualReportExists": True, "lastFiscalYearStart": "2023-01-01"},
    "regulatoryProjects": {"regulatoryProjects": [{
        "title": "Law", "draftBillPresent": True,
        "printedMatters": [{"title": "pm", "leadingMinistries": [MINISTRY],
                            "migratedDraftBill": {"title": "m", "publicationDate": "2020-01-01",
                                                  "leadingMinistries": [
                                                      {**MINISTRY, "draftBillDocumentUrl": "d"}]}}],
        "draftBill": {"title": "b", "publicationDate": "2024-02-02",
                      "leadingMinistries": [MINISTRY]},
        "fieldsOfInterest": [L("FOI")], "affectedLaws": [{"title": "a"}]}]},
    "statements": {"statementsCount": 1, "statements": [{
        "regulatoryProjectTitle": "s", "text": {"text": "body"},
        "recipientGroups": [{"sendingDate": "2024-05-05",
                             "recipients": {"parliament": [L("BT")],
                                            "federalGovernment": [{"department": MINISTRY}]}},
                            {"sendingDate": "2025-01-01"}]}]},
    "contracts": {"contracts": [{
        "description": "c", "fieldsOfInterest": [L("FOI")],
        "regulatoryProjects": [{"regulatoryProjectNumber": "1", "regulatoryProjectTitle": "t"}],
        "clients": {"clientOrganizations": [{**ORG, "legalRepresentatives": [{"lastName": "r"}],
                                             "financialResourcesReceived": FIN}],
                    "clientPersons": [{"lastName": "p", "financialResourcesReceived": FIN}]},
        "contractors": {"lobbyingIsCarriedOutByLobbyist": False,
                        "entrustedPersons": [PERSON],
                        "contractorOrganizations": [
                            {**ORG, "capitalCityRepresentation": {"address": ADDR},
                             "legalRepresentatives": [PERSON],
                             "assignedPersons": [PERSON, PERSON]},
                            {**ORG, "assignedPersons": [PERSON]}],
                        "contractorPersons": [PERSON]}}]},
    "codeOfConduct": {"ownCodeOfConduct": True},
}
META = {"source": "P", "sourceUrl": "u", "sourceDate": "2024-01-01T00:00:00Z",
        "jsonDocumentationUrl": "d"}


def test_every_table_gets_rows(spark):
    df = spark.createDataFrame([("p1", json.dumps({**META, "results": [ENTRY]}))],
                               "_page string, value string")
    entries = P.dedupe_entries(P.merge_page_metadata(P.extract_entries(P.pages_from_text(df))))
    tables, rej = ingest_entries(entries)
    assert rej is None or rej.count() == 0, rej.collect()
    skip = {"legislation_type", "lobbyist_identity_type", "address_type",
            "activity_operation_type", "gov_function_type"}
    empty = [n for n in TABLES if n not in skip and tables[n].count() == 0]
    assert empty == []
    # blanks are skipped but keep their ordinal
    assert [(r["ordinal"], r["email"]) for r in
            tables["contact_email"].orderBy("contact_id", "ordinal").collect()][:2] == \
        [(1, "a@x"), (3, "b@x")]
    assert [r["ordinal"] for r in tables["codex_violation"].collect()] == [2]
    # sending date from the first recipient group only
    assert str(tables["statement_item"].first()["sending_date"]) == "2024-05-05"
    # assigned persons: ordinals restart per contractor organisation
    assert sorted(r["ordinal"] for r in tables["assigned_person"].collect()) == [1, 1, 2]
    # end date normalized to year-month; one label row per (domain, code)
    assert {r["end_year_month"] for r in
            tables["recent_government_function"].collect()} == {"2021-05"}
    labels = tables["code_label"].groupBy("domain", "code").count().collect()
    assert all(r["count"] == 1 for r in labels)
    # the representative's contact comes from ``contact``
    assert tables["legal_representative"].first()["contact_id"] is not None
    assert tables["lobbyist_identity"].first()["capital_city_repr_id"] is not None
