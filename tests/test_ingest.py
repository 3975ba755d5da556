"""Ingest path: round trip over the derived register tables, plus golden
cases for page extraction, de-duplication, quarantine, replace-children and
the streaming sink."""

import json
import os
import tempfile

import pytest
from pyspark.sql import functions as F

from civicflow.plans.oracle import render
from civicflow.plans.registry import load_all
from civicflow.sources import pages as P
from civicflow.sources.store import ingest_entries, replace_children
from conftest import same_rows

SPECS = load_all()
INGEST = [n for n, s in SPECS.items() if s.section == "ingest"]


@pytest.mark.parametrize("name", INGEST)
def test_round_trip(name, tables, duck):
    spec = SPECS[name]
    srows, drows = same_rows(spec(tables), duck.execute(render(spec.oracle)))
    assert srows == drows


def _pages(spark, docs):
    """Pages given as (page name, JSON text) → landed page rows."""
    df = spark.createDataFrame(docs, "_page string, value string")
    return P.pages_from_text(df)


def _entry(number, **sections):
    return {"registerNumber": number, **sections}


def _ingest(spark, docs):
    entries = P.dedupe_entries(P.merge_page_metadata(P.extract_entries(_pages(spark, docs))))
    return ingest_entries(entries)


META = {"source": "P", "sourceUrl": "u", "sourceDate": "2024-01-01T00:00:00Z",
        "jsonDocumentationUrl": "d"}


def test_extract_and_metadata(spark):
    docs = [("p1", json.dumps({**META, "results": [], "registerEntries": [_entry("R1")]})),
            ("p2", json.dumps({})),
            ("p3", json.dumps({**META, "results": [_entry("R2", source="E")]}))]
    got = {r["_entry"]: r["e"]["source"] for r in
           P.dedupe_entries(P.merge_page_metadata(P.extract_entries(_pages(spark, docs))))
           .collect()}
    assert got == {"R1": "P", "R2": "P"}


def test_dedupe_first_wins(spark):
    docs = [("p1", json.dumps({**META, "results": [
        _entry("R1", financialExpenses={"fiscalYearStart": "2021-01",
                                        "financialExpensesEuro": {"to": 1}}),
        _entry("R1", financialExpenses={"fiscalYearStart": "2021-01",
                                        "financialExpensesEuro": {"to": 2}})]}))]
    tables, _ = _ingest(spark, docs)
    assert [r["expenses_to_eur"] for r in tables["financial_expenses"].collect()] == [1]


def test_quarantine_rejects_whole_entry(spark):
    bad_ym = _entry("R1", financialExpenses={"fiscalYearStart": "2021"},
                    donators={"donators": [{"name": "x"}]})
    no_type = _entry("R2", lobbyistIdentity={
        "identity": "ORGANIZATION", "recentGovernmentFunctionPresent": True,
        "recentGovernmentFunction": {"ended": True}})
    bad_country = _entry("R3", lobbyistIdentity={"identity": "ORGANIZATION",
                                                 "address": {"country": {"de": "D"}}})
    good = _entry("R4", lobbyistIdentity={"identity": "NATURAL", "name": "ok"},
                  donators={"donators": [{"name": "y"}]})
    tables, rej = _ingest(spark, [("p1", json.dumps({**META, "results": [
        bad_ym, no_type, bad_country, good]}))])
    assert {r["register_number"] for r in tables["register_entry"].collect()} == {"R4"}
    assert {r["name"] for r in tables["donator_item"].collect()} == {"y"}
    assert {r["_entry"] for r in rej.collect()} == {"R1", "R2", "R3"}


def test_financial_resources_need_a_truthy_value(spark):
    contract = {"contracts": [{"description": "c", "clients": {"clientOrganizations": [
        {"name": "a", "financialResourcesReceived": {"lastFiscalYearFinished": False,
                                                     "from": 0}},
        {"name": "b", "financialResourcesReceived": {"to": 5}}]}}]}
    tables, _ = _ingest(spark, [("p1", json.dumps({**META, "results": [
        _entry("R1", contracts=contract)]}))])
    fr = tables["contract_client_org_financial_resources"].collect()
    assert [r["amount_to_eur"] for r in fr] == [5]
    # one clients and one contractors row per contract, even when empty
    assert tables["contract_contractors"].count() == 1


def test_replace_children_drops_old_rows(spark):
    v1 = _entry("R1", donators={"donators": [{"name": "a"}, {"name": "b"}]})
    v2 = _entry("R1", donators={"donators": [{"name": "a"}]})
    other = _entry("R2", donators={"donators": [{"name": "z"}]})
    old, _ = _ingest(spark, [("p1", json.dumps({**META, "results": [v1, other]}))])
    new, _ = _ingest(spark, [("p2", json.dumps({**META, "results": [v2]}))])
    merged = replace_children(old, new)
    names = sorted((r["_entry"], r["name"]) for r in merged["donator_item"].collect())
    assert names == [("R1", "a"), ("R2", "z")]
    assert merged["register_entry"].count() == 2


def test_stream_ingest_applies_batches(spark):
    from civicflow.streaming.ingest import current_tables, stream_ingest
    landing = tempfile.mkdtemp(prefix="civicflow-landing-")
    out = tempfile.mkdtemp(prefix="civicflow-store-")
    with open(os.path.join(landing, "page-0001.json"), "w") as f:
        json.dump({**META, "results": [_entry("R1", donators={"donators": [{"name": "a"},
                                                                          {"name": "b"}]})]}, f)
    q = stream_ingest(spark, landing, out + "/store", checkpoint=out + "/ckpt")
    q.awaitTermination(300)
    with open(os.path.join(landing, "page-0002.json"), "w") as f:
        json.dump({**META, "results": [_entry("R1", donators={"donators": [{"name": "c"}]}),
                                       _entry("R2", donators={"donators": [{"name": "d"}]})]}, f)
    q = stream_ingest(spark, landing, out + "/store", checkpoint=out + "/ckpt")
    q.awaitTermination(300)
    cur = current_tables(spark, out + "/store")
    got = sorted((r["_entry"], r["name"]) for r in cur["donator_item"].collect())
    assert got == [("R1", "c"), ("R2", "d")]


def test_seed_enums(spark):
    from civicflow.sources.store import seed_enums
    enums = seed_enums(spark)
    assert sorted(r["code"] for r in enums["activity_operation_type"].collect()) == \
        ["BOTH", "MANDATE_OPERATED", "SELF_OPERATED"]
    assert len(enums) == 4


def test_reconcile_totals(spark):
    docs = [("p1", json.dumps({**META, "totalResultCount": 3,
                               "results": [_entry("R1"), _entry("R2")]}))]
    pages = _pages(spark, docs)
    entries = P.dedupe_entries(P.merge_page_metadata(P.extract_entries(pages)))
    r = P.reconcile_totals(entries, pages).first()
    assert (r["expected"], r["processed"], r["missing"]) == (3, 2, 1)


def test_search_term_is_escaped(spark):
    from civicflow.plans.dashboards.advanced import like_escape
    df = spark.createDataFrame([("100% sure",), ("1000 sure",), ("a_b",), ("ab",)], "n string")
    hits = lambda term: sorted(r["n"] for r in
                               df.filter(F.col("n").ilike(f"%{like_escape(term)}%")).collect())
    assert hits("0%") == ["100% sure"]
    assert hits("a_b") == ["a_b"]


def test_read_pages_from_landed_files(spark):
    """SRC-1/2 on files: an empty results list falls through to
    registerEntries, an empty page gives nothing, a bare list gives its
    objects and drops non-objects."""
    landing = tempfile.mkdtemp(prefix="civicflow-pages-")
    files = {"page-1.json": {**META, "results": [], "registerEntries": [_entry("R1")]},
             "page-2.json": {},
             "page-3.json": [_entry("R2"), 1]}
    for name, body in files.items():
        with open(os.path.join(landing, name), "w") as f:
            json.dump(body, f)
    entries = P.dedupe_entries(P.merge_page_metadata(P.extract_entries(
        P.read_pages(spark, landing))))
    assert sorted(r["_entry"] for r in entries.collect()) == ["R1", "R2"]


def test_upsert_incoming_run_wins(spark):
    from civicflow.sources.store import upsert_entries
    cols = "id long, register_number string, source string"
    old = spark.createDataFrame([(1, "R1", "old"), (2, "R2", "old")], cols)
    new = spark.createDataFrame([(1, "R1", "new"), (3, "R3", "new")], cols)
    got = sorted(map(tuple, upsert_entries(old, new).collect()))
    assert got == [(1, "R1", "new"), (2, "R2", "old"), (3, "R3", "new")]


def test_refresh_all_materializes_both_views(spark, tables):
    from civicflow.sources.store import refresh_all
    out = tempfile.mkdtemp(prefix="civicflow-mv-")
    mvs = refresh_all(tables, out)
    for name, df in mvs.items():
        assert sorted(map(tuple, df.collect())) == sorted(map(tuple, tables[name].collect()))


def _few_tables(pages):
    """In place of the ingest of all tables: entries, donors, code tables, no reject."""
    from civicflow.sources.store import seed_enums
    spark = pages.sparkSession
    entries = P.dedupe_entries(P.merge_page_metadata(P.extract_entries(pages)))
    tables = {"register_entry": entries.select(F.col("_entry").alias("register_number"), "_entry"),
              "donator_item": entries.select("_entry", F.explode("e.donators.donators").alias("d"))
              .select("d.name", "_entry")}
    for name in ("code_label", "country_label"):
        tables[name] = spark.createDataFrame([], "id long, code string, de string, en string, _entry string")
    for name, codes in seed_enums(spark).items():
        tables[name] = codes.withColumn("_entry", F.lit(None).cast("string"))
    rejects = spark.createDataFrame([], "page string, position int, entry string, rule string, raw string")
    return tables, entries, rejects


def test_replayed_micro_batch_is_idempotent(spark, monkeypatch):
    from civicflow.streaming import ingest
    from civicflow.streaming.ingest import apply_batch, current_tables, versions
    monkeypatch.setattr(ingest, "ingest_pages", _few_tables)
    out = tempfile.mkdtemp(prefix="civicflow-replay-") + "/store"
    batch = _pages(spark, [("p1", json.dumps({**META, "results": [
        _entry("R1", donators={"donators": [{"name": "a"}, {"name": "b"}]})]}))])
    apply_batch(batch, 0, out)
    apply_batch(batch, 0, out)          # the same epoch again after a failure
    assert [v["number"] for v in versions(spark, out)] == [0]
    got = sorted(r["name"] for r in current_tables(spark, out)["donator_item"].collect())
    assert got == ["a", "b"]


def test_a_stream_that_starts_anew_loses_nothing(spark, monkeypatch):
    """Epochs 0 and 1, then epoch 0 of a new checkpoint: all three entries stay, old versions go."""
    from civicflow.streaming import ingest
    from civicflow.streaming.ingest import KEEP, apply_batch, current_tables, versions
    monkeypatch.setattr(ingest, "ingest_pages", _few_tables)
    out = tempfile.mkdtemp(prefix="civicflow-restart-") + "/store"
    for number, (epoch, stream) in enumerate([(0, "a"), (1, "a"), (0, "b"), (1, "b")]):
        batch = _pages(spark, [(f"p{number}", json.dumps({**META, "results": [_entry(f"R{number}")]}))])
        apply_batch(batch, epoch, out, stream)
    tables = current_tables(spark, out)
    assert sorted(r["register_number"] for r in tables["register_entry"].collect()) == ["R0", "R1", "R2", "R3"]
    assert [v["number"] for v in versions(spark, out)] == list(range(4))[-KEEP:]
    assert tables["activity_operation_type"].count() == 3


def test_split_pages_reads_by_type_and_names_faults(spark):
    """Quoted numbers, integral floats and boolean words load, objects in text columns are NULL,
    what does not fit is a fault with its path and raw value; a cut page is a reject."""
    odd = _entry("R1", lobbyistIdentity={"identity": "NATURAL", "lastName": {"a": 1}, "firstName": 7,
                                         "contactDetails": {"emails": ["a@b.de"]}},
                 financialExpenses={"financialExpensesEuro": {"from": 5.5, "to": "12"}},
                 accountDetails={"activeLobbyist": "yes", "registerEntryVersions": [{"version": 4.0}, {"version": "3"}]},
                 donators="text")
    bad = _entry("R2", accountDetails={"activeLobbyist": "maybe", "registerEntryVersions": [{"version": "x"}, {"version": [1]}]})
    docs = [("p1", json.dumps({**META, "results": [odd, 3, bad]})), ("p2", json.dumps({**META, "results": [_entry("R3")]})),
            ("cut", '{"results": [{"registerNumb'), ("list", json.dumps([_entry("R4"), 1])), ("no json", "<html>")]
    found, unreadable = P.split_pages(_pages(spark, docs))
    rows = {r["e"]["registerNumber"]: r for r in found.collect()}
    assert set(rows) == {"R1", "R2", "R3", "R4"}
    assert sorted((r["_page"], r["rule"]) for r in unreadable.collect()) == [
        ("cut", "unreadable page"), ("no json", "unreadable page")]
    e = rows["R1"]["e"]
    assert rows["R1"]["faults"] == [] and e["lobbyistIdentity"]["lastName"] is None
    assert (e["lobbyistIdentity"]["firstName"], e["lobbyistIdentity"]["contactDetails"]["emails"]) == ("7", '["a@b.de"]')
    assert tuple(e["financialExpenses"]["financialExpensesEuro"]) == (6, 12) and e["donators"] is None
    assert e["accountDetails"]["activeLobbyist"] is True and e["source"] == "P"
    assert [v["version"] for v in e["accountDetails"]["registerEntryVersions"]] == [4, 3]
    assert [tuple(f) for f in rows["R2"]["faults"]] == [
        ("accountDetails.activeLobbyist", '"maybe"'), ("accountDetails.registerEntryVersions[].version", '"x"'),
        ("accountDetails.registerEntryVersions[].version", "[1]")]
    assert (rows["R2"]["_page"], rows["R2"]["_pos"]) == ("p1", 2)


def _few_tables_with_rejects(pages):
    """As ``_few_tables``, but pages are split by type and faulty entries rejected; no flattening."""
    from civicflow.sources.store import entry_rejects, placed_rejects, quarantine, stage
    found, unreadable = P.split_pages(pages)
    entries = stage(P.dedupe_entries(found), "entries")
    bad = entry_rejects(entries, {}, None)
    tables, _, _ = _few_tables(pages.where(F.lit(False)))
    own = {"register_entry": entries.select(F.col("_entry").alias("register_number"), "_entry")}
    return tables | quarantine(own, bad), entries, placed_rejects(entries, bad, unreadable)


def test_ledger_keeps_rejects_until_corrected_input_comes(spark, monkeypatch):
    """Rejects are written once, replaced by those of a later run, and resolved by corrected input."""
    from civicflow.sources import ledger
    from civicflow.streaming import ingest
    from civicflow.streaming.ingest import apply_batch, current_tables, rejects
    monkeypatch.setattr(ingest, "ingest_pages", _few_tables_with_rejects)
    out = tempfile.mkdtemp(prefix="civicflow-ledger-") + "/store"
    bad_number = _entry("R1", registerEntryDetails={"version": "x"})
    bad_word = _entry("R2", accountDetails={"activeLobbyist": "maybe"})
    first = _pages(spark, [("p1", json.dumps({**META, "results": [bad_number, bad_word, _entry("R3")]})), ("p2", "{cut")])
    apply_batch(first, 0, out)
    apply_batch(first, 0, out)                          # a replay adds nothing
    got = sorted((r["page"], r["position"] or 0, r["entry"] or "", r["rule"], r["raw"])
                 for r in ledger.open_rejects(rejects(spark, out)).collect())
    assert got == [("p1", 0, "R1", "type: registerEntryDetails.version", '"x"'),
                   ("p1", 1, "R2", "type: accountDetails.activeLobbyist", '"maybe"'), ("p2", 0, "", "unreadable page", "{cut")]
    assert {r["register_number"] for r in current_tables(spark, out)["register_entry"].collect()} == {"R3"}
    still_bad = _entry("R2", accountDetails={"activeLobbyist": 5})
    apply_batch(_pages(spark, [("p2", json.dumps({**META, "results": [_entry("R1"), still_bad]}))]), 1, out)
    left = [tuple(r)[1:] for r in ledger.open_rejects(rejects(spark, out)).collect()]
    assert left == [("p2", 1, "R2", "type: accountDetails.activeLobbyist", "5")]
    assert rejects(spark, out).where("NOT resolved").count() == 4       # nothing is ever removed
    assert {r["register_number"] for r in current_tables(spark, out)["register_entry"].collect()} == {"R1", "R3"}
