"""Bucketed store and cursor chains on small tables."""

import random

from pyspark.sql import functions as F

from civicflow.sources import buckets as B
from civicflow.sources.chain import chain_gaps, page_chain


def _tables(spark, rows):
    """Tables of entries given as {number: [names]}."""
    entry = spark.createDataFrame([(n, n) for n in rows], "register_number string, _entry string")
    items = spark.createDataFrame([(x, n) for n, names in rows.items() for x in names], "name string, _entry string")
    return {"register_entry": entry, "donator_item": items}


def _state(spark, out, version=None):
    tables = B.read_store(spark, out, version)
    return (sorted(r["register_number"] for r in tables["register_entry"].collect()),
            sorted((r["_entry"], r["name"]) for r in tables["donator_item"].collect()))


def test_one_entry_rewrites_one_bucket_per_table(spark, tmp_path):
    out = str(tmp_path / "store")
    first = B.apply(spark, out, _tables(spark, {f"R{i}": [f"a{i}", f"b{i}"] for i in range(60)}), buckets=8)
    second = B.apply(spark, out, _tables(spark, {"R7": ["new"]}), epoch=1)
    for name, folders in second["tables"].items():
        changed = [b for b in folders if folders[b] != first["tables"][name].get(b)]
        assert len(changed) == 1 and len(folders) == 8
    numbers, items = _state(spark, out)
    assert numbers == sorted(f"R{i}" for i in range(60))
    assert [x for x in items if x[0] == "R7"] == [("R7", "new")] and len(items) == 59 * 2 + 1
    # Readers of the first version still see it.
    assert len(_state(spark, out, first)[1]) == 120


def test_entry_that_loses_all_children_and_old_versions_expire(spark, tmp_path):
    out = str(tmp_path / "store")
    for epoch in range(5):
        B.apply(spark, out, _tables(spark, {"R1": [] if epoch == 4 else [f"v{epoch}"], f"R{epoch + 2}": ["x"]}),
                epoch=epoch, buckets=2)
    kept = B.versions(spark, out)
    assert [v["number"] for v in kept] == [2, 3, 4]
    numbers, items = _state(spark, out)
    assert numbers == [f"R{i}" for i in range(1, 7)] and [x for x in items if x[0] == "R1"] == []
    assert _state(spark, out, kept[0])[1][0] == ("R1", "v2")


def _walk(rows):
    """(run, page) -> (rank, state) by following the cursors."""
    out = {}
    for run in {r[0] for r in rows}:
        nodes = {}
        for _, page, cursor, dest in sorted((r for r in rows if r[0] == run), key=lambda r: r[1]):
            nodes.setdefault(cursor or "", (page, dest or None))
        at, seen = "", {}
        while at in nodes and at not in seen:
            seen[at] = len(seen)
            at = nodes[at][1]
        for _, page, cursor, _ in (r for r in rows if r[0] == run):
            at = cursor or ""
            first, dest = nodes[at]
            if page != first:
                out[run, page] = (None, "duplicate")
            elif at not in seen:
                out[run, page] = (None, "unreachable")
            else:
                out[run, page] = (seen[at], "last" if dest is None else "gap" if dest not in seen and dest not in nodes
                                  else "repeated" if seen[dest] <= seen[at] else "chained")
    return out


def test_chains_shuffled_forked_cut_and_cyclic(spark):
    rng = random.Random(8)
    rows = []
    for run in range(6):
        n = rng.randint(1, 40)
        names = [f"p{k:02d}" for k in rng.sample(range(99), n)]
        for i, page in enumerate(names):
            dest = f"c{i + 1}" if i < n - 1 else (None, f"c{n // 2}", "nowhere", f"c{i}", "", None)[run]
            rows.append((run, page, f"c{i}" if i else None, dest))
        if run % 2 and n > 3:
            rows.append((run, "zz", "c2", "c9"))            # a fork: the page of an earlier name counts
        if run == 4 and n > 10:
            rows = [r for r in rows if not (r[0] == 4 and r[2] == "c5")]
        rows.append((run, "stray", f"lost{run}", None))
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "run int, page string, cursor string, next_cursor string")
    chain = page_chain(df)
    got = {(r["run"], r["page"]): (r["rank"], r["state"]) for r in chain.collect()}
    assert got == _walk(rows)
    gaps = {r["run"]: r["complete"] for r in chain_gaps(chain).collect()}
    assert gaps == {run: any(k[0] == run and v[1] == "last" for k, v in got.items()) for run in range(6)}
    assert page_chain(df.limit(0)).count() == 0


def test_cluster_broadcast_threshold_is_kept(spark):
    """The package sets no broadcast threshold of its own over the cluster's."""
    from civicflow.session import _DEFAULTS, configure
    configure(spark)
    assert "spark.sql.adaptive.autoBroadcastJoinThreshold" not in _DEFAULTS
    assert spark.conf.get("spark.sql.adaptive.autoBroadcastJoinThreshold", None) is None


def test_stage_bounds_row_groups(spark):
    """Staged documents are written in row groups of at most the given rows."""
    from pyarrow import parquet
    from civicflow.sources.store import stage
    got = stage(spark.range(0, 100, numPartitions=2), "bounded", 16)
    files = [f.removeprefix("file://") for f in got.inputFiles()]
    sizes = [m.row_group(i).num_rows for m in map(parquet.read_metadata, files) for i in range(m.num_row_groups)]
    assert max(sizes) <= 16 and sum(sizes) == 100


def test_stage_union_keeps_every_part(spark):
    """More parts than one job takes: all rows of all parts, none of them twice."""
    from civicflow.sources.store import UNION_PARTS, stage_union
    n = 2 * UNION_PARTS + 1
    got = stage_union([spark.range(i, i + 2) for i in range(n)], "union")
    assert sorted(r.id for r in got.collect()) == sorted([*range(n), *range(1, n + 1)])


def test_chain_joins_send_nothing_through_the_driver(spark):
    """every round would broadcast whole tables that are just small enough."""
    df = spark.createDataFrame([(1, "p0", None, "c1"), (1, "p1", "c1", "c2"), (1, "p2", "c2", None)],
                               "run int, page string, cursor string, next_cursor string")
    chain = page_chain(df)
    assert "Broadcast" not in chain._jdf.queryExecution().executedPlan().toString()
    assert sorted(map(tuple, chain.collect())) == [(1, "p0", 0, "chained"), (1, "p1", 1, "chained"), (1, "p2", 2, "last")]


def test_merged_partitions_are_bounded(spark):
    """F26 to F33: merged partitions of Spark's 64 MB, sorted by all joins of a stage at once, took 900 MB of a task."""
    from civicflow.session import PARTITION_BYTES, configure
    key, first = "spark.sql.adaptive.advisoryPartitionSizeInBytes", "spark.sql.adaptive.coalescePartitions.parallelismFirst"
    before = spark.conf.get(key)
    try:
        for given, held in (("64MB", str(PARTITION_BYTES)), ("1g", str(PARTITION_BYTES)), ("16k", "16k"), ("4194304", "4194304")):
            spark.conf.set(key, given)
            configure(spark)
            assert spark.conf.get(key) == held
        assert spark.conf.get(first) == "true"
    finally:
        spark.conf.set(key, before)


def test_joined_rows_are_the_joins_and_a_stage_joins_few(spark):
    from civicflow.sources.nest import JOINED, joined

    docs = spark.createDataFrame([(1, "a"), (2, "b"), (2, "again"), (None, "c")], "k int, name string")
    parts = [spark.createDataFrame([(1, i), (2, i), (2, -i), (None, i)], f"k int, v{i} int") for i in range(2 * JOINED + 1)]
    plain = docs
    for part in parts:
        plain = plain.join(part, "k", "left")
    got = joined(docs, parts, "k")
    rows = lambda df: sorted(map(repr, df.collect()))
    assert got.columns == plain.columns and rows(got) == rows(plain)
    assert got._jdf.queryExecution().optimizedPlan().toString().count("Join") <= JOINED


def test_pages_with_faults_are_parsed_by_all_cores(spark, tables, monkeypatch):
    import pytest
    from civicflow.sources import ingest_queries as Q

    class Staged(Exception):
        pass

    def stop(df, name, group_rows=None):
        raise Staged(df.rdd.getNumPartitions(), group_rows)
    monkeypatch.setattr(Q, "stage", stop)
    with pytest.raises(Staged) as found:
        Q.src_rejects(tables)
    parts, group_rows = found.value.args
    assert parts >= spark.sparkContext.defaultParallelism and group_rows


def test_flatteners_scan_lists_that_are_cut(spark):
    """F1 to F22: each projection of a list exploded the whole section of the wide entries again."""
    from civicflow.operators.flatten import flatten_entries, label_dimensions
    from civicflow.sources.document import entry_schema
    org = '{"name": "%s", "legalFormType": {"code": "x", "de": "X"}, "address": {"city": "c", "country": {"code": "DE", "de": "D"}}}'
    rows = [(n, (f"p{n}", 0), '{"registerNumber": "%s", "contracts": {"contracts": [{"clients": {"clientOrganizations": [%s, %s]}}]}}'
             % (n, org % f"a{n}", org % f"b{n}")) for n in ("R1", "R2")]
    docs = spark.createDataFrame(rows, "_entry string, _seq struct<_page: string, _pos: int>, json string")
    docs = docs.select("_entry", "_seq", F.from_json("json", entry_schema()).alias("e"))
    plain, labels, _ = flatten_entries(docs)
    names = []

    def cut(df, name):
        names.append(name)
        return spark.createDataFrame(df.collect(), df.schema)
    tables, uses, _ = flatten_entries(docs, cut)
    assert {"contracts", "contract-client-orgs", "address"} <= set(names)
    for name in ("contract_client_org", "address", "contract_item"):
        assert "Generate" not in tables[name]._jdf.queryExecution().optimizedPlan().toString()
        got = sorted(map(repr, tables[name].collect()))
        assert got and got == sorted(map(repr, plain[name].collect()))
    both = [[sorted(map(tuple, df.collect())) for df in label_dimensions(x)] for x in (uses, labels)]
    assert both[0] == both[1] and [r[1:] for r in both[0][0]] == [("legal_form_type", "x", "X", None)]
    assert [r[1:] for r in both[0][1]] == [("DE", "D", None)]


def test_line_items_are_numbered_once(spark, tables):
    """F1 to F22: a dozen tables numbered and joined all line items again."""
    from civicflow.sources.fixtures import SHARED, shared_views
    staged = []

    def stage(df, name):
        staged.append(name)
        return spark.createDataFrame([], df.schema)
    shared = shared_views(tables, stage)
    assert staged == [name for name in ("b_line", "b_line_topic", "code_label", "regulatory_project_item")] and set(staged) == set(SHARED)
    for name in ("field_of_interest", "client_org", "donator_item", "contractor_org", "leading_ministry", "reg_project_field_of_interest"):
        assert "l_orderkey" not in shared[name]._jdf.queryExecution().optimizedPlan().toString()
        assert shared[name].schema.names == tables[name].schema.names
    whole = shared_views(tables, lambda df, name: df.localCheckpoint())
    for name in ("client_org", "contract_field_of_interest", "reg_project_printed_matter_ministry"):
        assert sorted(map(repr, whole[name].collect())) == sorted(map(repr, tables[name].collect()))
    few = {"register_entry": tables["register_entry"]}
    assert shared_views(few, stage) is few


def test_no_keys_of_entries_are_broadcast(spark):
    """keys that are just small enough, packed, went through the driver."""
    from civicflow.sources.pages import dedupe_entries
    from civicflow.sources.store import placed_rejects
    found = spark.createDataFrame([("p1", 0, ("R1", "a")), ("p1", 1, ("R1", "b")), ("p2", 0, (None, "c"))],
                                  "_page string, _pos int, e struct<registerNumber: string, source: string>")
    won = dedupe_entries(found)
    rejects = spark.createDataFrame([("R1", "rule", None)], "_entry string, rule string, raw string")
    unreadable = spark.createDataFrame([], "_page string, rule string, raw string")
    placed = placed_rejects(won, rejects, unreadable)
    for df in (won, placed):
        assert "Broadcast" not in df._jdf.queryExecution().executedPlan().toString()
    assert sorted((r["_entry"], r["e"]["source"]) for r in won.collect()) == [("?p2#0", "c"), ("R1", "a")]
    assert [tuple(r) for r in placed.collect()] == [("p1", 0, "R1", "rule", None)]


def test_tables_without_rejects_are_not_joined(spark):
    """F1 to F22: each of 84 tables was joined to the list of rejects, also to an empty one."""
    from civicflow.sources.store import quarantine, schema_rejects
    table = spark.createDataFrame([("a", "R1"), ("b", "R2"), ("c", None)], "name string, _entry string")
    none = spark.createDataFrame([], "_entry string, rule string, raw string")
    some = spark.createDataFrame([("R2", "rule", None)], "_entry string, rule string, raw string")
    assert "Join" not in quarantine({"x": table}, none)["x"]._jdf.queryExecution().optimizedPlan().toString()
    assert sorted(r["name"] for r in quarantine({"x": table}, some)["x"].collect()) == ["a", "c"]
    made = {"contract_clients": table.select(F.xxhash64("name").alias("id"), F.xxhash64("name").alias("contract_item_id"), "_entry")}
    given = {"contract_clients": made["contract_clients"].withColumn("contract_item_id", F.when(F.col("id") < 0, F.col("id")))}
    assert schema_rejects(made) == [] and len(schema_rejects(given)) == 1


def test_entries_are_parsed_once_and_keys_without_documents(spark):
    """F1 to F22: all copies of all entries were written with a thousand columns, and pages parsed whole for their totals."""
    import json
    from civicflow.sources import pages as P
    entry = lambda n, **more: {"registerNumber": n, **more}
    text = spark.createDataFrame([
        ("p2", json.dumps({"source": "s", "totalResultCount": 4, "results": [entry("R1", source="late"), entry(None), entry("R3")]})),
        ("p1", json.dumps({"results": [], "registerEntries": [entry("R2"), entry("R1", financialExpenses={"financialExpensesEuro": {"to": "x"}})]})),
        ("p3", json.dumps(entry("R3", source="own"))), ("p4", '{"results": [{"registerNumber": "R9"'), ("p5", "[1]")],
        "_page string, value string")
    whole, pages = P.pages_from_text(text), P.pages_from_text(text, keys=True)
    keys, found = P.extract_entries(pages, keys=True), P.merge_page_metadata(P.extract_entries(whole))
    assert keys.schema["e"].dataType.names == ["registerNumber"] and "financialExpenses" not in pages.columns
    places = lambda df: sorted(map(str, df.select("_page", "_pos", "e.registerNumber").collect()))
    assert places(keys) == places(found) and len(places(keys)) >= 6
    once, twice = P.dedupe_entries(found, keys), P.dedupe_entries(found)
    assert once.columns == twice.columns and once.schema["e"].dataType == twice.schema["e"].dataType
    assert sorted(map(repr, once.collect())) == sorted(map(repr, twice.collect()))
    assert [r["expected"] for r in P.reconcile_totals(once, pages).collect()] == [4]
    assert "Union" not in once._jdf.queryExecution().optimizedPlan().toString()
