"""Table storage and entry-level consistency (SRC-5 … SRC-7, SRC-9, SRC-11, SRC-12).

All tables keep the hidden ``_entry`` column (register number) so that a
re-ingested or rejected entry can be removed from every table — children and
per-occurrence dimensions alike — with one anti join per table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from civicflow.operators.flatten import ENTRY, flatten_entries, label_dimensions
from civicflow.schema import ENUMS, TABLES
from civicflow.session import shared_path
from civicflow.sources import pages as P

LABEL_TABLES = ("code_label", "country_label")
ENUM_TABLES = tuple(ENUMS)
#: Rows of a row group of staged pages (some 100 documents each) and of staged entries.
PAGE_ROWS, ENTRY_ROWS = 16, 1024
#: Parts of a union that are planned as one job.
UNION_PARTS = 12


def seed_enums(spark: SparkSession) -> dict[str, DataFrame]:
    """SRC-12: the four enum code tables."""
    # Literals of the plan: rows given from Python would start Python workers.
    return {name: spark.range(1, numPartitions=1).select(
        F.explode(F.array_distinct(F.array(*map(F.lit, codes)))).alias("code")) for name, codes in ENUMS.items()}


def violations(df: DataFrame, checks: list[tuple[Column, str, Column | None]]) -> DataFrame:
    """(entry, rule, raw) for every check a row fails — one pass over ``df``.

    All checks of a table are evaluated in one projection (an array of the
    failed rules with the value that fails, exploded), not one filtered scan per rule.
    """
    failed = F.filter(F.array(*[F.when(cond, F.struct(
        F.lit(rule).alias("rule"), (F.lit(None) if raw is None else raw).cast("string").alias("raw")))
        for cond, rule, raw in checks]), lambda x: x.isNotNull())
    return df.select(ENTRY, F.inline(failed))


def schema_rejects(tables: dict[str, DataFrame]) -> list[DataFrame]:
    """§1.7 rules derived from the schema: NOT NULL columns and enum codes; one result per table.

    A column that can not be NULL by its expression (a hashed key) needs no pass over its rows."""
    parts = []
    for name, df in tables.items():
        if name in LABEL_TABLES or name not in TABLES:
            continue
        checks, given = [], {x.name: x.nullable for x in df.schema}
        for col, _, nullable, ref in TABLES[name]:
            if col == "id":
                continue
            if not nullable and given[col]:
                checks.append((F.col(col).isNull(), f"{name}.{col} is NULL", None))
            if ref in ENUMS:
                checks.append((F.col(col).isNotNull() & ~F.col(col).isin(ENUMS[ref]),
                               f"{name}.{col} not in {ref}", F.col(col)))
        if checks:
            parts.append(violations(df, checks))
    return parts


def entry_rejects(entries: DataFrame, tables: dict[str, DataFrame], rejects: list[DataFrame] | None) -> DataFrame:
    """SRC-7: (entry, rule, raw) of every rule that an entry breaks: values of a wrong type
    (``faults``), the flatteners' checks, and the schema's (NOT NULL columns, enum codes)."""
    found = [*(rejects or []), *schema_rejects(tables)]
    if "faults" in entries.columns:
        found.append(entries.select(ENTRY, F.explode("faults").alias("x")).select(
            ENTRY, F.concat(F.lit("type: "), F.col("x.path")).alias("rule"), F.col("x.raw").alias("raw")))
    return stage_union(found, "found-rejects").distinct()


def quarantine(tables: dict[str, DataFrame], rejects: DataFrame) -> dict[str, DataFrame]:
    """SRC-7: drop every row of every rejected entry (one anti join per table; AQE broadcasts
    the list of entries when it is small and shuffles otherwise).  Without rejects nothing is joined."""
    if rejects.isEmpty():
        return dict(tables)
    bad = rejects.select(ENTRY).distinct()
    return {name: df.join(bad, ENTRY, "left_anti") for name, df in tables.items()}


def stage(df: DataFrame, name: str, group_rows: int | None = None) -> DataFrame:
    """Cut the lineage: write ``df`` below the shared checkpoint folder and
    read it back.  The ~100 projections of the flatteners then start from a
    parquet scan (nested-column pruning, no re-parsing of pages), and a lost
    executor recomputes from the written files, not from the landing zone.

    ``group_rows`` bounds a row group.  Writers buffer a row group and
    readers decode up to 4,096 rows of one at a time, which is too much where a
    row is a whole document or a page of them."""
    path = shared_path(df.sparkSession, "stage", name, unique=True)
    writer = df.write.mode("overwrite")
    if group_rows:
        writer = writer.option("parquet.block.row.count.limit", group_rows)
    writer.parquet(path)
    # The schema is known: no job reads it from a footer.
    return df.sparkSession.read.schema(df.schema).parquet(path)


def cut(df: DataFrame, name: str) -> DataFrame:
    """``stage`` for sections and lists of the flatteners: row groups are bounded where rows hold lists."""
    return stage(df, f"flat-{name}", ENTRY_ROWS if "array<" in df.schema.simpleString() else None)


def dealt(df: DataFrame) -> DataFrame:
    """``df`` dealt to twice as many tasks as there are cores.

    Texts of one form pack so well that Spark puts very many, by their bytes, into one task,
    but each takes its time to parse."""
    return df.repartition(2 * df.sparkSession.sparkContext.defaultParallelism)


def stage_union(parts: list[DataFrame], name: str, parallel: int = 4) -> DataFrame:
    """The union of many small results of one schema, ``UNION_PARTS`` of them to a job.

    One plan of all parts would be sent whole to each of its tasks."""
    from concurrent.futures import ThreadPoolExecutor

    spark, base = parts[0].sparkSession, shared_path(parts[0].sparkSession, "stage", name, unique=True)

    def write(first: int) -> str:
        out = parts[first]
        for more in parts[first + 1:first + UNION_PARTS]:
            out = out.unionByName(more)
        path = f"{base}/{first:05d}"
        out.write.mode("overwrite").parquet(path)
        return path

    with ThreadPoolExecutor(max_workers=max(1, parallel)) as pool:
        return spark.read.schema(parts[0].schema).parquet(*pool.map(write, range(0, len(parts), UNION_PARTS)))


def ingest_entries(entries: DataFrame, staged: bool = False
                   ) -> tuple[dict[str, DataFrame], DataFrame]:
    """Flatten de-duplicated entries (``_entry, _seq, e``, maybe ``faults``), quarantine the
    rejected ones, and build the label dimensions from the accepted ones.
    Returns the tables and the staged rejects (_entry, rule, raw).

    Lineage cuts keep every later plan small: the entries are staged once, then
    their sections and lists (the ~100 projections scan these), and the rejected
    entries — a union over every rule of every table — are computed once and
    staged, so the 84 table plans carry at most one anti join against a file.
    """
    if not staged:
        entries = stage(entries, "entries", ENTRY_ROWS)
    tables, uses, rejects = flatten_entries(entries, cut)
    rej = stage(entry_rejects(entries, tables, rejects), "rejects")
    accepted = quarantine(tables | {"uses": uses}, rej)
    uses, tables = accepted.pop("uses"), accepted
    code_label, country_label = label_dimensions(uses, cut)
    tables["code_label"] = code_label.withColumn(ENTRY, F.lit(None).cast("string"))
    tables["country_label"] = country_label.withColumn(ENTRY, F.lit(None).cast("string"))
    # The enum tables belong to every store (SRC-12); they have no entry.
    for name, codes in seed_enums(entries.sparkSession).items():
        tables[name] = codes.withColumn(ENTRY, F.lit(None).cast("string"))
    return tables, rej


def ingest_pages(pages: DataFrame) -> tuple[dict[str, DataFrame], DataFrame, DataFrame]:
    """SRC-1 … SRC-7 on landed pages: the tables of the accepted entries, the staged entries, and all
    rejects (page, position, entry, rule, raw), of pages and of entries."""
    pages = stage(pages, "pages", PAGE_ROWS)
    found, unreadable = P.split_pages(pages)
    entries = stage(P.dedupe_entries(found), "entries", ENTRY_ROWS)
    tables, rej = ingest_entries(entries, staged=True)
    return tables, entries, placed_rejects(entries, rej, unreadable)


def placed_rejects(entries: DataFrame, rejects: DataFrame, unreadable: DataFrame) -> DataFrame:
    """(page, position, entry, rule, raw) of the rejected entries and the unreadable pages."""
    places = entries.select(ENTRY, F.col("_seq._page").alias("page"),
                            F.col("_seq._pos").cast("int").alias("position"))
    # Hinted to be shuffled: rejects, or places, that are just small enough to be broadcast fill the driver.
    return rejects.join(places.hint("merge"), ENTRY).select(
        "page", "position", F.col(ENTRY).alias("entry"), "rule", "raw").unionByName(
        unreadable.select(F.col("_page").alias("page"), F.lit(None).cast("int").alias("position"),
                          F.lit(None).cast("string").alias("entry"), "rule", "raw"))


def ingest_to(entries: DataFrame, path: str, staged: bool = False
              ) -> tuple[dict[str, DataFrame], DataFrame | None]:
    """Ingest and persist (SRC-9): every table written once below ``path``
    and read back, so queries scan typed parquet, not the ingest plan."""
    tables, rej = ingest_entries(entries, staged)
    write_tables(tables, path)
    spark = entries.sparkSession
    return {n: spark.read.schema(df.schema).parquet(f"{path.rstrip('/')}/{n}") for n, df in tables.items()}, rej


def upsert_entries(current: DataFrame, incoming: DataFrame) -> DataFrame:
    """SRC-5: register_entry keyed by register number, the incoming run wins.

    The id is a hash of the number, so an updated entry keeps its id."""
    cols = [c for c in current.columns if c not in ("register_number",)]
    joined = current.alias("o").join(incoming.alias("n"), "register_number", "full_outer")
    return joined.select("register_number",
                         *[F.when(F.col("n.id").isNotNull(), F.col(f"n.{c}"))
                           .otherwise(F.col(f"o.{c}")).alias(c) for c in cols]) \
        .select(*current.columns)


def replace_children(current: dict[str, DataFrame], incoming: dict[str, DataFrame]
                     ) -> dict[str, DataFrame]:
    """SRC-6: every re-ingested entry loses all of its old rows (children and
    per-occurrence dimensions) and gets the new ones.  Labels are kept (first
    writer wins) and only gain new codes or fill NULL texts."""
    keys = incoming["register_entry"].select(ENTRY).distinct()
    out: dict[str, DataFrame] = {}
    for name in set(current) | set(incoming):
        if name in LABEL_TABLES or name in ENUM_TABLES:
            continue
        old = current.get(name)
        new = incoming.get(name)
        if old is None:
            out[name] = new
        elif new is None:
            out[name] = old.join(keys, ENTRY, "left_anti")
        else:
            out[name] = old.join(keys, ENTRY, "left_anti").unionByName(new)
    if "register_entry" in current:
        out["register_entry"] = upsert_entries(current["register_entry"],
                                               incoming["register_entry"])
    for name in LABEL_TABLES:
        out[name] = merge_labels(current.get(name), incoming.get(name))
    for name in ENUM_TABLES:
        if name in incoming or name in current:
            out[name] = incoming.get(name, current.get(name))
    return out


def merge_labels(old: DataFrame | None, new: DataFrame | None) -> DataFrame | None:
    if old is None or new is None:
        return old if new is None else new
    text = [c for c in ("de", "en") if c in old.columns]
    j = old.alias("o").join(new.alias("n"), "id", "full_outer")
    keep = [c for c in old.columns if c not in ("id", *text)]
    return j.select("id", *[F.coalesce(F.col(f"o.{c}"), F.col(f"n.{c}")).alias(c) for c in keep],
                    *[F.coalesce(F.col(f"o.{c}"), F.col(f"n.{c}")).alias(c) for c in text]) \
        .select(*old.columns)


def write_tables(tables: dict[str, DataFrame], path: str, mode: str = "overwrite",
                 parallel: int = 8) -> None:
    """SRC-9: one parquet directory per table (typed, with ``_entry``).

    The tables are independent jobs; submitting several at once keeps the
    cluster busy while small tables finish (Spark schedules concurrent jobs
    from different threads).
    """
    from concurrent.futures import ThreadPoolExecutor

    def write(item):
        name, df = item
        df.write.mode(mode).parquet(f"{path.rstrip('/')}/{name}")

    todo = [(n, d) for n, d in tables.items() if d is not None]
    with ThreadPoolExecutor(max_workers=max(1, parallel)) as pool:
        list(pool.map(write, todo))


def read_tables(spark: SparkSession, path: str, names) -> dict[str, DataFrame]:
    return {n: spark.read.parquet(f"{path.rstrip('/')}/{n}") for n in names}


def materialize(df: DataFrame, path: str) -> DataFrame:
    """SRC-11: write a view to shared storage and read it back."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)


def refresh_all(tables, path: str | None = None) -> dict[str, DataFrame]:
    """Refresh both materialized views (the reference refreshes one)."""
    from civicflow.plans.views import mv_financial_tops, mv_revolving_door_network
    spark = tables["register_entry"].sparkSession
    base = path or shared_path(spark, "mv", unique=True)
    return {"mv_financial_tops": materialize(mv_financial_tops(tables),
                                             f"{base}/mv_financial_tops"),
            "mv_revolving_door_network": materialize(mv_revolving_door_network(tables),
                                                     f"{base}/mv_revolving_door_network")}


__all__ = ["seed_enums", "schema_rejects", "entry_rejects", "quarantine", "ingest_entries", "ingest_pages",
           "upsert_entries", "replace_children", "write_tables", "read_tables", "materialize",
           "refresh_all"]
