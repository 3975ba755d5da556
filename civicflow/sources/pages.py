"""Landed API pages → de-duplicated register entries (SRC-1 … SRC-4, SRC-8).

The reference pages through the API by cursor and de-duplicates in memory.
Here the pages are landed as JSON files (one page per file, named in page
order) and read as one DataFrame; de-duplication is a partial aggregate by
register number, so it needs one shuffle and no ordering of all entries.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from functools import lru_cache

from civicflow.sources import typed
from civicflow.sources.document import ENTRY_DDL, META, entry_schema, page_schema

META_FIELDS = ["source", "sourceUrl", "sourceDate", "jsonDocumentationUrl"]


@lru_cache(maxsize=None)
def _landing_schema(keys: bool = False) -> T.StructType:
    """Page fields plus entry fields: a file may hold a page object, a bare
    list of entries (Spark reads each element as a row) or one entry.
    With ``keys``, entries have their register number only."""
    entry = _entry_schema(keys)
    page = [T.StructField(f.name, T.ArrayType(entry) if f.name in ("results", "registerEntries") else f.dataType)
            for f in page_schema().fields]
    names = {f.name for f in page}
    return T.StructType(page + [f for f in entry.fields if f.name not in names])


@lru_cache(maxsize=None)
def _entry_schema(keys: bool) -> T.StructType:
    entry = entry_schema()
    return T.StructType([f for f in entry.fields if f.name == "registerNumber"]) if keys else entry


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """SRC-1: landed pages with an explicit schema, PERMISSIVE + corrupt column."""
    return (spark.read.schema(_landing_schema())
            .option("multiLine", True)
            .option("mode", "PERMISSIVE")
            .option("columnNameOfCorruptRecord", "_corrupt_record")
            .json(path)
            .withColumn("_page", F.col("_metadata.file_path")))


def pages_from_text(text: DataFrame, col: str = "value", page: str = "_page", keys: bool = False) -> DataFrame:
    """SRC-1 for pages held as JSON text in a DataFrame (e.g. a stream).

    With ``keys``, only page fields and register numbers are read, for a fraction of the time."""
    parsed = F.from_json(F.col(col), _landing_schema(keys),
                         {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt_record"})
    return text.select(parsed.alias("p"), F.col(page).alias("_page")).select("p.*", "_page")


def _entry_struct(entry: T.StructType) -> Column:
    """The row itself as an entry (bare-list or single-entry landing)."""
    return F.struct(*[F.col(f"`{f.name}`") for f in entry.fields])


def extract_entries(pages: DataFrame, keys: bool = False) -> DataFrame:
    """SRC-2: (_page, _pos, e) — entries from ``results``, else
    ``registerEntries`` (an empty ``results`` falls through), else the row
    itself when it carries a register number; otherwise nothing.
    ``keys`` as in ``pages_from_text``."""
    entry = _entry_schema(keys)
    results, register = F.col("results"), F.col("registerEntries")
    lists = F.coalesce(F.when(F.size(results) > 0, results), register)
    own = F.when(results.isNull() & register.isNull() & F.col("registerNumber").isNotNull(),
                 F.array(_entry_struct(entry)))
    # A bare list that also holds non-objects ([e, 1]) is one corrupt record
    # for the JSON reader: its object elements are parsed from the raw text,
    # the rest dropped.
    raw = F.col("_corrupt_record")
    salvaged = F.when(F.trim(raw).startswith("["), F.filter(
        F.transform(F.from_json(raw, T.ArrayType(T.StringType())),
                    lambda x: F.when(F.trim(x).startswith("{"), F.from_json(x, entry))),
        lambda e: e.isNotNull()))
    entries = F.coalesce(lists, own, salvaged, F.array().cast(T.ArrayType(entry)))
    meta = F.struct(*[F.col(m).alias(m) for m in META_FIELDS])
    return (pages.select("_page", meta.alias("_meta"), F.posexplode(entries).alias("_pos", "e"))
            .filter(F.col("e").isNotNull()))


def _variants(pages: DataFrame) -> DataFrame:
    """(_page, raw, v) of the pages the typed reader complained about; v is NULL where there is no JSON."""
    raw = F.col("_corrupt_record")
    return pages.where(raw.isNotNull()).select("_page", raw.alias("raw"), F.try_parse_json(raw).alias("v"))


def unreadable_pages(pages: DataFrame) -> DataFrame:
    """SRC-1/7: (_page, rule, raw) of pages that are no JSON: cut off in the middle, or something else."""
    return _variants(pages).where("v IS NULL").select(
        "_page", F.lit("unreadable page").alias("rule"), "raw")


def salvaged_entries(pages: DataFrame) -> DataFrame:
    """SRC-1/2/7: entries of readable pages in which a value does not fit its type.

    (_page, _pos, _meta, e, faults): the entry with every value that fits, and the (path, raw) of
    those that do not.  Lists may hold other things than objects; these are dropped."""
    def listed(name: str) -> Column:
        return F.try_variant_get("v", f"$.{name}", "array<variant>")
    is_list = F.schema_of_variant("v").startswith("ARRAY")
    own = F.when(F.try_variant_get("v", "$.registerNumber", "string").isNotNull(), F.array("v"))
    entries = F.when(is_list, F.try_variant_get("v", "$", "array<variant>")).otherwise(F.coalesce(
        F.when(F.size(listed("results")) > 0, listed("results")), listed("registerEntries"),
        F.when(listed("results").isNull(), own)))
    rows = _variants(pages).where("v IS NOT NULL").select(
        "_page", typed.typed(META).alias("_meta"), F.posexplode(entries).alias("_pos", "x"))
    rows = rows.where(F.schema_of_variant("x").startswith("OBJECT"))
    return rows.select("_page", "_pos", "_meta", typed.typed(ENTRY_DDL, "x").alias("e"),
                       typed.faults(ENTRY_DDL, "x").alias("faults"))


def split_pages(pages: DataFrame) -> tuple[DataFrame, DataFrame]:
    """SRC-1/2/3/7: the entries of ``pages`` (_page, _pos, e, faults) and the unreadable pages.

    ``pages`` should be staged: the typed reader's clean pages go their way, and only when
    some page is not clean is its text read again as VARIANT."""
    clean = merge_page_metadata(extract_entries(pages.where(F.col("_corrupt_record").isNull())))
    clean = clean.withColumn("faults", F.array().cast(typed.FAULT))
    if not pages.where(F.col("_corrupt_record").isNotNull()).isEmpty():
        found = merge_page_metadata(salvaged_entries(pages)).select(*clean.columns)
        schema = entry_schema()
        clean = clean.withColumn("e", F.col("e").cast(schema)).unionByName(
            found.withColumn("e", F.col("e").cast(schema)))
    return clean, unreadable_pages(pages)


def merge_page_metadata(entries: DataFrame) -> DataFrame:
    """SRC-3: page-level source fields override the entry's when not NULL."""
    e = F.col("e")
    for m in META_FIELDS:
        e = e.withField(m, F.coalesce(F.col(f"_meta.{m}"), F.col(f"e.{m}")))
    return entries.withColumn("e", e).drop("_meta")


def dedupe_entries(entries: DataFrame, keys: DataFrame | None = None) -> DataFrame:
    """SRC-4: first occurrence of a register number in page order wins.

    Only keys are aggregated: the least (page, position) per number is a partial
    aggregate without documents, so a number that repeats across a third of all
    pages leaves one small row per partition.  A join on the place, which no
    two entries share, then fetches the winners' documents.  Entries without a
    number pass through (they are rejected later).  Output: _entry, _seq, e (and faults, if given).

    ``entries`` are read three times, so they should be staged; or else ``keys`` are the same entries
    of the same pages (no two of one name) with their numbers only, and ``entries`` are read once.
    """
    number = F.col("e.registerNumber")
    rest = [c for c in entries.columns if c not in ("_page", "_pos")]
    first = ((entries if keys is None else keys).where(number.isNotNull()).groupBy(number.alias("_entry"))
             .agg(F.min(F.struct("_page", "_pos")).alias("_seq"))
             .select("_entry", "_seq", F.col("_seq._page").alias("_page"), F.col("_seq._pos").alias("_pos")))
    place = F.concat(F.lit("?"), F.col("_page"), F.lit("#"), F.col("_pos").cast("string"))
    # Hashed by key in each partition: neither are documents sorted, nor do all keys go through the driver.
    if keys is not None:
        return (entries.join(first.drop("_seq").hint("shuffle_hash"), ["_page", "_pos"], "left")
                .where(number.isNull() | F.col("_entry").isNotNull())
                .select(F.when(number.isNull(), place).otherwise(F.col("_entry")).alias("_entry"),
                        F.struct("_page", "_pos").alias("_seq"), *rest))
    won = (entries.where(number.isNotNull()).join(first.hint("shuffle_hash"), ["_page", "_pos"])
           .select("_entry", "_seq", *rest))
    # ``_seq`` (page, position) orders entries for "first writer" rules.
    anonymous = entries.where(number.isNull()).select(place.alias("_entry"), F.struct("_page", "_pos").alias("_seq"), *rest)
    return won.unionByName(anonymous)


def reconcile_totals(entries: DataFrame, stats: DataFrame | None = None) -> DataFrame:
    """SRC-8: expected total (first present of totalResultCount, totalCount,
    registerEntriesTotalCount) next to the number of processed entries."""
    processed = entries.agg(F.count(F.lit(1)).alias("processed"))
    if stats is None:
        return processed.select(F.lit(None).cast("long").alias("expected"), "processed",
                                F.lit(None).cast("long").alias("missing"))
    names = set(stats.columns)
    cands = [F.col(c).cast("long") for c in ("totalResultCount", "totalCount",
                                               "registerEntriesTotalCount") if c in names]
    expected = (stats.select(F.coalesce(*cands).alias("expected"))
                .agg(F.max("expected")).scalar()) if cands else F.lit(None).cast("long")
    return processed.select(expected.alias("expected"), "processed") \
        .withColumn("missing", F.col("expected") - F.col("processed"))
