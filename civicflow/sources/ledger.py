"""SRC-7: the reject ledger, an append-only table beside a store.

One row per rejected page or entry and broken rule: run, page, position,
entry, rule, raw value.  A run writes its own folder ``run=<number>`` (a
repeated run overwrites it, so a replay adds nothing).  Nothing is ever changed:
when an entry that was rejected is accepted later, or a page can be read, the run adds
a row with ``resolved`` set.  A key's rejects are those of its latest run.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from civicflow.operators.flatten import ENTRY

SCHEMA = ("page string, position int, entry string, rule string, raw string, resolved boolean, run long")


def _key():
    """What a reject is about: an entry, or else a page."""
    return F.coalesce(F.concat(F.lit("entry "), F.col("entry")), F.concat(F.lit("page "), F.col("page")))


def read_ledger(spark: SparkSession, path: str, last_run: int) -> DataFrame:
    """All rows of committed runs (those up to ``last_run``)."""
    return spark.read.schema(SCHEMA).parquet(path).where(F.col("run") <= last_run)


def open_rejects(ledger: DataFrame) -> DataFrame:
    """Rejects that no later run has replaced or resolved."""
    latest = ledger.groupBy(_key().alias("k")).agg(F.max("run").alias("run"))
    return (ledger.withColumn("k", _key()).join(latest, ["k", "run"]).where("NOT resolved")
            .select("run", "page", "position", "entry", "rule", "raw"))


def append(path: str, run: int, rejects: DataFrame, entries: DataFrame, pages: DataFrame,
           earlier: DataFrame | None = None) -> None:
    """Write run ``run``: its rejects, and a resolution for each open reject of ``earlier`` whose
    entry is among ``entries`` (_entry) or whose page is among ``pages`` (_page) without being rejected again."""
    rows = rejects.select("page", "position", "entry", "rule", "raw", F.lit(False).alias("resolved"))
    if earlier is not None:
        seen = entries.select(F.concat(F.lit("entry "), F.col(ENTRY)).alias("k")).unionByName(
            pages.select(F.concat(F.lit("page "), F.col("_page")).alias("k"))).distinct()
        settled = (open_rejects(earlier).select(_key().alias("k"), "page", "entry").dropDuplicates(["k"])
                   .join(seen, "k").join(rejects.select(_key().alias("k")).distinct(), "k", "left_anti"))
        rows = rows.unionByName(settled.select(
            "page", F.lit(None).cast("int").alias("position"), "entry", F.lit(None).cast("string").alias("rule"),
            F.lit(None).cast("string").alias("raw"), F.lit(True).alias("resolved")))
    rows.write.mode("overwrite").parquet(f"{path.rstrip('/')}/run={run}")
