"""SRC-10: incremental ingest of newly landed pages with Structured Streaming.

The reference runs a producer / bounded queue / worker pool that writes one
entry per database transaction.  Here a file-source stream picks up new page
files; every micro-batch goes through the batch ingest (extract → merge →
de-duplicate → flatten → quarantine) and is applied to the store, of which it
rewrites only the buckets that its entries fall in (``sources.buckets``).
Rejected entries and unreadable pages go to the store's ledger (``sources.ledger``).

A version is committed by creating a numbered file as the last step.  Numbers
only grow, also when a stream starts anew at epoch 0 from an empty checkpoint.
A batch that its stream has committed already (replayed after a failure) is
skipped; one that failed half way overwrites its own ledger rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from civicflow.session import shared_path
from civicflow.sources import buckets as B
from civicflow.sources import ledger
from civicflow.sources import pages as P
from civicflow.sources.buckets import KEEP, versions
from civicflow.sources.store import LABEL_TABLES, ingest_pages, stage

__all__ = ["KEEP", "apply_batch", "current_tables", "rejects", "stream_ingest", "versions"]


def current_tables(spark: SparkSession, out: str) -> dict[str, DataFrame] | None:
    """The tables of the last committed version; None before the first."""
    return B.read_store(spark, out)


def rejects(spark: SparkSession, out: str) -> DataFrame | None:
    """The ledger of the committed versions; None before the first."""
    last = B.last_version(spark, out)
    return ledger.read_ledger(spark, f"{out.rstrip('/')}/_rejects", last["number"]) if last else None


def apply_batch(pages: DataFrame, epoch_id: int, out: str, stream: str = "") -> None:
    """One micro-batch of ``stream``: ingest the new pages and commit a new store version."""
    spark = pages.sparkSession
    done = versions(spark, out)
    if any(v["stream"] == stream and v["epoch"] >= epoch_id for v in done):
        return
    pages = stage(pages, "batch")
    tables, _, rejected = ingest_pages(pages)
    # The store reads each table once, but these more often.
    incoming = tables | {name: stage(tables[name], name) for name in (*LABEL_TABLES, "register_entry")}
    number = done[-1]["number"] + 1 if done else 0
    ledger.append(f"{out.rstrip('/')}/_rejects", number, stage(rejected, "ledger"), incoming["register_entry"],
                  pages.select("_page").distinct(), rejects(spark, out))
    B.apply(spark, out, incoming, stream, epoch_id)


def stream_ingest(spark: SparkSession, landing: str, out: str,
                  checkpoint: str | None = None, available_now: bool = True) -> StreamingQuery:
    """Start the stream: new page files under ``landing`` → store ``out``."""
    reader = (spark.readStream.schema(P._landing_schema())
              .option("multiLine", True)
              .option("mode", "PERMISSIVE")
              .option("columnNameOfCorruptRecord", "_corrupt_record")
              .json(landing)
              .withColumn("_page", F.col("_metadata.file_path")))
    ckpt = checkpoint or shared_path(spark, "stream-checkpoints", unique=True)
    writer = (reader.writeStream
              .foreachBatch(lambda df, epoch: apply_batch(df, epoch, out, ckpt))
              .option("checkpointLocation", ckpt))
    writer = writer.trigger(availableNow=True) if available_now else \
        writer.trigger(processingTime="1 minute")
    return writer.start()
