"""SRC-11: both materialized views kept up to date from changed entries alone.

State, in a bucketed store of its own: per entry and topic the number of topic
rows, the sum of expenses and the number of amounts (``topic_share``), and the rows
of the revolving-door view (``revolving``).  A refresh gets the tables of the
changed entries, as an ingest batch has them, and

* takes the changed entries' old shares from the buckets they fall in, and the new
  shares from the batch; the signed difference per topic is added to the topic
  sums.  An entry has one share per topic, so entries per topic, sums and the
  average stay exact when entries come, change or lose a topic;
* replaces the changed entries' rows of both state tables, in these buckets only.

No unchanged entry is read from the register's tables.  The topic sums are written
whole (one row per topic) under the number of the version that commits them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from civicflow.operators.fanout import child_stats, exact
from civicflow.operators.flatten import ENTRY
from civicflow.plans.common import Tables, entries, entry_topics
from civicflow.plans.views import mv_revolving_door_network
from civicflow.sources import buckets as B
from civicflow.sources.store import stage

_SUMS = ["lobbyists", "total", "amounts"]


def topic_shares(t: Tables) -> DataFrame:
    """(_entry, field_of_interest, total, amounts) of each entry and topic: expenses once per topic row."""
    topics = (entries(t).join(entry_topics(t), "entry_id")
              .groupBy("entry_id", "register_number", "de").agg(F.count(F.lit(1)).alias("n")))
    fe = child_stats(t["financial_expenses"], "entry_id", "expenses_to_eur", "fe")
    zero = F.lit(0).cast("decimal(38,0)")
    return topics.join(fe, "entry_id", "left").select(
        F.col("register_number").alias(ENTRY), F.col("de").alias("field_of_interest"),
        F.coalesce(exact("n", "fe_sum").cast("decimal(38,0)"), zero).alias("total"),
        F.coalesce(exact("n", "fe_n").cast("decimal(38,0)"), zero).alias("amounts"))


def _topic_sums(shares: DataFrame, sign: int) -> DataFrame:
    return shares.select("field_of_interest", F.lit(sign).cast("long").alias("lobbyists"),
                         *((F.col(c) * sign).cast("decimal(38,0)").alias(c) for c in _SUMS[1:]))


def refresh_changed(spark: SparkSession, out: str, changed: Tables, stream: str = "", epoch: int = 0) -> int:
    """Apply the tables ``changed`` (all rows of the entries in its ``register_entry``); returns the version."""
    out = out.rstrip("/")
    last = B.last_version(spark, out)
    number = last["number"] + 1 if last else 0
    keys = stage(changed["register_entry"].select(F.col("register_number").alias(ENTRY)).distinct(), "changed")
    shares = stage(topic_shares(changed), "shares")
    delta = _topic_sums(shares, 1)
    if last:
        touched = {r[0] for r in keys.select(B.bucket("topic_share", last["buckets"])).distinct().collect()}
        old = B.read_table(spark, out, last, "topic_share", touched).join(keys, ENTRY, "left_semi")
        delta = delta.unionByName(_topic_sums(old, -1)).unionByName(
            spark.read.parquet(f"{out}/tops/{last['number']}"))
    sums = delta.groupBy("field_of_interest").agg(*(F.sum(c).cast(delta.schema[c].dataType).alias(c) for c in _SUMS))
    # The version that is committed below names these sums.
    sums.where("lobbyists > 0").write.mode("overwrite").parquet(f"{out}/tops/{number}")
    people = mv_revolving_door_network(changed).withColumn(ENTRY, F.col("register_number"))
    B.apply(spark, out, {"register_entry": keys, "topic_share": shares, "revolving": people}, stream, epoch)
    return number


def maintained_views(spark: SparkSession, out: str) -> dict[str, DataFrame]:
    """Both views as the last refresh left them."""
    last = B.last_version(spark, out)
    tops = spark.read.parquet(f"{out.rstrip('/')}/tops/{last['number']}")
    some = F.col("amounts") > 0
    return {
        "mv_financial_tops": tops.select(
            "field_of_interest", F.col("lobbyists").alias("lobbyist_count"),
            F.when(some, F.col("total")).alias("total_spend_max"),
            F.when(some, F.col("total").cast("double") / F.col("amounts").cast("double")).alias("avg_spend")),
        "mv_revolving_door_network": B.read_table(spark, out, last, "revolving").drop(ENTRY)}
