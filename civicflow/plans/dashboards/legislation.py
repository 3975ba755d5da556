"""Legislation dashboard: regulatory projects, ministries, draft bills."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from civicflow.operators.ordering import asc, desc, top_k
from civicflow.plans.common import Tables, labels
from civicflow.plans.registry import query

S = "legislation"
UNNAMED = "Unbenannt"


@query("leg_top_projects", section=S, oracle=f"""
SELECT COALESCE(title, '{UNNAMED}') AS title, count(*) AS mentions FROM regulatory_project_item
GROUP BY regulatory_project_item.title ORDER BY 2 DESC, regulatory_project_item.title NULLS LAST LIMIT 20""")
def leg_top_projects(t: Tables) -> DataFrame:
    agg = t["regulatory_project_item"].groupBy("title").agg(F.count(F.lit(1)).alias("mentions"))
    return (top_k(agg, 20, desc("mentions"), asc("title"))
            .select(F.coalesce("title", F.lit(UNNAMED)).alias("title"), "mentions"))


@query("leg_ministries", section=S, oracle="""
SELECT lm.short_title, lm.title, count(*) AS n
FROM leading_ministry lm JOIN reg_project_printed_matter_ministry rpm ON lm.id = rpm.ministry_id
GROUP BY lm.short_title, lm.title ORDER BY n DESC, 1, 2 LIMIT 15""")
def leg_ministries(t: Tables) -> DataFrame:
    lm = t["leading_ministry"].select(F.col("id").alias("ministry_id"), "short_title", "title")
    agg = (t["reg_project_printed_matter_ministry"].select("ministry_id").join(lm, "ministry_id")
           .groupBy("short_title", "title").agg(F.count(F.lit(1)).alias("n")))
    return top_k(agg, 15, desc("n"), asc("short_title"), asc("title"))


@query("leg_draft_bills", section=S, oracle="""
SELECT db.title, strftime(db.publication_date, '%Y-%m-%d') AS date, count(*) AS mentions
FROM draft_bill db LEFT JOIN draft_bill_ministry dbm ON db.id = dbm.draft_bill_id
GROUP BY db.title, db.publication_date
ORDER BY db.publication_date DESC NULLS LAST, db.title NULLS LAST LIMIT 20""")
def leg_draft_bills(t: Tables) -> DataFrame:
    dbm = (t["draft_bill_ministry"].groupBy("draft_bill_id")
           .agg(F.count(F.lit(1)).alias("m")))
    db = t["draft_bill"].select(F.col("id").alias("draft_bill_id"), "title", "publication_date")
    # LEFT JOIN then COUNT(*): a bill without ministries still counts once.
    agg = (db.join(dbm, "draft_bill_id", "left")
           .groupBy("title", "publication_date")
           .agg(F.sum(F.greatest(F.coalesce("m", F.lit(0)), F.lit(1))).alias("mentions")))
    return (top_k(agg, 20, F.col("publication_date").desc_nulls_last(), asc("title"))
            .select("title", F.date_format("publication_date", "yyyy-MM-dd").alias("date"),
                    "mentions"))


@query("leg_topics", section=S, oracle="""
SELECT COALESCE(cl.de, rpf.field_of_interest_text) AS topic, count(*) AS n
FROM reg_project_field_of_interest rpf LEFT JOIN code_label cl ON rpf.label_id = cl.id
GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 15""")
def leg_topics(t: Tables) -> DataFrame:
    agg = (t["reg_project_field_of_interest"].select("label_id", "field_of_interest_text")
           .join(labels(t), "label_id", "left")
           .groupBy(F.coalesce("de", "field_of_interest_text").alias("topic"))
           .agg(F.count(F.lit(1)).alias("n")))
    return top_k(agg, 15, desc("n"), asc("topic"))
