"""Projections shared by the query library.

Every table is narrowed to the columns a query reads *before* it is joined,
and its ``id`` is renamed to the foreign-key name children use.  Joins can
then be written with USING-style column lists, Catalyst prunes the parquet
scans to exactly these columns, and no two inputs of a join share a name.

No join is hinted: label tables grow with free text, so their size is left to
AQE as well, which measures the built side at runtime before it chooses a
broadcast and otherwise keeps the sort-merge / shuffled-hash plan.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

Tables = Mapping[str, DataFrame]


def entries(t: Tables) -> DataFrame:
    return t["register_entry"].select(F.col("id").alias("entry_id"), "register_number")


def identities(t: Tables, *cols: str) -> DataFrame:
    return t["lobbyist_identity"].select(F.col("id").alias("identity_id"), "entry_id", *cols)


def labels(t: Tables, key: str = "label_id", de: str = "de", *, domain: str | None = None) -> DataFrame:
    """code_label narrowed to (key, de)."""
    cl = t["code_label"]
    if domain is not None:
        cl = cl.filter(F.col("domain") == domain)
    return cl.select(F.col("id").alias(key), F.col("de").alias(de))


def countries(t: Tables) -> DataFrame:
    return t["country_label"].select(F.col("id").alias("country_id"),
                                     F.col("code").alias("country_code"))


def addresses(t: Tables, *cols: str) -> DataFrame:
    return t["address"].select(F.col("id").alias("address_id"), *cols)


def entry_topics(t: Tables, *, with_label: bool = True) -> DataFrame:
    """(entry_id, label_id[, de]) over activities ⋈ field_of_interest ⋈ label.

    One row per field-of-interest row: the fan-out the reference's joins
    produce is kept (several queries sum over it on purpose).
    """
    ai = t["activities_interests"].select(F.col("id").alias("activities_id"), "entry_id")
    foi = t["field_of_interest"].select("activities_id", "label_id")
    out = ai.join(foi, "activities_id")
    if with_label:
        out = out.join(labels(t), "label_id")
    return out.drop("activities_id")


def expenses(t: Tables, *cols: str) -> DataFrame:
    return t["financial_expenses"].select("entry_id", *cols)


def sector_entries(t: Tables, sectors) -> DataFrame:
    """Topic rows of the selected sectors (labels matched on ``de``).

    An empty list selects all sectors (the dashboards' "All" option).
    """
    topics = entry_topics(t)
    if sectors:
        topics = topics.filter(F.col("de").isin(list(sectors)))
    return topics


def sql_list(values) -> str:
    """Render a parameter list as SQL string literals for the oracle text."""
    return ", ".join("'" + str(v).replace("'", "''") + "'" for v in values)
