"""Party dashboard: text classification of positions and donations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from civicflow.functions.text import (DONATION_PARTIES, DONATION_FILTER, POSITION_PARTIES,
                                      POSITION_OTHER, DONATION_OTHER, classify_ilike,
                                      classify_regex, word_regex)
from civicflow.operators.ordering import asc, desc, top_k
from civicflow.plans.common import Tables
from civicflow.plans.registry import query

S = "party"


def _ilike_case_sql(col: str, rules, other: str) -> str:
    whens = []
    for label, patterns in rules:
        cond = " OR ".join(f"lower({col}) LIKE lower('%{p}%')" for p in patterns)
        whens.append(f"WHEN {cond} THEN '{label}'")
    return "CASE " + " ".join(whens) + f" ELSE '{other}' END"


@query("pty_ilike_case", section=S, oracle=f"""
SELECT {_ilike_case_sql('function_position', POSITION_PARTIES, POSITION_OTHER)} AS party, COUNT(*) AS connections
FROM recent_gov_house_reps WHERE function_position IS NOT NULL
GROUP BY 1 ORDER BY 2 DESC""")
def pty_ilike_case(t: Tables) -> DataFrame:
    return (t["recent_gov_house_reps"].filter(F.col("function_position").isNotNull())
            .groupBy(classify_ilike(F.col("function_position"), POSITION_PARTIES, POSITION_OTHER)
                     .alias("party"))
            .agg(F.count(F.lit(1)).alias("connections"))
            .orderBy(desc("connections"), asc("party")))


def _regex_case_sql() -> str:
    whens = []
    for label, desc_words, name_words, exclude in DONATION_PARTIES:
        cond = f"regexp_matches(d.description, '{word_regex(desc_words, False)}', 'i')"
        if name_words:
            cond += f" OR regexp_matches(d.name, '{word_regex(name_words, False)}', 'i')"
        if exclude:
            cond = f"({cond}) AND NOT regexp_matches(d.description, '{exclude}', 'i')"
        whens.append(f"WHEN {cond} THEN '{label}'")
    return "CASE " + " ".join(whens) + f" ELSE '{DONATION_OTHER}' END"


@query("pty_regex_case", section=S, oracle=f"""
SELECT d.name AS donor, {_regex_case_sql()} AS party, d.description AS purpose, d.amount_to_eur AS amount
FROM donator_item d
WHERE regexp_matches(d.description, '{word_regex(DONATION_FILTER, False)}', 'i')
   OR regexp_matches(d.name, '{word_regex(DONATION_FILTER, False)}', 'i')
ORDER BY 4 DESC NULLS FIRST, 1 NULLS LAST, 2 NULLS LAST, 3 NULLS LAST LIMIT 50""")
def pty_regex_case(t: Tables) -> DataFrame:
    d = t["donator_item"]
    hit = (F.col("description").rlike(word_regex(DONATION_FILTER))
           | F.col("name").rlike(word_regex(DONATION_FILTER)))
    rows = (d.filter(hit)
            .select(F.col("name").alias("donor"),
                    classify_regex(F.col("description"), F.col("name")).alias("party"),
                    F.col("description").alias("purpose"),
                    F.col("amount_to_eur").alias("amount")))
    return top_k(rows, 50, desc("amount"), asc("donor"), asc("party"), asc("purpose"))
