"""Rule-based text classification of party affiliation (JVM-side).

Both classifiers are ordered CASE chains — first match wins — built from
``ilike`` / ``rlike`` column expressions, so they stay inside whole-stage
codegen; no Python runs per row.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Labels and patterns that must equal the reference's.
# ---------------------------------------------------------------------------

# Substring (ILIKE) rules over a government function's position text.
POSITION_PARTIES: list[tuple[str, list[str]]] = [
    ("Union (CDU/CSU)", ["CDU", "CSU"]),
    ("SPD", ["SPD"]),
    ("Bündnis 90/Die Grünen", ["Grüne"]),
    ("FDP", ["FDP"]),
    ("AfD", ["AfD"]),
    ("Die Linke", ["Linke"]),
    ("BSW", ["BSW"]),
]
POSITION_OTHER = "Sonstige / Unbekannt"

# The shorter four-party variant printed in the report.
REPORT_PARTIES: list[tuple[str, list[str]]] = [
    ("Union", ["CDU", "CSU"]),
    ("SPD", ["SPD"]),
    ("Grüne", ["Grüne"]),
    ("FDP", ["FDP"]),
]

# Whole-word, case-insensitive rules over donations:
# (label, words in the description, words in the donor name, description
#  pattern that vetoes the rule).
DONATION_PARTIES: list[tuple[str, list[str], list[str], str | None]] = [
    ("CDU", ["CDU", "Christlich Demokratische Union"], [], None),
    ("CSU", ["CSU", "Christlich-Soziale Union"], [], None),
    ("SPD", ["SPD", "Sozialdemokratische Partei"], ["SPD"], None),
    ("Grüne", ["Grüne", "Bündnis 90"], [], "Grünes Band"),
    ("FDP", ["FDP", "Freie Demokratische"], [], None),
    ("AfD", ["AfD", "Alternative für Deutschland"], [], None),
    ("Die Linke", ["Linke", "Die Linke"], [], None),
]
DONATION_OTHER = "Andere"
DONATION_FILTER = ["CDU", "CSU", "SPD", "Grüne", "FDP", "AfD", "Linke"]


def word_regex(words: list[str], java: bool = True) -> str:
    """Alternation of ``words`` between word boundaries.

    Java needs ``(?iU)``: case-insensitive *and* Unicode-aware, otherwise
    "GRÜNE" does not match "Grüne".  For the DuckDB oracle the flags are
    passed separately.
    """
    body = r"\b(" + "|".join(words) + r")\b"
    return ("(?iU)" + body) if java else body


def classify_ilike(col: Column, rules, other: str) -> Column:
    expr = None
    for label, patterns in rules:
        cond = None
        for p in patterns:
            c = col.ilike(f"%{p}%")
            cond = c if cond is None else (cond | c)
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return expr.otherwise(F.lit(other))


def classify_regex(description: Column, name: Column) -> Column:
    expr = None
    for label, desc_words, name_words, veto in DONATION_PARTIES:
        cond = description.rlike(word_regex(desc_words))
        if name_words:
            cond = cond | name.rlike(word_regex(name_words))
        if veto:
            cond = cond & ~description.rlike("(?iU)" + veto)
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return expr.otherwise(F.lit(DONATION_OTHER))
