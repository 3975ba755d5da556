"""Render a query's oracle text into self-contained DuckDB SQL.

The oracle reads the driver's raw tables (pre-registered in DuckDB) through
the register views of ``civicflow.sources.fixtures`` and, where a query reads
a materialized view, through that view's SQL — all as ``WITH`` clauses.
"""

from __future__ import annotations

import re

from civicflow.sources import fixtures

_WORD = re.compile(r"[a-z_]+")
_LEAD_WITH = re.compile(r"^\s*WITH\s+(RECURSIVE\s+)?", re.IGNORECASE)


def render(sql: str) -> str:
    from civicflow.plans.views import DERIVED_SQL
    words = set(_WORD.findall(sql))
    derived = [d for d in DERIVED_SQL if d in words]
    scan = sql + " ".join(DERIVED_SQL[d] for d in derived)
    base = fixtures.closure(w for w in set(_WORD.findall(scan)) if w in fixtures.VIEW_SQL)
    ctes = [f"{n} AS ({fixtures._oracle_view(n)})" for n in base]
    ctes += [f"{d} AS ({' '.join(DERIVED_SQL[d].split())})" for d in derived]
    body = sql.strip().rstrip(";")
    if not ctes:
        return body
    head = "WITH " + ",\n".join(ctes)
    m = _LEAD_WITH.match(body)
    if m:
        if m.group(1):
            head = head.replace("WITH ", "WITH RECURSIVE ", 1)
        return head + ",\n" + body[m.end():]
    return head + "\n" + body
