"""civicflow: a Spark-native analytics engine for a public lobbying register.

Layout
------
sources/    landed JSON pages, register-shaped fixtures, table storage
functions/  column-expression helpers (normalizers, text classification,
            ordered string aggregation)
operators/  DataFrame-level building blocks (top-k, rank <= k, OR-join,
            disjunctive semi-join, fan-out arithmetic, flatteners)
plans/      views, materialized views and the query library
streaming/  incremental ingest of newly landed pages
"""

__version__ = "0.1.0"
