"""Run every query once on written register tables and report plan features.

    python tools/plan_report.py [sf_dir] [name-prefix ...]

For each query: shuffle stages, broadcast stages and reused exchanges of the
final adaptive plan, and a flag when the plan contains a nested-loop or
cartesian join or evaluates Python.
"""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from civicflow.plans.registry import load_all  # noqa: E402
from civicflow.plans.tables import register_model  # noqa: E402
from civicflow.session import build_session, shared_path  # noqa: E402
from civicflow.sources.fixtures import VIEWS, register_tables  # noqa: E402
from civicflow.sources.store import read_tables, refresh_all, write_tables  # noqa: E402

FLAGS = ("NestedLoop", "CartesianProduct", "BatchEvalPython", "ArrowEvalPython")


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    prefixes = sys.argv[2:]
    spark = build_session("local[8]", shuffle_partitions=16)
    derived = register_tables(spark, sf_dir)
    out = shared_path(spark, "plan-report", unique=True)
    names = [n for n, _ in VIEWS if not n.startswith("b_")]
    write_tables({n: derived[n] for n in names}, out)
    base = read_tables(spark, out, names)
    tables = register_model({**base, **refresh_all(register_model(base), f"{out}/mv")})
    for name, spec in load_all().items():
        if spec.section == "ingest" or (prefixes and not any(name.startswith(p)
                                                             for p in prefixes)):
            continue
        df = spec(tables)
        df.collect()
        plan = df._jdf.queryExecution().executedPlan().toString()
        bad = [f for f in FLAGS if f in plan]
        print(f"{name:30s} shuffles={plan.count('ShuffleQueryStage'):3d} "
              f"broadcasts={plan.count('BroadcastQueryStage'):3d} "
              f"reused={plan.count('ReusedExchange'):3d} {' '.join(bad)}")


if __name__ == "__main__":
    main()
