import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from civicflow.session import build_session
    ckpt = tempfile.mkdtemp(prefix="civicflow-test-ckpt-")
    s = build_session("local[4]", app="civicflow-tests", shuffle_partitions=4,
                      extra={"spark.checkpoint.dir": ckpt,
                             "spark.driver.memory": "8g"})
    yield s
    s.stop()


@pytest.fixture(scope="session")
def tables(spark):
    from civicflow.plans.tables import register_model
    from civicflow.sources.fixtures import register_tables
    return register_model(register_tables(spark, SF_SMALL))


@pytest.fixture(scope="session")
def duck():
    import duckdb
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"]:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


def norm(v):
    import math
    if v is None:
        return None
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6)
    if hasattr(v, "as_tuple") and not isinstance(v, (str, bytes)):
        return round(float(v), 6)
    if isinstance(v, (list, tuple)):
        return tuple(norm(x) for x in v)
    if hasattr(v, "isoformat"):
        return v.isoformat().replace("T", " ")
    return v


def rows_key(row):
    return tuple((x is None, str(type(x)), str(x)) for x in row)


def same_rows(sdf, duck_result):
    cols = sdf.columns
    srows = sorted((tuple(norm(r[c]) for c in cols) for r in sdf.collect()), key=rows_key)
    dcols = [d[0] for d in duck_result.description]
    assert sorted(dcols) == sorted(cols), (cols, dcols)
    idx = [dcols.index(c) for c in cols]
    drows = sorted((tuple(norm(r[i]) for i in idx) for r in duck_result.fetchall()), key=rows_key)
    return srows, drows
