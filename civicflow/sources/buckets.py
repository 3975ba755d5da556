"""SRC-6 / SRC-10: a store of bucketed tables with copy-on-write versions.

Every table is cut into hash buckets of the register number (label tables: of the label id).
A version is a manifest: for each table and bucket the folder that holds its
rows.  A batch reads and rewrites only the buckets its entries fall in, into a
new folder, and commits by creating the next numbered file, which holds the
manifest; all other buckets are taken over by name.  So the cost of a batch follows the
buckets it touches, and readers of an older version keep seeing that version.

A manifest has at most tables x buckets names, whatever the number of rows.
Numbers only grow, and creating a number twice fails: of two writers one loses.
"""

from __future__ import annotations

import json
import uuid
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from civicflow.operators.flatten import ENTRY
from civicflow.sources.store import ENUM_TABLES, LABEL_TABLES, merge_labels

#: Buckets of a new store; choose rows / BUCKETS so that a bucket's file has some 100 MB.
BUCKETS = 16
#: Committed versions whose files stay: readers of an earlier one may still run.
KEEP = 3


def _fs(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def _children(spark: SparkSession, path: str) -> list[str]:
    p, fs = _fs(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []


def _read(spark: SparkSession, path: str) -> dict:
    p, fs = _fs(spark, path)
    stream = fs.open(p)
    try:
        text = spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
    return json.loads(text)


def versions(spark: SparkSession, out: str) -> list[dict]:
    """Committed manifests, oldest first: number, stream, epoch, buckets, tables, schemas."""
    base = f"{out.rstrip('/')}/_commits"
    return [_read(spark, f"{base}/{name}") for name in _children(spark, base) if name.isdigit()]


def last_version(spark: SparkSession, out: str) -> dict | None:
    base = f"{out.rstrip('/')}/_commits"
    names = [n for n in _children(spark, base) if n.isdigit()]
    return _read(spark, f"{base}/{names[-1]}") if names else None


def _commit(spark: SparkSession, out: str, manifest: dict) -> None:
    p, fs = _fs(spark, f"{out.rstrip('/')}/_commits/{manifest['number']:010d}")
    stream = fs.create(p, False)               # fails if the number is taken
    try:
        stream.write(bytearray(json.dumps(manifest).encode()))
    finally:
        stream.close()


def _expire(spark: SparkSession, out: str) -> None:
    """Remove all but the last KEEP versions, commit file first, then folders that none of these names."""
    base = out.rstrip("/")
    names = [n for n in _children(spark, f"{base}/_commits") if n.isdigit()]
    for name in names[:-KEEP]:
        p, fs = _fs(spark, f"{base}/_commits/{name}")
        fs.delete(p, False)
    kept = [_read(spark, f"{base}/_commits/{n}") for n in names[-KEEP:]]
    used = {folder for m in kept for buckets in m["tables"].values() for folder in buckets.values()}
    first = min(m["number"] for m in kept)
    for folder in _children(spark, f"{base}/data"):
        # Folders of a number still to come belong to a writer at work.
        if folder not in used and int(folder.split("-")[0]) <= first:
            p, fs = _fs(spark, f"{base}/data/{folder}")
            fs.delete(p, True)


def bucket(name: str, buckets: int) -> Column:
    """Bucket of a row: by register number, of a label by its id, of a code table 0."""
    if name in ENUM_TABLES:
        return F.lit(0)
    key = F.col("id") if name in LABEL_TABLES else F.col(ENTRY)
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


def read_table(spark: SparkSession, out: str, manifest: dict, name: str,
               only: set[int] | None = None) -> DataFrame:
    """A table of a version, or some of its buckets."""
    schema = T.StructType.fromJson(manifest["schemas"][name])
    paths = [f"{out.rstrip('/')}/data/{folder}/{name}/_bucket={b}"
             for b, folder in manifest["tables"].get(name, {}).items() if only is None or int(b) in only]
    return spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)


def read_store(spark: SparkSession, out: str, manifest: dict | None = None) -> dict[str, DataFrame] | None:
    """All tables of the last (or a given) version; None if nothing was committed."""
    manifest = manifest or last_version(spark, out)
    if manifest is None:
        return None
    return {name: read_table(spark, out, manifest, name) for name in manifest["schemas"]}


def _touched(incoming: dict[str, DataFrame], name: str, buckets: int) -> set[int]:
    """Buckets of an incoming table's rows (at most ``buckets`` numbers)."""
    return {r[0] for r in incoming[name].select(bucket(name, buckets).alias("b")).distinct().collect()}


def apply(spark: SparkSession, out: str, incoming: dict[str, DataFrame], stream: str = "",
          epoch: int = 0, buckets: int = BUCKETS, parallel: int = 8) -> dict:
    """Replace the incoming entries' rows in all tables (SRC-6) and commit a new version.

    ``incoming`` should be cheap to read twice (staged).  An entry that comes again loses all of its old rows; labels
    are kept and only gain codes or fill missing texts; the code tables are written once."""
    last = last_version(spark, out)
    number = last["number"] + 1 if last else 0
    buckets = last["buckets"] if last else buckets
    folder = f"{number:010d}-{uuid.uuid4().hex[:8]}"
    keys = incoming["register_entry"].select(ENTRY).distinct()
    entry_buckets = _touched(incoming, "register_entry", buckets)
    tables = {name: dict(b) for name, b in last["tables"].items()} if last else {}
    schemas = dict(last["schemas"]) if last else {}

    def write(name: str) -> tuple[str, set[int], list[str]]:
        new = incoming[name]
        if name in ENUM_TABLES:
            if tables.get(name):
                return name, set(), []
            touched, rows = {0}, new
        elif name in LABEL_TABLES:
            touched = _touched(incoming, name, buckets)
            rows = merge_labels(read_table(spark, out, last, name, touched), new) \
                if last and name in schemas else new
        else:
            touched = entry_buckets
            rows = new
            if last and name in schemas:
                # Old rows of the touched buckets, without those of entries that come again.
                rows = read_table(spark, out, last, name, touched).join(keys, ENTRY, "left_anti").unionByName(new)
        path = f"{out.rstrip('/')}/data/{folder}/{name}"
        rows.withColumn("_bucket", bucket(name, buckets)).repartition("_bucket").write \
            .partitionBy("_bucket").parquet(path)
        return name, touched, [n.split("=")[1] for n in _children(spark, path) if n.startswith("_bucket=")]

    with ThreadPoolExecutor(max_workers=max(1, parallel)) as pool:
        done = list(pool.map(write, list(incoming)))
    for name, touched, written in done:
        schemas[name] = json.loads(incoming[name].schema.json())
        now = {b: f for b, f in tables.get(name, {}).items() if int(b) not in touched}
        tables[name] = now | {b: folder for b in written}
    manifest = {"number": number, "folder": folder, "stream": stream, "epoch": epoch, "buckets": buckets,
                "tables": tables, "schemas": schemas}
    _commit(spark, out, manifest)
    _expire(spark, out)
    return manifest
