"""Operator 2: Order MinHash fingerprints, in DataFrame functions only.

The text's words (cut at ``PIECE`` characters, so that text without spaces
has words too) give k-mers of ``K`` words.  Each k-mer gets its occurrence
number in the text, and the pair (k-mer, occurrence) is hashed once.  The
hash's top bits deal the pairs into ``BINS`` bins (one permutation instead of
one per component); in each bin the ``L`` = 2 minimal pairs are kept *in text
order* and hashed as a tuple.  Moving text changes tuples even where the set
of k-mers stays, so the share of equal tuples falls with edit distance, not
only with set overlap.

A fingerprint is the array of ``bin << 32 | tuple`` of the non-empty bins,
ascending; as text, 10 hex digits each.  Likeness is the number of bins with
equal tuples over the number of bins that either text fills.

Edge cases: a null text is the empty text; empty texts (or texts of white
space) have the empty fingerprint and likeness 1 among themselves, 0 to
others; texts shorter than ``K`` words are one k-mer.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from civicflow.llm.common import NULL_ID, prepare

K = 3
BINS_BITS = 6
PIECE = 12
#: Ranges of doc_id per shuffle partition, and the most ranges in all.
RANGES = 4
MAX_RANGES = 4096

_WORDS = f"\\S{{1,{PIECE}}}"


def fingerprint(df: DataFrame, text: str, out: str) -> DataFrame:
    """``df`` with column ``out``: the fingerprint of column ``text``, an array of longs.

    A column that a lambda reads is read outside it too: the optimizer would
    otherwise move its expression into the lambda, to run once per element."""
    base = f"__{out}"
    w, s, a, b, g, m = (f"{base}_{x}" for x in "wsabgm")
    shift = 64 - BINS_BITS
    keep = df.columns
    df = df.withColumn(w, F.expr(
        f"transform(regexp_extract_all({text}, '{_WORDS.replace(chr(92), chr(92) * 2)}', 0), "
        f"x -> xxhash64(x))"))
    following = ", ".join(f"{w}[i + {j}]" for j in range(1, K))
    df = df.withColumn(s, F.expr(
        f"CASE WHEN size({w}) = 0 THEN array() WHEN size({w}) < {K} THEN array(xxhash64({w})) "
        f"ELSE transform(slice({w}, 1, size({w}) - {K - 1}), (x, i) -> xxhash64(x, {following})) "
        f"END"))
    # Equal k-mers side by side, in text order: the place in a run is the occurrence number.
    df = df.withColumn(a, F.expr(
        f"sort_array(transform({s}, (x, i) -> struct(x AS h, i AS p)))"))
    df = df.withColumn(b, F.expr(
        f"CASE WHEN size({a}) = 0 THEN array() ELSE filter(sequence(0, size({a}) - 1), "
        f"i -> i = 0 OR {a}[i].h <> {a}[i - 1].h) END"))
    occurrence = f"{base}_o"
    df = df.withColumn(occurrence, F.expr(
        f"flatten(transform({b}, (x, r) -> "
        f"sequence(0, coalesce(get({b}, r + 1), size({a})) - x - 1)))"))
    df = df.withColumn(g, F.expr(
        f"sort_array(transform(arrays_zip({a}, {occurrence}), z -> "
        f"struct(xxhash64(z.{a}.h, z.{occurrence}) AS g, z.{a}.p AS p)))"))
    df = df.withColumn(m, F.expr(
        f"filter({g}, (x, i) -> i < 2 OR "
        f"shiftrightunsigned({g}[i - 2].g, {shift}) <> shiftrightunsigned(x.g, {shift}))"))
    df = df.withColumn(out, F.expr(f"""
        array_sort(filter(transform({m}, (x, i) ->
          CASE WHEN i > 0 AND shiftrightunsigned({m}[i - 1].g, {shift}) = shiftrightunsigned(x.g, {shift})
               THEN NULL
               ELSE shiftleft(shiftrightunsigned(x.g, {shift}), 32) + (
                 CASE WHEN i + 1 >= size({m})
                        OR shiftrightunsigned({m}[i + 1].g, {shift}) <> shiftrightunsigned(x.g, {shift})
                      THEN xxhash64(x.g)
                      WHEN x.p < {m}[i + 1].p THEN xxhash64(x.g, {m}[i + 1].g)
                      ELSE xxhash64({m}[i + 1].g, x.g) END & 4294967295L)
          END), v -> v IS NOT NULL))"""))
    return df.select(*keep, out)


def likeness(left: str, right: str) -> Column:
    """Share of equal bins of two fingerprint columns; 1 for two empty ones."""
    bins = (f"size(array_union(transform({left}, v -> shiftright(v, 32)), "
            f"transform({right}, v -> shiftright(v, 32))))")
    return F.expr(f"CASE WHEN size({left}) = 0 AND size({right}) = 0 THEN 1D "
                  f"ELSE CAST(size(array_intersect({left}, {right})) AS DOUBLE) / {bins} END")


def as_text(column: str) -> Column:
    return F.expr(f"array_join(transform({column}, v -> lpad(hex(v), 10, '0')), '')")


def with_next(df: DataFrame, columns: list[str]) -> DataFrame:
    """``df`` (doc_id, ...) with ``next_<c>`` of the next row by doc_id (after the last: the first).

    Rows are dealt into ranges of doc_id whose bounds are doc_ids that occur;
    the row at a bound also goes, as a guard, to the range before.  So each
    range has the row after its last, and no window spans the table.  The
    bounds are the only values that reach the driver, at most MAX_RANGES."""
    spark = df.sparkSession
    n = min(MAX_RANGES, RANGES * int(spark.conf.get("spark.sql.shuffle.partitions")))
    found = df.agg(F.min("doc_id"), F.percentile_approx(
        "doc_id", [i / n for i in range(1, n)], 20 * n)).first()
    bounds = sorted({found[0], *(found[1] or [])} - {None})
    if not bounds:
        return df.select("*", *(F.col(c).alias(f"next_{c}") for c in columns))
    array = F.array(*[F.lit(b).cast("long") for b in bounds])
    place = F.size(F.filter(array, lambda b: b <= F.col("doc_id"))) - 1
    def copy(place_: Column, guard: bool) -> Column:
        return F.struct(place_.alias("range"), F.lit(guard).alias("guard"))
    own = copy(F.col("__range"), False)
    ranges = F.when(F.array_contains(array, F.col("doc_id")), F.array(
        own, copy(F.pmod(F.col("__range") - 1, F.lit(len(bounds))), True))).otherwise(F.array(own))
    dealt = (df.withColumn("__range", place).withColumn("__to", F.explode(ranges))
             .select(*df.columns, F.col("__to.range").alias("__range"),
                     F.col("__to.guard").alias("__guard")))
    order = Window.partitionBy("__range").orderBy("__guard", "doc_id", columns[0])
    return (dealt.select("*", *(F.lead(c).over(order).alias(f"next_{c}") for c in columns))
            .where(~F.col("__guard")).drop("__range", "__guard"))


def edited_fingerprints(docs: DataFrame) -> DataFrame:
    """Per document of ``docs`` (doc_id, text): its fingerprint, its edited text's, and likenesses.

    The edited text has its last floor(n/4) code points replaced by the first
    as many (or all) of the next document."""
    prepare(docs.sparkSession)
    rows = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(NULL_ID)).alias("doc_id"),
                       F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    rows = with_next(fingerprint(rows, "text", "fp"), ["text", "fp"])
    quarter = "CAST(floor(char_length(text) / 4) AS INT)"
    rows = rows.select(
        "doc_id", "fp", "next_fp", F.char_length("text").cast("long").alias("n_chars"),
        F.expr(f"concat(substring(text, 1, char_length(text) - {quarter}), "
               f"substring(next_text, 1, {quarter}))").alias("edited"))
    rows = rows.withColumn("edited_sha256", F.sha2(F.col("edited"), 256))
    rows = fingerprint(rows, "edited", "efp")
    return rows.select(
        F.nullif(F.col("doc_id"), F.lit(NULL_ID)).alias("doc_id"), "n_chars", "edited_sha256",
        as_text("fp").alias("fingerprint"), as_text("efp").alias("edited_fingerprint"),
        likeness("fp", "efp").alias("near_edited"), likeness("fp", "next_fp").alias("near_next"))
