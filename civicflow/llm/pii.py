"""Operator 3: personal data by patterns, checksums and context words, in DataFrame functions only.

1. A pattern per kind proposes spans, leftmost and not overlapping.
2. A validator confirms them: octets of an IP address, Luhn of a card,
   number of digits of a phone, mod 97 of an IBAN.
3. The kind's prior score rises by ``CONTEXT_BONUS`` if one of its context words
   stands within ``CONTEXT_CHARS`` characters before the span; spans with a score
   of at least ``THRESHOLD`` count.  The base kinds reach it by themselves.

The patterns are possessive or guarded by a look-behind where the plain form
would backtrack or start anew inside a long run; they match the same spans.

Positions are code points; start inclusive, end exclusive.  They follow from
the lengths of the pieces between the matches by a two-level prefix sum.

Edge cases: a null or empty text has no spans; repeated rows and null
``doc_id`` values are kept; an empty table gives no row.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

THRESHOLD = 0.5
CONTEXT_BONUS = 0.3
CONTEXT_CHARS = 40
_BLOCK = 64


def _digits(c: Column) -> Column:
    return F.regexp_replace(c, "[^0-9]", "")


def _ip_ok(m: Column) -> Column:
    def octet(part: Column) -> Column:
        bare = F.regexp_replace(part, "^0+", "")
        return (F.length(bare) == 0) | F.when(
            F.length(bare) <= 3, bare.try_cast("int") <= 255).otherwise(False)
    return F.forall(F.split(m, "\\."), octet)


def _luhn(digits: Column) -> Column:
    """Luhn's check over a string of digits."""
    values = F.transform(F.split(F.reverse(digits), ""), lambda d, i: F.when(
        i % 2 == 0, d.cast("int")).otherwise(
        (d.cast("int") * 2) - F.when(d.cast("int") > 4, 9).otherwise(0)))
    return F.aggregate(values, F.lit(0), lambda s, v: s + F.coalesce(v, F.lit(0))) % 10 == 0


def _card_ok(m: Column) -> Column:
    n = F.length(_digits(m))
    return F.when(n.between(16, 19), _luhn(_digits(m))).otherwise(False)


def _phone_ok(m: Column) -> Column:
    return F.length(_digits(m)).between(8, 15)


def _iban_ok(m: Column) -> Column:
    """ISO 7064 mod 97: country and check digits last, letters as 10 to 35, remainder 1."""
    bare = F.regexp_replace(m, " ", "")
    turned = F.concat(F.substring(bare, 5, 40), F.substring(bare, 1, 4))
    value = lambda c: F.when(c.between("0", "9"), F.ascii(c) - 48).otherwise(F.ascii(c) - 55)
    rest = F.aggregate(F.split(turned, ""), F.lit(0), lambda s, c: F.when(c == "", s).otherwise(
        (s * F.when(c.between("0", "9"), 10).otherwise(100) + value(c)) % 97))
    return F.length(bare).between(15, 34) & (rest == 1)


@dataclass(frozen=True)
class Kind:
    name: str
    pattern: str
    prior: float
    context: str                 # Java pattern over the lower-case text before the span
    valid: object = None
    needs: str | None = None     # a substring without which there is no match


# Kinds in the order of the results; the first four are the base kinds.
KINDS = (
    Kind("email", r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
         0.9, "mail|contact|write", None, "@"),
    Kind("ip", r"[0-9](?<![0-9]{2})[0-9]*+(?:\.[0-9]++){3}", 0.6, "\\bip\\b|host|server|address", _ip_ok, "."),
    Kind("card", r"[0-9](?:[\x20-]?[0-9])++", 0.9, "card|visa|master|amex|karte|tarjeta|carte", _card_ok),
    Kind("phone", r"\+[0-9][\x20().0-9-]+[0-9]", 0.7, "tel|phone|call|mobil|fax", _phone_ok, "+"),
    Kind("iban", r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])",
         0.9, "iban|account|konto|cuenta|compte", _iban_ok),
    Kind("ssn", r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])", 0.3, "ssn|social|security"),
    Kind("local_phone", r"(?<![0-9+.-])\(?[0-9]{3}\)?[\x20.-][0-9]{3}[\x20.-][0-9]{4}(?![0-9])", 0.3,
         "tel|phone|call|mobil|fax"),
)
BASE = ("email", "ip", "card", "phone")
_SPAN = "array<struct<kind:string,start:int,end:int,score:double>>"


def _sum(values: Column) -> Column:
    return F.aggregate(values, F.lit(0), lambda s, v: s + v)


def _prefix(steps: Column, blocks: Column, i: Column) -> Column:
    """steps[0] + ... + steps[i] by whole blocks and the rest of one."""
    b = (i / _BLOCK).cast("int")
    return _sum(F.slice(blocks, F.lit(1), b)) + _sum(F.slice(steps, b * _BLOCK + 1, i - b * _BLOCK + 1))


def spans(df: DataFrame, text: str = "text", out: str = "spans") -> DataFrame:
    """``df`` with array column ``out``: kind, start, end, score, by kind as listed, then start."""
    keep = df.columns
    t = F.coalesce(F.col(text).cast("string"), F.lit(""))
    found = []
    for k in KINDS:
        m, d, b, s = (f"__{k.name}_{x}" for x in "mdbs")
        none = F.array().cast("array<string>")
        hits = F.regexp_extract_all(t, F.lit(k.pattern), F.lit(0))
        df = df.withColumn(m, F.when(F.contains(t, F.lit(k.needs)), hits).otherwise(none)
                           if k.needs else hits)
        size = F.size(m)
        # steps: the piece before each match and the match before that piece.
        df = df.withColumn(d, F.when(size > 0, F.transform(
            F.slice(F.split(t, k.pattern, -1), F.lit(1), size),
            lambda p, i: F.length(p) + F.when(i > 0, F.length(F.get(F.col(m), i - 1))).otherwise(0)))
            .otherwise(F.array().cast("array<int>")))
        df = df.withColumn(b, F.when(size > 0, F.transform(
            F.sequence(F.lit(0), ((F.size(d) - 1) / _BLOCK).cast("int")),
            lambda j: _sum(F.slice(F.col(d), j * _BLOCK + 1, F.lit(_BLOCK)))))
            .otherwise(F.array().cast("array<int>")))
        # size(b) keeps the optimizer from moving b's expression into the lambda.
        df = df.withColumn(s, F.when(F.size(b) > 0, F.transform(F.col(m), lambda x, i: F.struct(
            x.alias("m"), _prefix(F.col(d), F.col(b), i).alias("start"))))
            .otherwise(F.array().cast("array<struct<m:string,start:int>>")))
        ok = F.filter(s, lambda x: k.valid(x["m"])) if k.valid else F.col(s)
        near = lambda x: F.lower(F.substring(
            t, F.greatest(x["start"] - CONTEXT_CHARS, F.lit(0)) + 1,
            F.least(x["start"], F.lit(CONTEXT_CHARS)))).rlike(k.context)
        scored = F.transform(ok, lambda x: F.struct(
            F.lit(k.name).alias("kind"), x["start"].alias("start"),
            (x["start"] + F.length(x["m"])).alias("end"),
            F.when(near(x), F.least(F.lit(k.prior + CONTEXT_BONUS), F.lit(1.0)))
            .otherwise(F.lit(k.prior)).cast("double").alias("score")))
        df = df.withColumn(f"__{k.name}", F.filter(scored, lambda x: x["score"] >= THRESHOLD))
        found.append(f"__{k.name}")
    return df.select(*keep, F.concat(*found).cast(_SPAN).alias(out))


def joined(column: Column) -> Column:
    return F.array_join(F.transform(column, lambda x: F.concat_ws(
        ":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")


def redact(df: DataFrame, text: str = "text") -> DataFrame:
    """``df`` with each span of ``text`` replaced by its kind in brackets; overlapping spans as one.

    Other columns are left alone; null stays null."""
    keep = df.columns
    rows = spans(df, text, "__spans").withColumn("__s", F.expr(
        "array_sort(transform(__spans, x -> struct(x.start AS a, x.end AS e, x.kind AS k)))"))
    # Largest end before each span, by blocks as for the sums.
    top = f"coalesce(array_max(transform(slice(__s, j * {_BLOCK} + 1, {_BLOCK}), x -> x.e)), 0)"
    rows = rows.withColumn("__tops", F.expr(
        f"CASE WHEN size(__s) = 0 THEN array() ELSE transform("
        f"sequence(0, CAST((size(__s) - 1) / {_BLOCK} AS INT)), j -> {top}) END"))
    rows = rows.withColumn("__before", F.expr(
        f"CASE WHEN size(__tops) = 0 THEN array() ELSE transform(__s, (x, i) -> greatest("
        f"coalesce(array_max(slice(__tops, 1, CAST(i / {_BLOCK} AS INT))), 0), "
        f"coalesce(array_max(transform(slice(__s, CAST(i / {_BLOCK} AS INT) * {_BLOCK} + 1, "
        f"i - CAST(i / {_BLOCK} AS INT) * {_BLOCK}), y -> y.e)), 0))) END"))
    text_ = f"CAST(`{text}` AS STRING)"
    masked = F.expr(
        f"CASE WHEN size(__s) = 0 THEN {text_} ELSE concat("
        f"array_join(transform(__s, (x, i) -> CASE WHEN x.a < __before[i] THEN '' ELSE concat("
        f"substring({text_}, __before[i] + 1, x.a - __before[i]), '[', upper(x.k), ']') END), ''), "
        f"substring({text_}, array_max(transform(__s, x -> x.e)) + 1, char_length({text_}))) END")
    return rows.select(*(masked.alias(c) if c == text else F.col(f"`{c}`") for c in keep))


def pii_report(docs: DataFrame) -> DataFrame:
    """Per document of ``docs`` (doc_id, text): counts of the base kinds and all spans."""
    rows = spans(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"))
    base = F.filter("spans", lambda x: x["kind"].isin(*BASE))
    count = lambda k: F.size(F.filter("spans", lambda x: x["kind"] == k)).cast("long")
    return rows.select(
        "doc_id", *(count(k).alias(f"n_{k}") for k in BASE),
        F.sha2(joined(base), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"),
        F.transform("spans", lambda x: x["score"]).alias("scores"))
