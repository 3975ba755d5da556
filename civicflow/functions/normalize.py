"""Normalization functions (NRM-*) as Spark column expressions.

All of them are built-in expressions — no Python UDF — so they run inside
whole-stage codegen next to the flattening projections.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from civicflow.functions.dates import lenient_day, lenient_timestamp

YEAR_MONTH = r"^\d{4}-\d{2}$"

#: ISO spellings, read as they are; all others go through the grammar of ``dates``.
ISO = r"^\d{4}-\d{2}-\d{2}($|[T ])"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def blank_to_null(c) -> Column:
    c = _c(c)
    return F.when(F.trim(c) != "", c)


def ts(c) -> Column:
    """NRM-2: lenient timestamp; blank → NULL.  See ``ts_invalid``."""
    s = blank_to_null(c)
    return F.coalesce(F.when(s.rlike(ISO), s.try_cast(T.TimestampType())), lenient_timestamp(s))


def ts_invalid(c) -> Column:
    """True when a non-blank value cannot be read as a timestamp (the
    reference passes it on and the database rejects the entry)."""
    return blank_to_null(c).isNotNull() & ts(c).isNull()


def day(c) -> Column:
    """NRM-3: date part.  The leading ``yyyy-MM-dd`` of the text is used as
    is, so a zone offset never shifts the day; then other spellings."""
    s = blank_to_null(c)
    return F.coalesce(F.when(s.rlike(ISO), F.substring(s, 1, 10).try_cast(T.DateType())), lenient_day(s))


def day_invalid(c) -> Column:
    return blank_to_null(c).isNotNull() & day(c).isNull()


def year_month(c) -> Column:
    """NRM-4: trimmed ``YYYY-MM`` kept; other parseable dates reformatted;
    anything else NULL."""
    s = F.trim(_c(c).cast("string"))
    return (F.when(s.rlike(YEAR_MONTH), s)
            .when(s != "", F.date_format(day(s), "yyyy-MM")))


def simple_list(raw, key: str) -> Column:
    """NRM-5: a JSON list of strings or ``{key: v}`` objects, or one bare
    value → array<struct<ordinal, value>>.  Blank values are skipped but
    still consume an ordinal."""
    raw = F.trim(_c(raw))
    as_list = F.from_json(raw, T.ArrayType(T.StringType()))
    items = F.when(raw.startswith("["), as_list).when(raw.isNotNull() & (raw != ""),
                                                     F.array(raw))

    def value(x: Column) -> Column:
        return F.when(F.trim(x).startswith("{"), F.get_json_object(x, f"$.{key}")).otherwise(x)

    numbered = F.transform(items, lambda x, i: F.struct((i + 1).alias("ordinal"),
                                                       value(x).alias("value")))
    return F.filter(numbered, lambda s: s["value"].isNotNull() & (s["value"] != ""))


def truthy_str(c) -> Column:
    """Python truthiness of an optional string: not NULL and not empty."""
    c = _c(c)
    return c.isNotNull() & (c != "")


def label_key(obj) -> Column:
    """NRM-6 key: code, else de, else en, else 'UNKNOWN'; NULL when the label
    is absent or has neither a code nor a non-empty text."""
    obj = _c(obj)
    code, de, en = obj["code"], obj["de"], obj["en"]
    skip = obj.isNull() | (code.isNull() & ~truthy_str(de) & ~truthy_str(en))
    key = F.coalesce(F.when(truthy_str(code), code), F.when(truthy_str(de), de),
                     F.when(truthy_str(en), en), F.lit("UNKNOWN"))
    return F.when(~skip, key)


def label_id(domain: str, obj) -> Column:
    """Deterministic id of a (domain, key) label: equal uses share the id."""
    key = label_key(obj)
    return F.when(key.isNotNull(), F.xxhash64(F.lit(domain), key))


def country_present(obj) -> Column:
    obj = _c(obj)
    return obj.isNotNull() & (truthy_str(obj["code"]) | truthy_str(obj["de"])
                              | truthy_str(obj["en"]))


def country_id(obj) -> Column:
    """NRM-7: id by country code; see ``country_invalid`` for label-only."""
    obj = _c(obj)
    return F.when(country_present(obj) & obj["code"].isNotNull(),
                  F.xxhash64(F.lit("country"), obj["code"]))


def country_invalid(obj) -> Column:
    obj = _c(obj)
    return country_present(obj) & obj["code"].isNull()


def phone(contact) -> Column:
    """NRM-9: ``phoneNumber`` unless empty, else ``phone``."""
    contact = _c(contact)
    return F.when(truthy_str(contact["phoneNumber"]), contact["phoneNumber"]) \
        .otherwise(contact["phone"])


def gate(flag, obj) -> Column:
    """NRM-11: the nested object only when its presence flag is true."""
    return F.when(_c(flag) == F.lit(True), _c(obj))


def any_field(obj, fields: list[str]) -> Column:
    """A JSON object is "truthy" (non-empty) when any field is present."""
    obj = _c(obj)
    cond = obj.isNotNull() & F.lit(False)
    for f in fields:
        cond = cond | obj[f].isNotNull()
    return obj.isNotNull() & cond
