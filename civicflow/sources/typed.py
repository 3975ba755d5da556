"""Type-true reading of entries from VARIANT (NRM-1, SRC-7).

``from_json`` with a schema turns a value of the wrong type into NULL and
tells nobody.  A page with such a value is read again here, as VARIANT, with the
rules of the register's store: a quoted whole number or a number with a
zero fraction loads into a whole-number column, a boolean word into a boolean
one, any scalar into a text column; an object or list where a text is
expected is NULL; everything else is a *fault*, which rejects the entry and
names the path and the raw value.

Both the value and the faults of an entry are one SQL expression each, made
from the entry's schema: structs by path, lists by ``transform``.  They run in
the JVM, and only for pages the typed reader has complained about.
"""

from __future__ import annotations

from functools import lru_cache

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

FAULT = "array<struct<path: string, raw: string>>"

#: Texts whose JSON shape varies keep an object or list as its text (fixed names of the API).
VARYING = {"emails", "websites", "phoneNumber", "memberships"}

#: Words that a boolean column takes (fixed values of the store).
TRUE_WORDS = ("true", "t", "yes", "y", "on", "1")
FALSE_WORDS = ("false", "f", "no", "n", "off", "0")


def _list(words) -> str:
    return ", ".join(f"'{w}'" for w in words)


def _at(root: str, path: str, kind: str) -> str:
    return f"try_variant_get({root}, '${path}', '{kind}')"


def _kind(root: str, path: str) -> str:
    return f"schema_of_variant({_at(root, path, 'variant')})"


def _step(path: str, name: str) -> str:
    return f'{path}["{name}"]'


def _long(root: str, path: str, kind: str) -> str:
    text = f"trim({_at(root, path, 'string')})"
    return (f"CASE WHEN {_kind(root, path)} = 'BIGINT' THEN {_at(root, path, kind)} "
            f"WHEN {_kind(root, path)} = 'STRING' THEN CASE WHEN {text} RLIKE '^[+-]?[0-9]+$' THEN try_cast({text} AS {kind}) END "
            f"WHEN {_kind(root, path)} IN ('VOID', 'BOOLEAN') OR {_kind(root, path)} RLIKE '^(OBJECT|ARRAY)' THEN NULL "
            # Fractions round to the even neighbour, as the store rounds doubles.
            f"ELSE try_cast(bround({_at(root, path, 'double')}) AS {kind}) END")


def _boolean(root: str, path: str) -> str:
    word = f"lower(trim({_at(root, path, 'string')}))"
    return (f"CASE WHEN {_kind(root, path)} = 'BOOLEAN' THEN {_at(root, path, 'boolean')} "
            f"WHEN {_kind(root, path)} = 'STRING' AND {word} IN ({_list(TRUE_WORDS)}) THEN true "
            f"WHEN {_kind(root, path)} = 'STRING' AND {word} IN ({_list(FALSE_WORDS)}) THEN false END")


def _decimal(root: str, path: str, kind: str) -> str:
    return (f"CASE WHEN {_kind(root, path)} IN ('VOID', 'BOOLEAN') OR {_kind(root, path)} RLIKE '^(OBJECT|ARRAY)' THEN NULL "
            f"ELSE try_cast(trim({_at(root, path, 'string')}) AS {kind}) END")


def _leaf(root: str, path: str, name: str, dt: T.DataType) -> str:
    if isinstance(dt, T.StringType):
        whole = f"to_json({_at(root, path, 'variant')})" if name in VARYING else "CAST(NULL AS STRING)"
        return (f"CASE WHEN {_kind(root, path)} RLIKE '^(OBJECT|ARRAY)' THEN {whole} "
                f"ELSE {_at(root, path, 'string')} END")
    if isinstance(dt, T.BooleanType):
        return _boolean(root, path)
    if isinstance(dt, T.DecimalType):
        return _decimal(root, path, dt.simpleString())
    return _long(root, path, dt.simpleString())


def _value(root: str, path: str, name: str, dt: T.DataType, depth: int = 0) -> str:
    if isinstance(dt, T.StructType):
        fields = ", ".join(f"'{f.name}', {_value(root, _step(path, f.name), f.name, f.dataType, depth)}"
                           for f in dt.fields)
        return f"CASE WHEN {_kind(root, path)} LIKE 'OBJECT%' THEN named_struct({fields}) END"
    if isinstance(dt, T.ArrayType):
        x = f"x{depth}"
        item = _value(x, "", name, dt.elementType, depth + 1)
        return f"transform({_at(root, path, 'array<variant>')}, {x} -> {item})"
    return _leaf(root, path, name, dt)


def _faults(root: str, path: str, label: str, dt: T.DataType, depth: int = 0) -> list[str]:
    """Expressions of fault lists below a path; texts have none."""
    if isinstance(dt, T.StringType):
        return []
    if isinstance(dt, T.StructType):
        return [x for f in dt.fields for x in
                _faults(root, _step(path, f.name), f"{label}.{f.name}" if label else f.name, f.dataType, depth)]
    if isinstance(dt, T.ArrayType):
        x = f"x{depth}"
        inner = _faults(x, "", f"{label}[]", dt.elementType, depth + 1)
        if not inner:
            return []
        each = f"transform({_at(root, path, 'array<variant>')}, {x} -> concat({', '.join(inner)}))"
        return [f"coalesce(flatten({each}), CAST(array() AS {FAULT}))"]
    bad = f"{_kind(root, path)} <> 'VOID' AND ({_leaf(root, path, label, dt)}) IS NULL"
    return [f"CASE WHEN {bad} THEN array(named_struct('path', '{label}', 'raw', "
            f"to_json({_at(root, path, 'variant')}))) ELSE CAST(array() AS {FAULT}) END"]


@lru_cache(maxsize=None)
def value_sql(ddl: str, root: str) -> str:
    return _value(root, "", "", T.StructType.fromDDL(ddl))


@lru_cache(maxsize=None)
def faults_sql(ddl: str, root: str) -> str:
    parts = _faults(root, "", "", T.StructType.fromDDL(ddl))
    return f"concat({', '.join(parts)})" if parts else f"CAST(array() AS {FAULT})"


def typed(ddl: str, root: str = "v") -> Column:
    """The struct of schema ``ddl`` read from the VARIANT column ``root``."""
    return F.expr(value_sql(ddl, root))


def faults(ddl: str, root: str = "v") -> Column:
    """(path, raw) of every value in ``root`` that does not fit its type in ``ddl``."""
    return F.expr(faults_sql(ddl, root))
