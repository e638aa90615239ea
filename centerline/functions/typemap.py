"""Field types of DBF files as Spark types, and what a field becomes whose type differs between files."""

from __future__ import annotations

import warnings
from collections.abc import Iterable

from pyspark.sql import types as T

# DBF field codes and the SQL types they load as.
DBF_SQL_TYPES = {
    "C": "VARCHAR",
    "N": "DOUBLE",
    "F": "DOUBLE",
    "I": "INTEGER",
    "D": "DATE",
    "L": "BOOLEAN",
}

SPARK_TYPES = {
    "VARCHAR": T.StringType(),
    "DOUBLE": T.DoubleType(),
    "INTEGER": T.IntegerType(),
    "DATE": T.DateType(),
    "BOOLEAN": T.BooleanType(),
}

# Digits a BIGINT always holds.
BIGINT_DIGITS = 18


def dbf_spark_type(
    code: str, width: int = 0, decimals: int = 0, strict: bool = False, dates_as_text: bool = False
) -> T.DataType:
    """Spark type of a DBF field.

    A numeric field without decimals keeps whole numbers exact, as BIGINT or, where
    that is too narrow, as DECIMAL; ``strict`` loads every numeric field as DOUBLE.
    """
    if code == "N" and not strict and decimals == 0:
        return T.LongType() if width <= BIGINT_DIGITS else T.DecimalType(min(width, 38), 0)
    if code == "D" and dates_as_text:
        return T.StringType()
    return SPARK_TYPES[DBF_SQL_TYPES.get(code, "VARCHAR")]


def wider_type(a: T.DataType, b: T.DataType) -> T.DataType | None:
    """Type that holds the values of both; None if only text does."""
    if a == b:
        return a
    whole = {T.IntegerType: 10, T.LongType: 19}
    if type(a) in whole and type(b) in whole:
        return T.LongType()
    digits = [t.precision if isinstance(t, T.DecimalType) else whole.get(type(t)) for t in (a, b)]
    if all(digits):
        return T.DecimalType(max(digits), 0)
    numbers = (T.IntegerType, T.LongType, T.DoubleType, T.DecimalType)
    # A fraction next to whole numbers that a double cannot hold stays text.
    if isinstance(a, numbers) and isinstance(b, numbers) and not any(isinstance(t, T.DecimalType) for t in (a, b)):
        return T.DoubleType()
    return None


def merged_schema(found: Iterable[tuple[str, T.DataType]]) -> T.StructType:
    """Fields of several files, by name, in the order they are met.

    A field whose types differ gets the wider one; where only text holds both it
    becomes text, and a warning names it.
    """
    fields: dict[str, T.DataType] = {}
    for name, kind in found:
        known = fields.setdefault(name, kind)
        if known != kind:
            wide = wider_type(known, kind)
            if wide is None:
                if not isinstance(known, T.StringType):
                    warnings.warn(f"column {name} is {known.simpleString()} and {kind.simpleString()}: read as text")
                wide = T.StringType()
            fields[name] = wide
    return T.StructType([T.StructField(n, k) for n, k in fields.items()])
