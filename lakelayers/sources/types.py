"""Common types of tables whose columns differ from day to day."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_WHOLE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
_DIGITS = dict(zip(_WHOLE, (3, 5, 10, 19), strict=True))
_REAL = (T.FloatType, T.DoubleType)
_TIMES = (T.TimestampType, T.TimestampNTZType)
MOST_DIGITS = 38


def join_types(one: T.DataType, other: T.DataType) -> T.DataType:
    """The narrowest type that takes both: whole < decimal < double < string, date < timestamp < string.

    Decimals that no decimal takes are joined to string, so that no digit is lost; a null type joins to the other
    one, all other pairs of different types to string.
    """
    if one == other or isinstance(other, T.NullType):
        return one
    if isinstance(one, T.NullType):
        return other
    kinds = {type(one), type(other)}
    if kinds <= {*_WHOLE}:
        return max(one, other, key=lambda kind: _DIGITS[type(kind)])
    if kinds <= {*_WHOLE, T.DecimalType}:
        digits = [_digits(one), _digits(other)]
        whole, after = (max(part) for part in zip(*digits, strict=True))
        return T.DecimalType(whole + after, after) if whole + after <= MOST_DIGITS else T.StringType()
    if kinds <= {*_WHOLE, *_REAL, T.DecimalType}:
        return T.DoubleType()
    if kinds <= {T.DateType, *_TIMES}:
        times = [kind for kind in (one, other) if not isinstance(kind, T.DateType)]
        return times[0] if len(times) == 1 else T.TimestampType()
    return T.StringType()


def _digits(kind: T.DataType) -> tuple[int, int]:
    """Digits before and after the point."""
    if isinstance(kind, T.DecimalType):
        return kind.precision - kind.scale, kind.scale
    return _DIGITS[type(kind)], 0


def join_schemas(schemas: Iterable[T.StructType]) -> T.StructType:
    """All columns in the order in which they first appear, names compared without case, each with the join of its types."""
    names: dict[str, str] = {}
    kinds: dict[str, list[T.DataType]] = {}
    for schema in schemas:
        for column in schema:
            names.setdefault(column.name.lower(), column.name)
            kinds.setdefault(column.name.lower(), []).append(column.dataType)
    return T.StructType([T.StructField(names[key], reduce(join_types, found)) for key, found in kinds.items()])


def cast_to(df: DataFrame, schema: T.StructType) -> DataFrame:
    """``df`` with the columns of ``schema``; a column it lacks is null."""
    present = {column.name.lower(): column for column in df.schema}

    def column(wanted: T.StructField):
        found = present.get(wanted.name.lower())
        if found is None:
            return F.lit(None).cast(wanted.dataType).alias(wanted.name)
        value = F.col(f"`{found.name}`")
        return (value if found.dataType == wanted.dataType else value.cast(wanted.dataType)).alias(wanted.name)

    return df.select(*[column(wanted) for wanted in schema])
