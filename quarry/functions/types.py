"""Column types with their own storage.

A :class:`~pyspark.sql.types.UserDefinedType` names its storage type; Spark writes that to Parquet with the type's name beside it, and reads the column back as
the type. :func:`typed` makes such a column in Arrow batches; vectorised functions (``pandas_udf``) see the stored values, Arrow functions (``udf``) the objects.
"""

from __future__ import annotations

import datetime as dt
import json

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

_EPOCH = dt.datetime(1970, 1, 1)
_MILLI = dt.timedelta(milliseconds=1)


class InstantType(T.UserDefinedType):
    """A ``datetime`` without zone, stored as milliseconds since 1970 (a long, floored); microseconds are given up."""

    @classmethod
    def sqlType(cls):
        return T.LongType()

    @classmethod
    def module(cls):
        return "quarry.functions.types"

    def serialize(self, obj):
        return None if obj is None else (obj - _EPOCH) // _MILLI

    def deserialize(self, datum):
        return None if datum is None else _EPOCH + datum * _MILLI


class Opaque:
    """Any value that JSON can hold, as one object that Spark does not look into."""

    def __init__(self, value):
        self.value = value

    def __eq__(self, other):
        return isinstance(other, Opaque) and self.value == other.value

    def __hash__(self):
        return hash(json.dumps(self.value, sort_keys=True))

    def __repr__(self):
        return f"Opaque({self.value!r})"


class OpaqueType(T.UserDefinedType):
    """An :class:`Opaque` object, stored as the UTF-8 bytes of its JSON with sorted keys."""

    @classmethod
    def sqlType(cls):
        return T.BinaryType()

    @classmethod
    def module(cls):
        return "quarry.functions.types"

    def serialize(self, obj):
        return None if obj is None else json.dumps(obj.value, sort_keys=True, ensure_ascii=False, separators=(",", ":")).encode()

    def deserialize(self, datum):
        return None if datum is None else Opaque(json.loads(bytes(datum)))


Opaque.__UDT__ = OpaqueType()


def instant(ts: Column | str) -> Column:
    """A TIMESTAMP_NTZ as :class:`InstantType`."""
    return F.udf(lambda t: t, InstantType(), useArrow=True)(ts)


def opaque(*columns: str) -> Column:
    """An object of the named columns as :class:`OpaqueType`."""
    return F.udf(lambda *values: Opaque(dict(zip(columns, values, strict=True))), OpaqueType(), useArrow=True)(*columns)


def stored_millis(column: Column | str) -> Column:
    """What an :class:`InstantType` column stores, without making the objects."""
    @F.pandas_udf(T.LongType())
    def stored(x: pd.Series) -> pd.Series:
        return x
    return stored(column)


def restored_field(column: Column | str, name: str, data_type: T.DataType | str) -> Column:
    """A field of the object in an :class:`OpaqueType` column (null where the object or the field is missing)."""
    return F.udf(lambda o: None if o is None else o.value.get(name), data_type, useArrow=True)(column)
