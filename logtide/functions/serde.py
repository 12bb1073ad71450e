"""Serdes: pairs of column functions, with the combinators that serdes have."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

Codec = Callable[[Column], Column]


@dataclass(frozen=True)
class Serde:
    """serialize: value to binary; deserialize: binary to value. A deserializer gives null for bytes that it can't read."""

    serialize: Codec
    deserialize: Codec

    def inmap(self, to: Codec, back: Codec) -> Serde:
        """A serde of another type, by a function each way."""
        return Serde(lambda v: self.serialize(back(v)), lambda b: to(self.deserialize(b)))

    def contramap(self, back: Codec) -> Codec:
        return lambda v: self.serialize(back(v))

    def map(self, to: Codec) -> Codec:
        return lambda b: to(self.deserialize(b))

    def or_else(self, other: Serde) -> Serde:
        """Read by the other serde what this one can't read."""
        return Serde(self.serialize, lambda b: F.coalesce(self.deserialize(b), other.deserialize(b)))

    def as_try(self) -> Serde:
        """Read into (value, error): the error is null unless bytes that are there can't be read."""

        def read(b: Column) -> Column:
            value = self.deserialize(b)
            return F.struct(value.alias("value"), F.when(b.isNotNull() & value.isNull(), "unreadable").alias("error"))

        return Serde(lambda v: self.serialize(v["value"]), read)


def _utf8(b: Column) -> Column:
    return F.when(F.is_valid_utf8(b.cast("string")), b.cast("string"))


#: Raw bytes.
binary = Serde(lambda v: v.cast("binary"), lambda b: b)
#: UTF-8 text; bytes that aren't UTF-8 can't be read.
string = Serde(lambda v: v.cast("binary"), _utf8)
#: Text written in UTF-8 and read as US-ASCII: each byte beyond 127 becomes U+FFFD.
ascii_string = Serde(lambda v: v.cast("binary"), lambda b: F.regexp_replace(F.decode(b, "ISO-8859-1"), "[\u0080-ÿ]", "�"))
#: Decimal integers as text.
integer = Serde(lambda v: v.cast("string").cast("binary"), lambda b: _utf8(b).try_cast("bigint"))
#: Numbers as text.
number = Serde(lambda v: v.cast("string").cast("binary"), lambda b: _utf8(b).try_cast("double"))


def json_field(path: str) -> Serde:
    """One field of JSON text, read only."""

    def refuse(_: Column) -> Column:
        raise TypeError("a JSON field can't be written")

    return Serde(refuse, lambda b: F.get_json_object(b.cast("string"), path))
