"""Tags: the map that each feature carries, and typed columns promoted from it."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def tag_map(properties: Column | str) -> Column:
    """JSON object text as map<string,string>; nested values stay JSON text, a repeated key's last value wins."""
    return F.from_json(properties, "map<string,string>")


def _joined_digits(value: Column) -> Column:
    """Without underscores between two digits."""
    return F.regexp_replace(value, "(?<=[0-9])_(?=[0-9])", "")


def to_int(value: Column) -> Column:
    """A 32-bit integer from a tag's text or null: decimals round half away from zero, 0x numbers are hexadecimal."""
    bare, lead = F.trim(value), F.ltrim(value)  # a hexadecimal may have blanks before it only
    hexadecimal = F.conv(F.substring(lead, 3, 64), 16, 10).try_cast("bigint").try_cast("int")
    number = F.round(_joined_digits(value).try_cast("decimal(38,18)")).try_cast("int")
    return F.when(lead.rlike("^0[xX]0*[0-9a-fA-F]{1,8}$"), hexadecimal).when(bare.rlike("[fFdD]$"), F.lit(None).cast("int")).otherwise(number)


def to_double(value: Column) -> Column:
    """A double from a tag's text or null; no type suffix is understood."""
    suffixed = F.trim(value).rlike("^[+-]?[0-9.].*[fFdD]$")
    return F.when(suffixed, F.lit(None).cast("double")).otherwise(_joined_digits(value).try_cast("double"))


def tag(tags: Column | str, key: str, kind: str = "string") -> Column:
    """The value at key: a missing key gives null. kind: string, int or double."""
    value = (F.col(tags) if isinstance(tags, str) else tags)[key]
    return {"string": lambda: value, "int": lambda: to_int(value), "double": lambda: to_double(value)}[kind]()
