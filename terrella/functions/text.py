"""Text of listings and requests: sizes, escapes, addresses, byte ranges, paths and times."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Bytes of the units that a size may carry. Others count 1.
UNITS = {
    "B": 1,
    "KiB": 1024,
    "MiB": 1024**2,
    "GiB": 1024**3,
    "TiB": 1024**4,
    "PiB": 1024**5,
    "kB": 10**3,
    "KB": 10**3,
    "MB": 10**6,
    "GB": 10**9,
    "TB": 10**12,
    "PB": 10**15,
}

#: How a size, a progress and a byte range are written.
SIZE = r"([\d.]+)\s*([KMGTP]?i?B)\b"
PROGRESS = r"([\d.]+\s*[KMGTP]?i?B)\s*/\s*([\d.]+\s*[KMGTP]?i?B)"
RANGE = r"^bytes=(\d*)-(\d*)$"


def parse_size(text: Column) -> Column:
    """Bytes that a text such as 1.5 GiB states, cut to whole ones; 0 if it states none."""
    number = F.regexp_extract(text, SIZE, 1).try_cast("double")
    unit = F.coalesce(F.try_element_at(F.create_map(*[F.lit(x) for kv in UNITS.items() for x in kv]), F.regexp_extract(text, SIZE, 2)), F.lit(1))
    return F.coalesce((number * unit).try_cast("bigint"), F.lit(0).cast("bigint"))


def parse_progress(text: Column) -> Column:
    """(done, total) in bytes from a text such as 3 MiB / 1 GiB; null if there is none."""
    parts = F.struct(parse_size(F.regexp_extract(text, PROGRESS, 1)).alias("done"), parse_size(F.regexp_extract(text, PROGRESS, 2)).alias("total"))
    return F.when(text.rlike(PROGRESS), parts)


def format_bytes(size: Column) -> Column:
    """Whole bytes, then one decimal for KiB and MiB, two from GiB on."""

    def scaled(power: int, digits: int, unit: str) -> Column:
        return F.format_string(f"%.{digits}f {unit}", F.round(size / float(1024**power), digits))

    return F.when(size < 1024, F.concat(size.cast("string"), F.lit(" B"))).when(size < 1024**2, scaled(1, 1, "KiB")).when(size < 1024**3, scaled(2, 1, "MiB")).otherwise(scaled(3, 2, "GiB"))


def _escape(text: Column, apostrophe: str) -> Column:
    # The ampersand first, as the others bring new ones.
    marks = (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("'", apostrophe))
    return reduce(lambda t, m: F.replace(t, F.lit(m[0]), F.lit(m[1])), marks, text)


def escape_xml(text: Column) -> Column:
    return _escape(text, "&apos;")


def escape_html(text: Column) -> Column:
    return _escape(text, "&#39;")


def encode_component(text: Column) -> Column:
    """Percent-encoding of an address component: a space is %20, and !~'()* stand for themselves."""
    kept = (("+", "%20"), ("%21", "!"), ("%7E", "~"), ("%27", "'"), ("%28", "("), ("%29", ")"))
    return reduce(lambda t, m: F.replace(t, F.lit(m[0]), F.lit(m[1])), kept, F.url_encode(text))


def decode_component(text: Column) -> Column:
    """The reverse: a plus sign is itself."""
    return F.url_decode(F.replace(text, F.lit("+"), F.lit("%2B")))


def parse_range(header: Column) -> Column:
    """(first, last) of bytes=a-b; with first null, last counts from the end. Null: no range, as for bytes=- too."""
    bare = F.trim(header)
    first, last = (F.regexp_extract(bare, RANGE, k).try_cast("bigint") for k in (1, 2))
    return F.when(bare.rlike(RANGE) & (first.isNotNull() | last.isNotNull()), F.struct(first.alias("first"), last.alias("last")))


def range_bounds(parsed: Column, size: Column) -> Column:
    """(offset, length) of a parsed range in an object. An end before the start gives a length below 1: unsatisfiable."""
    first, last = parsed["first"], parsed["last"]
    tail = F.least(last, size)
    offset = F.when(first.isNull(), size - tail).otherwise(first)
    length = F.when(first.isNull(), tail).when(last.isNull(), size - first).otherwise(last - first + 1)
    return F.when(parsed.isNotNull(), F.struct(offset.alias("offset"), length.alias("length")))


def iso_prefix(region: Column) -> Column:
    """The country of a region code; a code without a hyphen is its own country."""
    return F.split_part(region, F.lit("-"), F.lit(1))


def path_of(region: Column, theme: Column, root: str = "") -> Column:
    return F.concat(F.lit(root), F.lit("country="), iso_prefix(region), F.lit("/state="), region, F.lit("/"), theme, F.lit(".parquet"))


def region_of_dir(name: Column) -> Column:
    return F.replace(name, F.lit("state="), F.lit(""))


def parts_of(path: Column) -> Column:
    """The names on a path, without empty ones."""
    return F.filter(F.split(path, "/"), lambda x: x != "")


def parent_of(path: Column) -> Column:
    """The folder above, with its slash; the top has the empty name."""
    up = parts_of(path)
    return F.when(F.size(up) <= 1, F.lit("")).otherwise(F.concat(F.array_join(F.slice(up, 1, F.size(up) - 1), "/"), F.lit("/")))


def listed_time(at: Column) -> Column:
    return F.date_format(at, "yyyy-MM-dd HH:mm:ss'Z'")


def tenths(seconds: Column) -> Column:
    """Rounded to one decimal, halves to the even digit."""
    return F.bround(seconds, 1)


#: A snapshot's name.
DATED = r"^\d{4}-\d{2}-\d{2}$"


def is_dated(name: Column) -> Column:
    return name.rlike(DATED)
