"""File names and storage paths of imaging experiments."""

from __future__ import annotations

import functools
import sys
import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: <well>_s<site>_x<column>_y<row>[_z<plane>]_<channel>, the stem of the file name.
IMAGE_NAME = r"^([^\n]+)_s(\d+)_x(\d+)_y(\d+)(?:_z(\d+))?_([^\n]+)$"
_BREAK = "/"  # can't occur in a file name

# Media types by lower-case suffix.
MEDIA_TYPES = {
    ".png": "image/png",
    ".jpg": "image/jpeg",
    ".jpeg": "image/jpeg",
    ".gif": "image/gif",
    ".tif": "image/tiff",
    ".tiff": "image/tiff",
    ".csv": "text/csv",
    ".json": "application/json",
    ".html": "text/html",
    ".css": "text/css",
    ".js": "application/javascript",
}
DEFAULT_MEDIA_TYPE = "application/octet-stream"

# Result tables that are merged, those that are left out, and their suffixes.
MERGED_STEMS = ("cytoplasm", "nucleus")
SKIPPED_STEMS = ("Experiment", "Image")
RESULT_SUFFIXES = (".csv", ".parquet")


def literal_map(values: dict[str, str]) -> Column:
    """A constant map column."""
    return F.create_map(*[F.lit(part) for pair in values.items() for part in pair])


def base_name(path: Column) -> Column:
    """Last path segment."""
    return F.substring_index(path, "/", -1)


def suffix(path: Column) -> Column:
    """Last extension with its dot; empty without one, or when the name only starts with a dot."""
    return F.regexp_extract(base_name(path), r"^.+?(\.[^.]+)$", 1)


def stem(path: Column) -> Column:
    """Last path segment without its last extension."""
    name = base_name(path)
    return F.substring(name, F.lit(1), F.length(name) - F.length(suffix(path)))


def bucket_of(path: Column) -> Column:
    """Part before the first slash."""
    return F.substring_index(path, "/", 1)


def key_of(path: Column) -> Column:
    """Everything after the first slash."""
    return F.regexp_extract(path, r"^[^/]*/(.*)$", 1)


def join_path(*parts: Column) -> Column:
    return F.concat_ws("/", *parts)


def media_type(path: Column) -> Column:
    return F.coalesce(
        F.try_element_at(literal_map(MEDIA_TYPES), F.lower(suffix(path))), F.lit(DEFAULT_MEDIA_TYPE)
    )


_PAIR, _ENTRY = "\x01", "\x02"  # can't occur in the table


@functools.cache
def _ascii_parts() -> str:
    """ASCII part of the compatibility decomposition of each character that has one, of all of Unicode, in one text."""
    parts = []
    for code in range(0x80, sys.maxunicode + 1):
        if not 0xD800 <= code < 0xE000:
            plain = unicodedata.normalize("NFKD", chr(code)).encode("ascii", "ignore").decode()
            if plain:
                parts.append(f"{chr(code)}{_PAIR}{plain}")
    return _ENTRY.join(parts)


def to_ascii(text: Column) -> Column:
    """Accented and compatibility characters as their ASCII parts; other characters beyond ASCII are dropped.

    Texts that are ASCII already, nearly all, are only tested. The table is one literal, which Spark makes a map of once.
    """
    table = F.str_to_map(F.lit(_ascii_parts()), F.lit(_ENTRY), F.lit(_PAIR))
    single = F.transform(F.split(text, ""), lambda c: F.when(c < "\x80", c).otherwise(F.coalesce(F.try_element_at(table, c), F.lit(""))))
    return F.when(text.rlike(r"[^\x00-\x7F]"), F.array_join(single, "")).otherwise(text)


def sanitize(name: Column) -> Column:
    """File name safe for storage: no separators, ASCII only, no dots or underscores at the ends."""
    ascii_only = to_ascii(F.replace(name, F.lit("/"), F.lit(" ")))
    joined = F.regexp_replace(F.regexp_replace(ascii_only, r"^\s+|\s+$", ""), r"\s+", "_")
    return F.regexp_replace(F.regexp_replace(joined, r"[^A-Za-z0-9_.-]", ""), r"^[._]+|[._]+$", "")


def image_parts(path: Column) -> Column:
    """The six raw fields of an image name, null for other names: one pattern, and the extension cut without one."""
    name = base_name(path)
    last = F.substring_index(name, ".", -1)
    before = F.length(name) - F.length(last) - 1
    cut = F.when((before > 0) & (last != ""), F.substring(name, F.lit(1), before)).otherwise(name)
    marked = F.regexp_replace(cut, IMAGE_NAME, _BREAK.join(f"${n}" for n in range(1, 7)))
    return F.get(F.filter(F.array(F.split(marked, _BREAK, 6)), lambda parts: F.size(parts) == 6), F.lit(0))


def image_fields(parts: Column) -> list[Column]:
    """Typed columns from the parts of a matching name; the plane defaults to 1."""

    def number(i: int) -> Column:
        # A missing plane is an empty part; a failed try_cast is far dearer than this test.
        return F.nullif(F.get(parts, F.lit(i)), F.lit("")).try_cast("int")

    return [
        F.get(parts, F.lit(0)).alias("well"),
        number(1).alias("site"),
        number(2).alias("site_x"),
        number(3).alias("site_y"),
        F.coalesce(number(4), F.lit(1)).alias("site_z"),
        F.replace(F.get(parts, F.lit(5)), F.lit("_"), F.lit(" ")).alias("channel"),
    ]


def result_name(name: Column) -> Column:
    """Struct (well, site) of a result row named ``<well>_s<site>_...``; site null if not a number."""
    parts = F.split(name, "_", 3)
    return F.struct(
        F.get(parts, F.lit(0)).alias("well"),
        F.substring(F.get(parts, F.lit(1)), F.lit(2), F.length(name)).try_cast("int").alias("site"),
    )


def result_route(name: Column) -> Column:
    """What the merge does with a result table: ``merge``, ``skip`` or ``unexpected``."""
    merged = [stem + suffix for stem in MERGED_STEMS for suffix in RESULT_SUFFIXES]
    skipped = [stem + suffix for stem in SKIPPED_STEMS for suffix in RESULT_SUFFIXES]
    return F.when(name.isin(*merged), "merge").when(name.isin(*skipped), "skip").otherwise("unexpected")


def well_name(index: Column, columns: Column | int) -> Column:
    """Well name of a 0-based index on a plate with ``columns`` wells per row: A01, A02, ..."""
    width = F.lit(columns) if isinstance(columns, int) else columns
    row = F.floor(index / width).cast("int")
    return F.concat(F.char(F.lit(65) + row), F.lpad((index % width + 1).cast("string"), 2, "0"))
