"""Text cleaning and tokenising expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the delimiters of the whitespace tokeniser (space, tab, newline, return, form feed).
WORD_PATTERN = "[^ \\t\\n\\r\\f]+"


def lower_tokens(text: Column) -> Column:
    """Lower-case and split on single spaces; empty tokens stay in place."""
    return F.split(F.lower(text), " ", -1)


def words(text: Column) -> Column:
    """Maximal runs of non-whitespace characters; never yields an empty word."""
    return F.regexp_extract_all(text, F.lit(WORD_PATTERN), F.lit(0))


# All characters that count as white space, Unicode's and the information separators included.
WHITE_SPACE = "".join(c for c in map(chr, range(0x3001)) if c.isspace())


def strip(text: Column) -> Column:
    """Remove white space of any kind from both ends (``trim`` only removes spaces)."""
    return F.btrim(text, F.lit(WHITE_SPACE))


def first_letter(word: Column) -> Column:
    """Lower-cased first code point."""
    return F.lower(F.substring(word, 1, 1))


def lines_of(text: Column) -> Column:
    """Lines of a text, empty ones included."""
    return F.split(text, "\n", -1)
