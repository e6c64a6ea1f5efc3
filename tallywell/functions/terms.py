"""Whole-word term matching where a word ends at anything but a Unicode letter or mark."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# The default word list.
PRONOUNS = ("han", "hon", "hen", "den", "det", "denna", "denne")

# Fixed value: characters that belong to a word. Digits, underscores and apostrophes are boundaries.
WORD_CHARS = r"\p{L}\p{M}"


def any_term_pattern(terms: Sequence[str]) -> str:
    """Java regex for any of ``terms`` as a whole word, capturing the term.

    The closing look-ahead follows the alternation, so a longer term is found
    even when a shorter one listed before it is its prefix. With many terms it
    is cheapest to test for the start of a word first.
    """
    choice = "|".join(re.escape(term) for term in terms)
    return f"(?iu)(?<![{WORD_CHARS}])({choice})(?![{WORD_CHARS}])"


def term_pattern(term: str) -> str:
    """Java regex for one whole word; the literal comes first, as few positions match it."""
    word = re.escape(term)
    return f"{word}(?<![{WORD_CHARS}]{word})(?![{WORD_CHARS}])"


def contains_term(text: Column, term: str) -> Column:
    """Does ``text`` contain ``term`` as a whole word, in any case?"""
    return text.rlike(f"(?iu){term_pattern(term)}")


def lower_contains_term(lower_text: Column, term: str) -> Column:
    """Same on lower-cased text; the plain substring test spares most texts the regex."""
    word = term.lower()
    return lower_text.contains(word) & lower_text.rlike(term_pattern(word))


def distinct_terms(text: Column, terms: Sequence[str]) -> Column:
    """Lower-cased distinct terms found in ``text``."""
    found = F.regexp_extract_all(text, F.lit(any_term_pattern(terms)), F.lit(1))
    return F.array_distinct(F.transform(found, F.lower))
