"""Text cleaning, vocabularies and labels."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from orderlens.fixed_values import MONTH_NAMES, NO_ISSUE


# fixed values: every character that Unicode counts as whitespace
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006"
    "\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)


def clean_text(c: Column) -> Column:
    """Strip every kind of outer whitespace; an empty result becomes null.

    A text between two visible ASCII characters is clean already, which two comparisons of bytes tell; only others are stripped.
    """
    text = c.cast("string")
    last = F.substring(text, -1, 1)
    clean = (text >= "!") & (text < "\x7f") & (last >= "!") & (last < "\x7f")
    return F.when(clean, text).otherwise(F.nullif(F.btrim(text, F.lit(WHITESPACE)), F.lit("")))


def full_name(first: Column, last: Column) -> Column:
    """Both cleaned parts joined; an empty text when neither is present."""
    return F.trim(F.concat_ws(" ", clean_text(first), clean_text(last)))


def vocabulary(names: Mapping[str, str]) -> Column:
    return F.create_map(*[F.lit(text) for pair in names.items() for text in pair])


def canonical(c: Column, names: Mapping[str, str], keep_case: bool = True) -> Column:
    """Canonical spelling of a known value; an unknown one stays, as it is or in lower case."""
    known = F.try_element_at(vocabulary(names), F.lower(c))
    return F.coalesce(known, c if keep_case else F.lower(c))


def month_name(month: Column) -> Column:
    return F.try_element_at(F.array(*[F.lit(name) for name in MONTH_NAMES]), month)


def joined_labels(conditions: Iterable[tuple[str, Column]], separator: str, empty: str = "") -> Column:
    """Names of the conditions that hold, in order; `empty` when none does."""
    hits = F.array_compact(F.array(*[F.when(test, F.lit(name)) for name, test in conditions]))
    return F.when(F.size(hits) == 0, F.lit(empty)).otherwise(F.array_join(hits, separator))


def issue_text(conditions: Iterable[tuple[str, Column]]) -> Column:
    return joined_labels(conditions, " | ", NO_ISSUE)


def without_numeric_suffix(c: Column) -> Column:
    return F.regexp_replace(c, r" \d+$", "")


def same_text(c: Column, value: str) -> Column:
    """Case-insensitive equality, as in the collection filters."""
    return F.lower(c) == value.lower()
