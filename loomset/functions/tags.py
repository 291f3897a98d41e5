"""Tag strings: normalising, tokenising and wildcard patterns."""

from __future__ import annotations

import re
from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Unicode classes everywhere, so that \b and \s see accented letters and NBSP.
_FLAGS = "(?U)"
_SPECIAL = re.compile(r"([\\.^$|?*+()\[\]{}])")


def normalise(col: Column) -> Column:
    """Lower-case text, null as empty."""
    return F.coalesce(F.lower(col.cast("string")), F.lit(""))


def token_set(col: Column) -> Column:
    """Distinct lower-case tokens between commas and white space."""
    parts = F.split(F.lower(F.coalesce(col.cast("string"), F.lit(""))), _FLAGS + r"[,\s]+")
    return F.array_distinct(F.array_remove(parts, ""))


def sorted_tokens(col: Column) -> Column:
    return F.array_join(F.array_sort(col), " ")


def clean_spaces(col: Column) -> Column:
    """Commas to spaces, runs of white space to one space, ends trimmed."""
    spaced = F.regexp_replace(F.translate(F.coalesce(col, F.lit("")), ",", " "), _FLAGS + r"\s{2,}", " ")
    return F.regexp_replace(spaced, _FLAGS + r"\A\s+|\s+\z", "")


def parse_list(value: str | Iterable[str] | None) -> list[str]:
    """A command-line tag list: commas and white space separate."""
    if value is None:
        return []
    if isinstance(value, str):
        return [t for t in re.split(r"[\s,]+", value) if t]
    return list(value)


def pattern(term: str, dialect: str = "token") -> str:
    """The regular expression of one wildcard term.

    ``*x*`` is a substring, ``x*`` a prefix, ``*x`` a suffix and ``x`` a whole
    word; stars inside are literal and terms are lower-cased. Dialect ``word``
    bounds by word characters (``cat`` is in ``cat-girl``, not in ``cat_ears``),
    ``token`` by white space.
    """
    body = _SPECIAL.sub(r"\\\1", term.strip("*").lower())
    opens = "" if term.startswith("*") else {"word": r"\b", "token": r"(?:^|\s)"}[dialect]
    closes = "" if term.endswith("*") else {"word": r"\b", "token": r"(?:\s|\z)"}[dialect]
    return opens + body + closes if body else ""


def any_of(col: Column, terms: Iterable[str], dialect: str = "token") -> Column:
    """True where any term matches: one alternation, one pass."""
    return col.rlike(_FLAGS + "|".join(f"(?:{pattern(t, dialect)})" for t in terms))


def all_of(col: Column, terms: Iterable[str], dialect: str = "token") -> Column:
    out = F.lit(True)
    for term in terms:
        out = out & any_of(col, [term], dialect)
    return out


def none_of(col: Column, terms: Iterable[str], dialect: str = "token") -> Column:
    terms = list(terms)
    if any(not t.strip("*") for t in terms):
        raise ValueError("an exclude term without text would drop every row")
    return ~any_of(col, terms, dialect)
