"""String cleaning, recodes and pattern checks."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the e-mail shape the quality suite checks, anchored at both ends.
EMAIL_PATTERN = r"^[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\.[a-zA-Z]{2,}$"

# Accepted spellings of the two named categories.
GENDER_CODES = {"Male": ["M", "MALE"], "Female": ["F", "FEMALE"]}


def full_name(first: str, last: str) -> Column:
    """First, space, last; NULL when either part is NULL."""
    return F.concat(F.col(first), F.lit(" "), F.col(last))


def clean_upper(name: str) -> Column:
    return F.trim(F.upper(F.col(name)))


def clean_lower(name: str) -> Column:
    return F.lower(F.trim(F.col(name)))


def recode(name: str, codes: Mapping[str, Sequence[str]], other: str = "Other") -> Column:
    """Case-insensitive recode; everything else, NULL included, becomes ``other``."""
    value = F.upper(F.col(name))
    out = None
    for label, members in codes.items():
        hit = value.isin(*[m.upper() for m in members])
        out = F.when(hit, label) if out is None else out.when(hit, label)
    return F.lit(other) if out is None else out.otherwise(other)


def plausible_email(name: str) -> Column:
    return F.col(name).isNotNull() & F.col(name).contains("@")


def prefix_in(name: str, prefixes: Sequence[str]) -> Column:
    """1 when the first characters are in the set, else 0 (NULL counts as 0)."""
    width = len(prefixes[0])
    hit = F.substring(F.col(name), 1, width).isin(*prefixes)
    return F.coalesce(hit, F.lit(False)).cast("int")
