"""Text normalisers applied to entity names before dictionary matching. Letters are composed first."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from lakemill.functions.canonical import compose
from lakemill.functions.scalar import squeeze, strip_space

# Words peeled off the front of a major's name.
MAJOR_PREFIXES = ["ngành", "nghề", "học", "sv", "chuyên ngành", "chuyên viên"]
MAJOR_ROUNDS = 5

# What is taken out of an organisation's name, in this order.
CLOSING_PUNCTUATION = r"[.,;:)(!?]+$"
BRACKETED = r"\([^)]*\)"
OUTER_BRACKETS = r"^[()]+|[()]+$"
NO_WORD_CHARACTER = r"(?U)[^\w\s\-]"


def normalize_org(c: Column | str) -> Column:
    """Lower case, no closing punctuation, no bracketed text, only word characters and ``-``."""
    c = strip_space(F.lower(compose(c)))
    c = F.regexp_replace(c, CLOSING_PUNCTUATION, "")
    c = F.regexp_replace(c, BRACKETED, "")
    c = F.regexp_replace(c, OUTER_BRACKETS, "")
    c = F.regexp_replace(c, NO_WORD_CHARACTER, " ")
    return F.coalesce(strip_space(squeeze(c)), F.lit(""))


def normalize_maj(c: Column | str) -> Column:
    """Lower case, single spaces, no double quotes, leading study words peeled up to five times."""
    c = squeeze(strip_space(F.lower(compose(c))))
    c = F.coalesce(F.replace(c, F.lit('"'), F.lit("")), F.lit(""))
    heads = "|".join(MAJOR_PREFIXES)
    first = strip_space(F.regexp_replace(c, f"^(?:{heads}) ", ""))
    rest = F.regexp_replace(first, rf"^(?:(?:{heads}) \s*){{1,{MAJOR_ROUNDS - 1}}}", "")
    return F.when(c.rlike(f"^(?:{heads}) "), rest).otherwise(c)
