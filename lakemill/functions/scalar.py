"""Scalar column functions: cleaning, lenient casts, numbers, dates, codes.

Every string-to-value conversion is lenient (``try_*``): bad input gives NULL or the
stated default, never an error.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

# Input formats the loaders must accept.
YEAR_SUFFIX = r"\s*năm\s+\d{4}.*$"
DAY_MONTH_YEAR = r"^\d{1,2}-\d{1,2}-\d{4}$"
MONTH_WORD_DATE = r"(?:^|\D)(\d{1,2})\s+Tháng\s+(\d{1,2}),\s+(\d{4})"
DAY_MONTH = r"(\d+)\s+Tháng\s+(\d+)"
YEAR_AFTER_COMMA = r",\s*(\d{4})"
CLOCK = r"lúc\s+(\d{1,2}:\d{2})"
PATH_YEAR = r"/(\d{4})/"
COMMENT_DATE = r"(\d{1,2})[-/](\d{1,2})[-/](\d{4})"
UNSIGNED_NUMBER = r"(\d+(?:\.\d+)?)"
RELATIVE_WORD = "trước"
DEFAULT_YEAR = "2025"
DEFAULT_CLOCK = "00:00"

# The white space that Python's ``strip`` and ``split`` know.
SPACE = "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680" + "".join(map(chr, range(0x2000, 0x200B))) + "\u2028\u2029\u202f\u205f\u3000"
SPACES = r"(?U)[\s\x1c-\x1f]+"

NUMBER = r"^[+-]?(\d+(\.\d*)?|\.\d+)([eE][+-]?\d+)?$"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def let(value: Column, body) -> Column:
    """Evaluate ``value`` once per row and hand it to ``body``.

    An expression used inside a lambda would otherwise be evaluated again for each
    array element.
    """
    return F.element_at(F.transform(F.array(value), body), 1)


def strip_space(c: Column | str) -> Column:
    """Strip any Unicode white space at both ends (``trim`` alone strips only U+0020)."""
    return F.btrim(_col(c), F.lit(SPACE))


def squeeze(c: Column | str) -> Column:
    """Each run of white space becomes one space."""
    return F.regexp_replace(_col(c), SPACES, " ")


def words(c: Column | str) -> Column:
    """Split on runs of white space; blank text gives an empty array."""
    parts = F.split(strip_space(c), SPACES)
    return let(parts, lambda p: F.when((F.size(p) == 1) & (p[0] == ""), F.slice(p, 1, 0)).otherwise(p))


def strip_year_suffix(c: Column | str) -> Column:
    """Drop a trailing ``năm YYYY …`` qualifier."""
    return F.trim(F.regexp_replace(_col(c), YEAR_SUFFIX, ""))


def strip_dot_zero(c: Column | str) -> Column:
    """Drop the ``.0`` left on ids that were read as floats."""
    return F.regexp_replace(F.trim(_col(c)), r"\.0$", "")


def first_number(c: Column | str) -> Column:
    """First unsigned number inside a text, as double; NULL if there is none."""
    return F.regexp_extract(_col(c), UNSIGNED_NUMBER, 1).try_cast("double")


def int_or(c: Column | str, default: int = 0) -> Column:
    """Whole number as BIGINT; the default where the text is none. Tables narrow it to their own type."""
    return F.coalesce(_col(c).try_cast("bigint"), F.lit(default).cast("bigint"))


def magnitude(c: Column | str) -> Column:
    """``1.2K`` → 1200, ``3000M`` → 3000000000, ``15`` → 15, anything else → 0, as BIGINT.

    The factor is applied in DECIMAL, so ``8.7K`` is 8700 and not 8699.
    """
    c = _col(c)

    def scaled(suffix: str, factor: int) -> Column:
        number = F.replace(c, F.lit(suffix), F.lit("")).try_cast("decimal(28,6)")
        return F.coalesce((number * F.lit(factor)).try_cast("bigint"), F.lit(0).cast("bigint"))

    return (
        F.when(c.contains("K"), scaled("K", 1_000))
        .when(c.contains("M"), scaled("M", 1_000_000))
        .otherwise(int_or(c))
    )


def parse_date(c: Column | str, default: Column | None = None) -> Column:
    """First format that fits: ``dd-MM-yyyy``, ``d-M-yyyy``, ``15 Tháng 3, 2024``.

    Unparsed text gives ``default`` (NULL unless stated).
    """
    c = _col(c)
    worded = F.concat_ws("-", *(F.regexp_extract(c, MONTH_WORD_DATE, i) for i in (1, 2, 3)))
    # Only text of the right form is parsed: a parse that fails is slow.
    text = F.when(c.rlike(DAY_MONTH_YEAR), c).when(c.rlike(MONTH_WORD_DATE), worded)
    parsed = F.try_to_timestamp(text, F.lit("d-M-yyyy"))
    return parsed if default is None else F.coalesce(parsed, default)


def parse_comment_time(c: Column | str, default: Column | None = None) -> Column:
    """``15-3-2024 …`` or ``15/3/2024 …``; relative text (``2 ngày trước``) gives 1970-01-01."""
    c = _col(c)
    parts = F.concat_ws("-", *(F.regexp_extract(c, COMMENT_DATE, i) for i in (1, 2, 3)))
    tries = [
        F.try_to_timestamp(F.when(c.rlike(COMMENT_DATE), parts), F.lit("d-M-yyyy")),
        F.when(c.contains(RELATIVE_WORD), F.lit("1970-01-01").cast("timestamp")),
    ]
    return F.coalesce(*tries, *([default] if default is not None else []))


def parse_long_date(c: Column | str) -> Column:
    """``Thứ Hai, 15 Tháng 3, 2024 lúc 10:30``; a missing year or clock gets its default."""
    c = _col(c)

    def or_default(value: Column, default: str) -> Column:
        return F.when(value == "", F.lit(default)).otherwise(value)

    day = F.regexp_extract(c, DAY_MONTH, 1)
    month = F.regexp_extract(c, DAY_MONTH, 2)
    year = or_default(F.regexp_extract(c, YEAR_AFTER_COMMA, 1), DEFAULT_YEAR)
    clock = or_default(F.regexp_extract(c, CLOCK, 1), DEFAULT_CLOCK)
    text = F.concat(year, F.lit("-"), month, F.lit("-"), day, F.lit(" "), clock)
    return F.when(day != "", F.try_to_timestamp(text, F.lit("yyyy-M-d H:mm")))


def path_year(c: Column | str) -> Column:
    """Year folder inside a path, as int; NULL if there is none."""
    return F.regexp_extract(_col(c), PATH_YEAR, 1).try_cast("int")


def yes_level(c: Column | str) -> Column:
    """``Yes`` → 2, everything else → 1."""
    return F.when(_col(c) == "Yes", F.lit(2)).otherwise(F.lit(1))


def code_prefix(c: Column | str, length: int = 2) -> Column:
    return F.substring(_col(c), 1, length)


def pad_code(c: Column | str, width: int = 2) -> Column:
    return F.lpad(_col(c).cast("string"), width, "0")


def null_if_sentinel(c: Column | str, sentinels=("nan", "none")) -> Column:
    """NULL for textual nulls, compared without case."""
    c = _col(c)
    return F.when(~F.lower(c).isin(*sentinels), c)


MILLION = 1_000_000


def floor_bin(value: Column | str, width: str) -> Column:
    """Lower edge of the bin a value falls in; ``width`` is a decimal written as text.

    Worked out in decimals: in binary floats ``floor(0.6 / 0.2) * 0.2`` is 0.4, here it is
    0.6. Values keep ten decimals; beyond 10²⁷ there is no bin (NULL).

    Values below 10⁵ that have at most six decimals go through whole millionths, which
    gives the same bin and stays in long arithmetic: a double tells all such
    values apart, so one that equals its millionths is that number.
    """
    exact = _col(value).try_cast("decimal(37,10)")
    step = F.lit(Decimal(width)).cast("decimal(37,10)")
    wide = (exact - F.pmod(exact, step)).cast("double")
    step_millionths = Decimal(width) * MILLION
    if step_millionths != int(step_millionths):
        return wide
    plain = _col(value).try_cast("double")
    millionths = F.rint(plain * MILLION)
    narrow = millionths.cast("bigint") - F.pmod(millionths.cast("bigint"), F.lit(int(step_millionths)))
    return F.when((F.abs(plain) < 100_000) & (millionths / MILLION == plain), narrow / F.lit(float(MILLION))).otherwise(wide)
