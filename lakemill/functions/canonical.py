"""One spelling for letters that can be written composed or with marks after them."""

from __future__ import annotations

import unicodedata
from functools import cache

from pyspark.sql import Column
from pyspark.sql import functions as F

from lakemill.functions.scalar import _col, let

#: Marks of Vietnamese letters: those that shape a vowel, the dot below, and the other tones.
MARKS = "\u031b\u0323\u0306\u0302\u0300\u0301\u0303\u0309"
_LATIN = [chr(c) for c in (*range(0x41, 0x250), *range(0x1E00, 0x1F00)) if unicodedata.is_normalized("NFC", chr(c))]


@cache
def composed_with(mark: str) -> tuple[str, str]:
    """Latin letters that have a composed form with the mark, and these forms, by Unicode's own rules."""
    pairs = [(letter, unicodedata.normalize("NFC", letter + mark)) for letter in _LATIN]
    whole = [(letter, form) for letter, form in pairs if len(form) == 1]
    return "".join(letter for letter, _ in whole), "".join(form for _, form in whole)


def _composer(mark: str):
    letters, forms = composed_with(mark)

    def joined(parts: Column) -> Column:
        def closed(part: Column, i: Column) -> Column:
            last = F.right(part, F.lit(1))
            fits = (last != "") & (F.instr(F.lit(letters), last) > 0)
            form = F.concat(F.substring(part, F.lit(1), F.length(part) - 1), F.translate(last, letters, forms))
            return F.when(i == F.size(parts) - 1, part).when(fits, form).otherwise(F.concat(part, F.lit(mark)))

        return F.array_join(F.transform(parts, closed), "")

    return lambda text: F.when(text.contains(mark), let(F.split(text, mark, -1), joined)).otherwise(text)


def compose(c: Column | str) -> Column:
    """Text with each Latin letter and the marks of ``MARKS`` after it as one letter, where there is one.

    Equal to NFC where all such marks find a letter that takes them, in any order that is
    canonically equal. Text without these marks is passed through.
    """
    text = _col(c)
    out = text
    # Twice: a letter may have to take its dot or tone before it can take its shape.
    for mark in MARKS * 2:
        out = let(out, _composer(mark))
    return F.when(text.rlike(f"[{MARKS}]"), out).otherwise(text)
