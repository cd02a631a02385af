"""Character classes spelled out for Java regex, whose shorthands are ASCII-only."""

from __future__ import annotations

import sys
import unicodedata

# Bodies for use inside [...]. ASCII comes first as plain ranges, which Java tests
# with one bit lookup; the Unicode properties are only asked beyond it.
_BEYOND_ASCII = r"\x{80}-\x{10ffff}"
SPACE = rf"\t-\r\x1c-\x20[{_BEYOND_ASCII}&&[\x{{85}}\p{{Z}}]]"
ALNUM = rf"A-Za-z0-9[{_BEYOND_ASCII}&&[\p{{L}}\p{{N}}]]"
WORD = f"_{ALNUM}"
LETTER = rf"A-Za-z[{_BEYOND_ASCII}&&\p{{L}}]"
UPPER = rf"A-Z[{_BEYOND_ASCII}&&\p{{Lu}}]"
DECIMAL = rf"0-9[{_BEYOND_ASCII}&&\p{{Nd}}]"
NOT_AFTER_WORD = f"(?<![{WORD}])"
NOT_BEFORE_WORD = f"(?![{WORD}])"


def _non_decimal_digits() -> str:
    """Superscripts, circled digits and the like: digits that are not \\p{Nd}."""
    points = [
        cp
        for cp in range(0x80, sys.maxunicode + 1)
        if unicodedata.digit(chr(cp), None) is not None and unicodedata.category(chr(cp)) != "Nd"
    ]
    spans: list[list[int]] = []
    for cp in points:
        if spans and cp == spans[-1][1] + 1:
            spans[-1][1] = cp
        else:
            spans.append([cp, cp])
    return "".join(rf"\x{{{lo:x}}}-\x{{{hi:x}}}" for lo, hi in spans)


# Decimal digits and all others, as plain properties and in the form above.
ALL_DIGITS = r"\p{Nd}" + _non_decimal_digits()
DIGIT = f"0-9[{_BEYOND_ASCII}&&[{ALL_DIGITS}]]"
