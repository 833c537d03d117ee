"""Characters that every tokenizer library classifies alike.

Libraries follow different versions of Unicode, so a newly assigned letter is a letter to one
and nothing to another.  A character is settled if its general category in Unicode 3.2 is the
one it has today and it is no control character but tab, line feed, vertical tab, form feed and
carriage return: such a character is a letter, a number, white space or none of these everywhere.
"""

from __future__ import annotations

import re
import sys
import unicodedata
from functools import cache

CONTROLS = "\t\n\x0b\x0c\r"


def is_settled(c: str) -> bool:
    now = unicodedata.category(c)
    if now == "Cc":
        return c in CONTROLS
    return now not in ("Cn", "Cs") and unicodedata.ucd_3_2_0.category(c) == now


@cache
def unsettled() -> re.Pattern:
    """Matches a character that is not settled."""
    ranges: list[list[int]] = []
    for point in range(sys.maxunicode + 1):
        if is_settled(chr(point)):
            if ranges and ranges[-1][1] == point - 1:
                ranges[-1][1] = point
            else:
                ranges.append([point, point])
    return re.compile("[^" + "".join(f"\\U{a:08x}-\\U{b:08x}" for a, b in ranges) + "]")


def all_settled(text: str) -> bool:
    return text.isascii() and text.isprintable() or unsettled().search(text) is None
