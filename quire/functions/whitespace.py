"""White space as Unicode defines it, for Java and Python regular expressions alike."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F


def char_class(ranges: tuple[tuple[int, int], ...]) -> str:
    """The inside of a character class that Java and Python read the same way."""
    return "".join(chr(a) if a == b else f"{chr(a)}-{chr(b)}" for a, b in ranges)


#: The code points with the Unicode property White_Space.
WS_RANGES = ((0x09, 0x0D), (0x20, 0x20), (0x85, 0x85), (0xA0, 0xA0), (0x1680, 0x1680), (0x2000, 0x200A), (0x2028, 0x2029), (0x202F, 0x202F), (0x205F, 0x205F), (0x3000, 0x3000))
UNICODE_WS = char_class(WS_RANGES)
#: Characters that end a line.
LINE_ENDS = char_class(((0x0A, 0x0D), (0x85, 0x85), (0x2028, 0x2029)))

TOKEN_RE = re.compile(f"[^{UNICODE_WS}]+")


def count_ws_tokens(col: Column) -> Column:
    """Number of maximal runs of characters that are not Unicode white space; null stays null.

    Java's \\S means just that with the flag (?U), and tests a character far faster than a class of ranges.
    """
    return F.regexp_count(col, F.lit(r"(?U)\S++"))
