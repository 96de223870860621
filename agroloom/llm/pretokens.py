"""The pre-tokens of byte-level tokenizers: the matches of ``public_tokenizers.PATTERN``."""

from __future__ import annotations

import re
import unicodedata
from functools import cache

#: Texts within these blocks are split by Python's ``re`` with explicit classes; their letters,
#: numbers and spaces are the same in all Unicode versions. Others need a Unicode-aware splitter.
_PLAIN = ((0x0000, 0x052F), (0x2010, 0x2027), (0x2030, 0x205E), (0x20AC, 0x20AC))


def _ranges(member) -> str:
    points = [x for low, high in _PLAIN for x in range(low, high + 1) if member(chr(x))]
    ranges: list[list[int]] = []
    for x in points:
        if ranges and ranges[-1][1] == x - 1:
            ranges[-1][1] = x
        else:
            ranges.append([x, x])
    return "".join(f"{re.escape(chr(a))}-{re.escape(chr(b))}" for a, b in ranges)


@cache
def _patterns():
    letter = _ranges(lambda ch: unicodedata.category(ch)[0] == "L")
    number = _ranges(lambda ch: unicodedata.category(ch)[0] == "N")
    space = _ranges(lambda ch: ch.isspace() and ch not in "\x1c\x1d\x1e\x1f")
    plain = "".join(f"{re.escape(chr(a))}-{re.escape(chr(b))}" for a, b in _PLAIN)
    split = re.compile(
        f"'s|'t|'re|'ve|'m|'ll|'d| ?[{letter}]+| ?[{number}]+| ?[^{space}{letter}{number}]+"
        f"|[{space}]+(?![^{space}])|[{space}]+"
    )
    return split.findall, re.compile(f"[^{plain}]").search


def splitters():
    """``(split, odd)``: ``split(text)`` gives its pre-tokens if ``odd(text)`` is None."""
    return _patterns()
