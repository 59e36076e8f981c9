"""Pieces of a text that byte-level tokenisers treat independently of each other, and a bounded cache for them.

The split pattern of byte-level BPE never joins a visible character with a space or line feed that
follows it. Cutting before each space and line feed therefore leaves the encoding unchanged, unless
that cuts a run of white space. Texts with such runs are cut only where one space or line feed stands
between visible characters.
"""

from __future__ import annotations

import re

# White space as Unicode defines it (property White_Space); fixed values.
WHITE_SPACE = (
    "\t\n\x0b\x0c\r \x85\xa0            "
    "    　"
)
_BETWEEN = re.compile(f"(?<=[^{WHITE_SPACE}])(?=[ \n][^{WHITE_SPACE}])")
_CUT_ASCII = ("\t\0", "\r\0", "\x0b\0", "\x0c\0")
_CUT_RUN = re.compile(f"[{WHITE_SPACE.replace(' ', '').replace(chr(10), '')}]\0")


def split_units(text: str) -> list[str]:
    """The text in pieces; their encodings in order are the encoding of the text."""
    marked = text.replace(" ", "\0 ").replace("\n", "\0\n")
    cut = any(c in marked for c in _CUT_ASCII) if text.isascii() else _CUT_RUN.search(marked)
    if cut or "\0" in text or " \0" in marked or "\n\0" in marked:
        return _BETWEEN.split(text)
    return marked.split("\0")


class UnitCache(dict):
    """Values by unit, made on demand; holds the units of about the last ``2 * limit`` misses, or of the last call.

    The bound affects only speed: a unit that fell out is made again.
    """

    def __init__(self, make, limit: int = 75_000):
        super().__init__()
        self.make, self.limit, self.old = make, limit, {}

    def __missing__(self, unit):
        value = self.old.get(unit)
        if value is None:
            value = self.make(unit)
        if len(self) >= self.limit:
            self.old = dict(self)
            self.clear()
        self[unit] = value
        return value

    def all_of(self, wanted: set, make_all) -> dict:
        """The values of several units; those that are not held are made in one call of ``make_all``."""
        get, before = self.get, self.old.get
        found = {u: before(u) if (v := get(u)) is None else v for u in wanted}
        new = [u for u, v in found.items() if v is None]
        found.update(zip(new, make_all(new)))
        if len(self) + len(found) > self.limit:
            self.old = dict(self)
            self.clear()
        self.update(found)
        return found


def split_with_specials(text: str, specials: list[str]) -> list[str]:
    """The units of a text; each special string is a unit of its own and splits the text first."""
    for k, token in enumerate(specials):
        if token in text:
            first, *rest = [split_with_specials(part, specials[k + 1 :]) for part in text.split(token)]
            return first + [unit for part in rest for unit in (token, *part)]
    return split_units(text) if text else []
