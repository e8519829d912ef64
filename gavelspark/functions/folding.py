"""Folding of names and titles to comparable keys."""

from __future__ import annotations

import unicodedata
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def _folds() -> tuple[str, str, str, dict[str, str]]:
    """From the Unicode data: characters whose compatibility decomposition without marks is one
    other character, what they give, the marks, and letters that give several."""
    one, to, marks, several = [], [], [], {}
    for code in range(0xA0, 0x10000):
        c = chr(code)
        if 0xAC00 <= code < 0xD7B0 or 0xD800 <= code < 0xE000:
            continue  # syllables fall into parts of their own alphabet, no marks go; surrogates
        if unicodedata.combining(c):
            marks.append(c)
            continue
        bare = "".join(x for x in unicodedata.normalize("NFKD", c) if not unicodedata.combining(x))
        if bare == c:
            continue
        if len(bare) == 1:
            one.append(c)
            to.append(bare)
        elif c.isalpha() and bare.isascii() and bare.isalpha():
            several[c] = bare
    return "".join(one), "".join(to), "".join(marks), several


_ONE, _TO, _MARKS, _SEVERAL = _folds()


def unaccent(value: Column) -> Column:
    """Compatibility decomposition without combining marks: García gives Garcia, ł (which has none)
    stays; null stays null.  Letters that give several, as ligatures, are looked up only where
    there are any; other such signs (fractions, units) stay."""
    plain = F.translate(value, _ONE + _MARKS, _TO)
    spread = reduce(lambda text, kv: F.replace(text, F.lit(kv[0]), F.lit(kv[1])), [kv for kv in _SEVERAL.items() if ord(kv[0]) < 0x250 or 0xFB00 <= ord(kv[0]) < 0xFB07], plain)
    few = "".join(c for c in _SEVERAL if ord(c) < 0x250 or 0xFB00 <= ord(c) < 0xFB07)
    return F.when(plain.rlike(f"[{few}]"), spread).otherwise(plain)


def alnum_key(value: Column) -> Column:
    """Letters and digits only: case, accents, punctuation and blanks do not count,
    ``&`` is ``and``.  Null gives null, a text without letters gives ''."""
    text = F.regexp_replace(F.replace(F.lower(value), F.lit("ß"), F.lit("ss")), "&", "and")
    return F.regexp_replace(F.lower(unaccent(text)), r"[^\p{L}\p{N}]", "")
