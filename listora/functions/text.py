"""Text expressions shared by the stages. All stay inside Catalyst."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Unicode white space, the four separators U+001C..U+001F included.
WHITE_SPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
_SPACE_RUN = r"(?U)[\s\x1c-\x1f]+"
_CASED = r"\p{Lu}\p{Ll}\p{Lt}"
_MARK = "\u0001 "


def trim_ws(c: Column) -> Column:
    """Strip Unicode white space at both ends (plain ``trim`` strips only blanks)."""
    return F.btrim(c, F.lit(WHITE_SPACE))


def _holds(c: Column, pattern: str) -> Column:
    return F.coalesce(c.cast("string").rlike(pattern), F.lit(False))


def not_blank(c: Column) -> Column:
    """True for text holding at least one visible character; false for null."""
    return _holds(c, r"(?U)[^\s\x1c-\x1f]")


def present(c: Column) -> Column:
    """Holds a value: not null, not blank, and not the text ``nan``. One look at
    the text, over at the first visible character."""
    return _holds(c, r"(?Us)\A(?![nN][aA][nN]\z).*?[^\s\x1c-\x1f]")


def title_words(c: Column) -> Column:
    """Capital after every character that has no case, lower case elsewhere.

    ``initcap`` only starts a word after a blank, so a marker ending in a blank
    is put before each such letter and taken out again. Unlike splitting into
    an array this stays inside generated code.
    """
    marked = F.regexp_replace(c, f"(?<=[^{_CASED}])(?=[{_CASED}])", _MARK)
    return F.regexp_replace(F.initcap(marked), f"{_MARK}(?=[{_CASED}])", "")


def sorted_tokens(c: Column) -> Column:
    """White-space separated tokens in sorted order, joined by one blank."""
    tokens = F.split(trim_ws(c), _SPACE_RUN)
    return F.array_join(F.array_sort(tokens), " ")
