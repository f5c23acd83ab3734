"""Phone numbers to E.164 by dialling rules, as column expressions.

Dialling rules only: a number is accepted when its national part has a length
that its country uses. Which prefixes a country has really handed out is not
looked up.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Region -> (calling code, trunk prefix, international prefix,
# fewest and most digits of a national number).
DIALLING = {
    "AT": ("43", "0", "00", 5, 13), "AU": ("61", "0", "0011", 6, 9), "BE": ("32", "0", "00", 8, 9),
    "BG": ("359", "0", "00", 7, 9), "CA": ("1", "1", "011", 10, 10), "CH": ("41", "0", "00", 9, 9),
    "CZ": ("420", "", "00", 9, 9), "DE": ("49", "0", "00", 6, 11), "DK": ("45", "", "00", 8, 8),
    "ES": ("34", "", "00", 9, 9), "FI": ("358", "0", "00", 6, 11), "FR": ("33", "0", "00", 9, 9),
    "GB": ("44", "0", "00", 9, 10), "GR": ("30", "", "00", 10, 10), "HR": ("385", "0", "00", 8, 9),
    "HU": ("36", "06", "00", 8, 9), "IE": ("353", "0", "00", 7, 9), "IN": ("91", "0", "00", 10, 10),
    "IT": ("39", "", "00", 6, 11), "LI": ("423", "", "00", 7, 9), "LU": ("352", "", "00", 6, 11),
    "NL": ("31", "0", "00", 9, 9), "NO": ("47", "", "00", 8, 8), "NZ": ("64", "0", "00", 8, 10),
    "PL": ("48", "", "00", 9, 9), "PT": ("351", "", "00", 9, 9), "RO": ("40", "0", "00", 9, 9),
    "SE": ("46", "0", "00", 7, 10), "SI": ("386", "0", "00", 8, 8), "SK": ("421", "0", "00", 9, 9),
    "TR": ("90", "0", "00", 10, 10), "US": ("1", "1", "011", 10, 10),
}
_ASIDE = r"(?i)[\s,;]*(?:extension|ext\.?|durchwahl|x|#)[\s:.]*[0-9]{1,7}\s*$|\(\s*0\s*\)"
# keeps the digits, and a plus only in front of the first of them
_DIALLED = r"\A[^+0-9]*(\+?)|[^0-9]"
# a national number in the bounds of its calling code; other codes by the bounds
# of the numbering plan as a whole
_E164 = "^(?:{}|(?!{})[1-9][0-9]{{6,14}})$".format(
    "|".join(sorted({f"{code}[0-9]{{{low},{high}}}" for code, _, _, low, high in DIALLING.values()})),
    "|".join(sorted({code for code, *_ in DIALLING.values()})),
)


def to_e164(c: Column, region: str) -> Column:
    """``+`` and the full number, or null if it has not the shape of one.

    Each step rewrites the front of the number in place: an international prefix
    becomes ``!``, a trunk prefix or nothing becomes the calling code, and a
    trunk prefix written behind the region's own code is dropped.
    """
    if region not in DIALLING:
        raise ValueError(f"no dialling rules for region {region!r}")
    code, trunk, idd, _, _ = DIALLING[region]
    number = F.regexp_replace(c, _ASIDE, "")
    number = F.regexp_replace(number, _DIALLED, "$1")
    number = F.regexp_replace(number, rf"^(?:\+|{idd})", "!")
    number = F.regexp_replace(number, rf"^(?:{trunk}(?=[0-9])|(?=[0-9]))", code)
    tail = rf"(?:({code}){trunk}(?=[0-9]))?" if trunk else "()"
    number = F.regexp_replace(number, f"^!?{tail}", "$1")
    return F.when(number.rlike(_E164), F.concat(F.lit("+"), number))
