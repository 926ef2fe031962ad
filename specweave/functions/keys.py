"""Identity: content-hash ids and the comparison form of references."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: What counts as an outer blank of an id or a label.
BLANKS = " \t\n\r\u00a0\u2007\u202f\u2009\u3000\ufeff"


def blank_trim(value: Column) -> Column:
    """``value`` without outer blanks (spaces, tabs, line ends, no-break spaces)."""
    return F.btrim(value, F.lit(BLANKS))


def id_key(value: Column) -> Column:
    """The form in which two spellings of one id are equal: no outer blanks, lower case; null if nothing is left."""
    trimmed = F.lower(blank_trim(value))
    return F.when(trimmed != "", trimmed)


def content_id(prefix: str, *parts: Column) -> Column:
    """``prefix`` and the first 16 hex digits of the SHA-256 of the parts joined by ``|``; a null part counts as empty."""
    joined = F.concat_ws("|", *[F.coalesce(p.cast("string"), F.lit("")) for p in parts])
    return F.concat(F.lit(prefix), F.substring(F.sha2(joined, 256), 1, 16))
