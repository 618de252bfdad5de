"""Feature-id normalisation shared by the reference checks, periods and hierarchies."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

BLANKS = " \t\r\n"


def unescape(c: Column) -> Column:
    """Turn percent escapes into their characters; a stray ``%`` and a plus sign stay as they are."""
    guarded = F.regexp_replace(F.regexp_replace(c, r"%(?![0-9A-Fa-f]{2})", "%25"), r"\+", "%2B")
    return F.when(F.contains(c, F.lit("%")), F.coalesce(F.try_url_decode(guarded), c)).otherwise(c)


def feature_id(c: Column) -> Column:
    """An id for comparison: unescaped, cut of blanks; null, empty and ``.`` become null."""
    clean = F.btrim(unescape(c), F.lit(BLANKS))
    return F.when(clean.isin("", "."), F.lit(None)).otherwise(clean)


def month(c: Column) -> Column:
    """``YYYY-MM`` of a timestamp, ``unknown`` for null; free of time zones."""
    return F.coalesce(F.substring(c.cast("string"), 1, 7), F.lit("unknown"))
