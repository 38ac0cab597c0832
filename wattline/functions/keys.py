"""Surrogate keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from wattline.functions.time import ISO_SECOND_PATTERN


def iso_text(ts: Column | str) -> Column:
    return F.date_format(ts, ISO_SECOND_PATTERN)


def surrogate_key(*parts: Column) -> Column:
    """Non-negative 64-bit key: the last eight MD5 bytes of the joined parts.

    A missing part counts as empty text, so its separator stays in place.
    """
    joined = F.concat_ws("|", *[F.coalesce(p.cast("string"), F.lit("")) for p in parts])
    return F.abs(F.conv(F.right(F.md5(joined), F.lit(16)), 16, -10).cast("bigint"))
