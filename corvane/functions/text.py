"""Text repair and comparison as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def repair(s: Column) -> Column:
    """Undo UTF-8 that was read as Latin-1; any other text stays as it is."""
    raw = F.encode(s, "ISO-8859-1")
    return F.when(s.rlike(r"[^\x00-\xFF]"), s).otherwise(F.when(F.is_valid_utf8(raw.cast("string")), F.decode(raw, "UTF-8")).otherwise(s))


def folded_equal(s: Column, other: str) -> Column:
    """Equal without regard to case and accents; a null is not."""
    return F.coalesce(F.collate(s, "UNICODE_CI_AI") == F.collate(F.lit(other), "UNICODE_CI_AI"), F.lit(False))


def number(s: Column) -> Column:
    """A finite number, or null."""
    x = F.trim(s).try_cast("double")
    return F.when(~F.isnan(x) & (F.abs(x) < float("inf")) & ~F.lower(F.trim(s)).rlike("[df]$"), x)


def whole(x: Column) -> Column:
    """Rounded half-even to a whole number, as text."""
    return F.bround(x, 0).cast("long").cast("string")
