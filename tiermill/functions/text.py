"""Text, cast and masking expressions used by the silver layer and the checks."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values: masking rule of the silver layer ---
MASK_KEEP = 8
MASK_SUFFIX = "******"
MASK_PATTERN = r"\*{6}$"


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def mask_id(c: str | Column, keep: int = MASK_KEEP, suffix: str = MASK_SUFFIX) -> Column:
    """Keep the first ``keep`` characters and append the mask suffix.

    NULL stays NULL and shorter values are kept whole (no length guard),
    which the masking checks then report.
    """
    return F.concat(F.substring(_col(c), 1, keep), F.lit(suffix))


def lenient_int(c: str | Column) -> Column:
    """Text to INT; unparsable, empty or overflowing text becomes NULL.

    ANSI mode would raise on a bad value, so ``try_cast`` is used. Surrounding
    spaces are accepted; a fractional value such as ``12.7`` becomes NULL.
    """
    return _col(c).try_cast("int")


def lenient_date(c: str | Column) -> Column:
    """Text to DATE; anything that is not an ISO date becomes NULL."""
    return _col(c).try_cast("date")


def blank(c: str | Column) -> Column:
    """NULL, or empty after trimming spaces."""
    col = _col(c)
    return col.isNull() | (F.trim(col) == "")


def visible_digits(c: str | Column) -> Column:
    """Number of digit characters (0-9) left visible in a masked identifier.

    Same count as ``length(regexp_replace(c, '[^0-9]', ''))`` but with a
    character translation instead of a regex per row.
    """
    col = _col(c)
    return F.length(col) - F.length(F.translate(col, "0123456789", ""))


def accent_insensitive_equal(a: str | Column, b: str | Column) -> Column:
    """Equality that ignores accents but not case (Unicode AI collation)."""
    return F.collate(_col(a), "UNICODE_AI") == F.collate(_col(b), "UNICODE_AI")
