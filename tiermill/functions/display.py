"""Display formatting in the Brazilian convention, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def format_thousands(c: str | Column) -> Column:
    """Integer with ``.`` as thousands separator: 1524135 -> '1.524.135'."""
    col = F.col(c) if isinstance(c, str) else c
    return F.translate(F.format_number(col.cast("long"), 0), ",", ".")


def format_percent(c: str | Column, places: int = 2) -> Column:
    """Non-negative percentage with a decimal comma: 31.254 -> '31,25%', 31.25 at one place -> '31,2%'.

    The exact binary value is rounded, ties to the even digit, as printing a
    number with a fixed count of decimals does: the value times 2**76, a whole
    number for all but tiny percentages, is rounded in integers.
    """
    col = F.col(c) if isinstance(c, str) else c
    scale = 10**places
    wide = col.cast("double") * F.lit(float(1 << 52))
    high = F.floor(wide).cast("long")
    low = F.floor((wide - high.cast("double")) * F.lit(float(1 << 24))).cast("long")
    whole_bits = high.cast("decimal(20,0)") * F.lit(1 << 24).cast("decimal(8,0)") + low.cast("decimal(8,0)")
    product = whole_bits * F.lit(scale).cast(f"decimal({places + 1},0)")
    unit, half = (F.lit(str(1 << k)).cast("decimal(24,0)") for k in (76, 75))
    rest = product % unit
    down = ((product - rest) / unit).cast("long")
    scaled = down + ((rest > half) | ((rest == half) & (down % 2 == 1))).cast("long")
    whole = F.floor(scaled / F.lit(scale)).cast("long").cast("string")
    if places == 0:
        return F.concat(whole, F.lit("%"))
    frac = F.lpad(F.pmod(scaled, F.lit(scale)).cast("string"), places, "0")
    return F.concat(whole, F.lit(","), frac, F.lit("%"))
