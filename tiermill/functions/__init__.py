"""Column-level functions (one column in, one column out), all JVM-side."""

from tiermill.functions.display import format_percent, format_thousands
from tiermill.functions.text import (
    accent_insensitive_equal,
    blank,
    lenient_date,
    lenient_int,
    mask_id,
    visible_digits,
)

__all__ = [
    "accent_insensitive_equal",
    "blank",
    "format_percent",
    "format_thousands",
    "lenient_date",
    "lenient_int",
    "mask_id",
    "visible_digits",
]
