"""ANSI-independent casts.

Spark 4 runs with ``spark.sql.ansi.enabled=true`` by default, where a plain
``cast`` of ``'abc'`` to int raises.  The Silver layer must keep every row and
turn unparseable values into NULL, so these helpers only use ``try_*`` forms.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import (
    DataType,
    DateType,
    StringType,
    TimestampNTZType,
    TimestampType,
)

# Fixed value: the text layout of raw purchase dates.
PURCHASE_DATE_FORMAT = "yyyy-MM-dd HH:mm:ss"
# The same layout as a regular expression: exactly four-two-two digits, a
# space, two:two:two digits, nothing before or after (\z: not even a newline).
_PURCHASE_DATE_LAYOUT = r"^\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}\z"

# Integer text with a fractional tail ("12.0", "-3.7", "5.") keeps its integer
# part, as a non-ANSI cast truncates it; with no integer part at all (".5",
# "-.5", ".") the non-ANSI cast gives 0.
_INT_WITH_FRACTION = r"^([+-]?\d+)\.\d*$"
_FRACTION_ONLY = r"^[+-]?\.\d*$"
# What a cast trims at either end: white space and control characters.
_CAST_BLANKS = r"^[\x00-\x20\x7F]+|[\x00-\x20\x7F]+$"


def lenient_int(c: Column) -> Column:
    """String → int that never raises.

    Blank, non-numeric, infinite or out-of-range text gives NULL; padded
    (``' 7 '``) and signed (``'+4'``) text parses; a fractional tail is
    truncated (``'12.9'`` → 12, ``'.5'`` → 0) — the results of a non-ANSI
    cast, without its failure mode under ANSI.
    """
    text = F.regexp_replace(c, _CAST_BLANKS, "")
    whole = F.when(text.rlike(_FRACTION_ONLY), F.lit("0")).otherwise(
        F.regexp_replace(text, _INT_WITH_FRACTION, "$1")
    )
    return whole.try_cast("int")


def lenient_double(c: Column) -> Column:
    """Any → double that never raises (``'x'`` → NULL, ``'inf'`` → Infinity)."""
    return c.try_cast("double")


def to_int_column(name: str, dtype: DataType) -> Column:
    """Narrow column ``name`` of type ``dtype`` to int without raising.

    Text goes through :func:`lenient_int`; numbers use ``try_cast`` (a value
    outside the int range becomes NULL).
    """
    c = F.col(name)
    if isinstance(dtype, StringType):
        return lenient_int(c)
    return c.try_cast("int")


def parse_timestamp(c: Column, dtype: DataType, fmt: str = PURCHASE_DATE_FORMAT) -> Column:
    """Parse a purchase date into ``TIMESTAMP_NTZ``; bad text gives NULL.

    Text must have the exact ``fmt`` layout; the value then comes from a
    zone-free cast to ``TIMESTAMP_NTZ``, which also rejects impossible dates
    and times (Feb 30, hour 24).  That keeps the result independent of the
    session time zone (a wall clock in a daylight-saving gap is not shifted).
    For the default layout the check is one anchored regular expression —
    this runs once per raw row, and it costs about a third less than a second
    parse with the date-time formatter (same results on the edge cases in the
    tests).  Timestamp columns pass through apart from the NTZ cast; a DATE
    column gives that day's midnight.
    """
    if isinstance(dtype, TimestampNTZType):
        return c
    if isinstance(dtype, (TimestampType, DateType)):
        return c.cast("timestamp_ntz")
    text = c.cast("string")
    if fmt == PURCHASE_DATE_FORMAT:
        valid = text.rlike(_PURCHASE_DATE_LAYOUT)
    else:
        valid = F.try_to_timestamp(text, F.lit(fmt)).isNotNull()
    return F.when(valid, text.try_cast("timestamp_ntz"))
