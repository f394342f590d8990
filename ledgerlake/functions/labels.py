"""Category cleaning and calendar labels."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Text that replaces a missing or blank product category, the
# month label layout ("Oct 2017") and the 24-hour label width ("0800").
UNKNOWN_CATEGORY = "Unknown category"
MONTH_LABEL_FORMAT = "MMM yyyy"
HOUR_LABEL_WIDTH = 4


def clean_category(c: Column) -> Column:
    """NULL or blank-after-trim → ``UNKNOWN_CATEGORY``; otherwise trimmed text.

    ``trim`` strips spaces only, so a tab is not blank.
    """
    return F.coalesce(F.nullif(F.trim(c), F.lit("")), F.lit(UNKNOWN_CATEGORY))


def month_key(ts: Column) -> Column:
    """Sortable ``yyyymm`` integer, e.g. 201710."""
    return F.year(ts) * F.lit(100) + F.month(ts)


def month_label(ts: Column) -> Column:
    """Presentation label such as ``Oct 2017``."""
    return F.date_format(ts, MONTH_LABEL_FORMAT)


def month_label_of(key: Column) -> Column:
    """Label of a ``yyyymm`` key: 201710 → ``Oct 2017``; NULL stays NULL.

    A label follows from its key, so grouping by the key alone is enough.
    """
    day = F.make_date(F.floor(key / 100).cast("int"), (key % 100).cast("int"), F.lit(1))
    return F.date_format(day, MONTH_LABEL_FORMAT)


def hour_label(hour: Column) -> Column:
    """24-hour clock label: 8 → ``0800``, 13 → ``1300``; NULL stays NULL."""
    return F.lpad((hour * F.lit(100)).cast("string"), HOUR_LABEL_WIDTH, "0")
