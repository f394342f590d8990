"""Column-expression builders shared by every operator.

All of these return ``pyspark.sql.Column`` objects made of built-in functions,
so they stay inside whole-stage codegen and behave the same whether
``spark.sql.ansi.enabled`` is true or false.
"""

from .casts import lenient_double, lenient_int, parse_timestamp, to_int_column
from .labels import UNKNOWN_CATEGORY, clean_category, hour_label, month_key, month_label, month_label_of
from .money import money_mean, money_parts, money_sum, money_value
from .profit import DEFAULT_PROFIT_MODEL, ProfitModel, default_probability, profit_factor

__all__ = [
    "DEFAULT_PROFIT_MODEL",
    "ProfitModel",
    "UNKNOWN_CATEGORY",
    "clean_category",
    "default_probability",
    "hour_label",
    "lenient_double",
    "lenient_int",
    "money_mean",
    "money_parts",
    "money_sum",
    "money_value",
    "month_key",
    "month_label",
    "month_label_of",
    "parse_timestamp",
    "profit_factor",
    "to_int_column",
]
