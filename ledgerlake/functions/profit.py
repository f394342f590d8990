"""Installment-default profit model, as a native expression (no Python UDF).

Model: a sale earns a gross ``margin`` of its price; a customer paying in
``n`` monthly installments defaults with probability
``p(n) = 1 - (1 - rate)^n`` (or a flat ``rate`` when not compounding) and then
pays only ``1 - loss`` of the price.  The expected profit per unit of revenue
is ``margin - loss * p(n)``.  Paying at once (``n`` NULL or ≤ 1) carries no
credit risk.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

# Decimals kept in the result: ``pow`` may differ by one ulp between engines.
FACTOR_DECIMALS = 12


@dataclass(frozen=True)
class ProfitModel:
    # Fixed values of the published model: 25 % gross margin, defaulters pay
    # half the price, 22.9 % monthly default hazard, compounded over n months.
    margin: float = 0.25
    loss: float = 0.5
    rate: float = 0.229
    compounding: bool = True


DEFAULT_PROFIT_MODEL = ProfitModel()


def _no_credit(n: Column) -> Column:
    return n.isNull() | (n <= F.lit(1))


def default_probability(n: Column, model: ProfitModel = DEFAULT_PROFIT_MODEL) -> Column:
    """P(default) for an ``n``-installment plan; 0 when paid at once."""
    if model.compounding:
        p = F.lit(1.0) - F.pow(F.lit(1.0 - model.rate), n.cast("double"))
    else:
        p = F.lit(float(model.rate))
    return F.when(_no_credit(n), F.lit(0.0)).otherwise(F.round(p, FACTOR_DECIMALS))


def profit_factor(n: Column, model: ProfitModel = DEFAULT_PROFIT_MODEL) -> Column:
    """Expected profit per unit of revenue for an ``n``-installment plan."""
    if model.compounding:
        p = F.lit(1.0) - F.pow(F.lit(1.0 - model.rate), n.cast("double"))
    else:
        p = F.lit(float(model.rate))
    factor = F.lit(float(model.margin)) - F.lit(float(model.loss)) * p
    return F.when(_no_credit(n), F.lit(float(model.margin))).otherwise(
        F.round(factor, FACTOR_DECIMALS)
    )
