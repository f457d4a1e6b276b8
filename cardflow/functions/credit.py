"""Credit metrics of one enriched transaction, as column expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from cardflow.config import Settings

# Fixed values: (upper bound, score) bands of the days since the account opened and of
# the number of defaults, and the score above the last bound.
TENURE_BANDS, TENURE_TOP = ((365, 200), (720, 400)), 500
DEFAULT_BANDS, DEFAULT_TOP = ((1, 100), (3, 50)), 0
# EMI eligibility thresholds.
EMI_MIN_SCORE = 500
EMI_MIN_TENURE_DAYS = 720
EMI_MIN_AMOUNT = 56000


def banded(value: Column, bands: Sequence[tuple[float, int]], top: int, missing: int | None) -> Column:
    """Score of the first band whose upper bound lies above `value`, `top` beyond
    the last, `missing` for NULL."""
    score = F.when(value.isNull(), F.lit(missing).cast("int"))
    for bound, points in bands:
        score = score.when(value < bound, points)
    return score.otherwise(top)


def tenure_score(days: Column) -> Column:
    return banded(days, TENURE_BANDS, TENURE_TOP, None)


def default_score(defaulted: Column) -> Column:
    """Negative counts score like many defaults, as NULL does."""
    return F.when(defaulted < 0, DEFAULT_TOP).otherwise(banded(defaulted, DEFAULT_BANDS, DEFAULT_TOP, DEFAULT_TOP))


def income_score(income: Column, s: Settings) -> Column:
    """One score per income limit, the last one above all limits (and for NULL)."""
    *points, top = s.income_scores
    return banded(income, tuple(zip(s.income_limits, points)), top, top)


def monthly_rate(pct: float) -> Column:
    return F.lit(pct / 1200.0)


def emi_parts(amount: Column, months: int, pct: float) -> tuple[Column, Column, Column]:
    """(numerator, denominator, instalment) of the annuity formula
    P*r*(1+r)^n / ((1+r)^n - 1) with r = pct/1200."""
    r = monthly_rate(pct)
    growth = F.pow(F.lit(1.0) + r, F.lit(float(months)))
    num = amount * r * growth
    den = growth - F.lit(1.0)
    return num, den, F.try_divide(num, den)
