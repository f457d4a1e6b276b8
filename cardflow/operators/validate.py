"""Ordered data-quality rules evaluated in one pass.

The reference applies each rule to the survivors of the previous one and
takes complements with EXCEPT (one scan and shuffle per rule).  Since a row
gets the first reason that applies, the same result is one CASE expression:
`when(r1, t1).when(r2, t2)...` -- NULL means the row is accepted.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

REASON = "Rejection_Reason"
CODE = "reason_code"


@dataclass(frozen=True)
class Rule:
    code: str          # short id, used as partition value of reject tables
    text: str          # the reject text
    rejects: Column    # TRUE when the row is rejected; must not be NULL


def any_null(cols: Sequence[str]) -> Column:
    return reduce(lambda a, b: a | b, [F.col(c).isNull() for c in cols])


def any_match(cols: Sequence[str], pattern: str) -> Column:
    """TRUE if some column matches; NULL columns count as no match
    (a positive filter keeps NULL rows out of the reject side)."""
    return F.coalesce(reduce(lambda a, b: a | b, [F.col(c).rlike(pattern) for c in cols]), F.lit(False))


def not_all_clear(cols: Sequence[str], pattern: str) -> Column:
    """TRUE unless every column is known not to match (a negated filter:
    a NULL result is not kept, so it is a reject)."""
    return F.coalesce(reduce(lambda a, b: a | b, [F.col(c).rlike(pattern) for c in cols]), F.lit(True))


def first_reason(rules: Sequence[Rule]) -> tuple[Column, Column]:
    """(reason text, reason code) of the first rule that fires, else NULLs."""
    text = code = None
    for r in rules:
        text = F.when(r.rejects, F.lit(r.text)) if text is None else text.when(r.rejects, F.lit(r.text))
        code = F.when(r.rejects, F.lit(r.code)) if code is None else code.when(r.rejects, F.lit(r.code))
    return text, code


def apply_rules(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """`df` with `Rejection_Reason` and `reason_code` (NULL = accepted)."""
    text, code = first_reason(rules)
    return df.withColumns({REASON: text, CODE: code})


def accepted(checked: DataFrame) -> DataFrame:
    return checked.filter(F.col(CODE).isNull()).drop(REASON, CODE)


def rejected(checked: DataFrame) -> DataFrame:
    return checked.filter(F.col(CODE).isNotNull())
