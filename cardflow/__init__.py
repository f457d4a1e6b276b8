"""cardflow: a PySpark-native analytics package for bank-card portfolios.

Raw customer, account and transaction files are validated by ordered data
quality rules (each rejected row keeps the first reason that applies), the
accepted rows are joined into one enriched table with credit limits, credit
scores, tenure and instalment (EMI) offers, and four reports are served from
it.  Everything is a lazy DataFrame plan on a session the caller supplies.
"""

from cardflow.config import Settings

__all__ = ["Settings"]
