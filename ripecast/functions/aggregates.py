"""Aggregate expressions that stay NULL where the plain ones would raise."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def safe_corr(left: Column, right: Column) -> Column:
    """Pearson correlation over rows with both values; NULL when one side is constant (``corr`` raises there)."""
    both = left.isNotNull() & right.isNotNull()
    a, b = F.when(both, left.cast("double")), F.when(both, right.cast("double"))
    return F.try_divide(F.covar_pop(a, b), F.sqrt(F.var_pop(a)) * F.sqrt(F.var_pop(b)))


def uplift(policy: Column, baseline: Column) -> Column:
    """Relative gain of the policy total over the baseline total; NULL when the baseline is zero."""
    return F.try_divide(F.sum(policy) - F.sum(baseline), F.sum(baseline))
