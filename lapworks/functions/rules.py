"""Ordered validity rules: the first failing rule decides, rows are kept.

A rule is ``(reason, failed)`` where ``failed`` is a boolean Column that is
true when the row breaks the rule.  A NULL ``failed`` does not count as a
failure (so a NULL pit flag falls through), matching a ``CASE WHEN`` chain.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Rule:
    reason: str
    failed: Column


def passes_all(rules: list[Rule]) -> Column:
    """``CASE WHEN r1 THEN false WHEN r2 THEN false ... ELSE true END``."""
    if not rules:
        return F.lit(True)
    expr = F.when(rules[0].failed, F.lit(False))
    for r in rules[1:]:
        expr = expr.when(r.failed, F.lit(False))
    return expr.otherwise(F.lit(True))


def first_failing_rule(rules: list[Rule]) -> Column:
    """Name of the first rule the row breaks, NULL when it passes all."""
    if not rules:
        return F.lit(None).cast("string")
    return reduce(lambda acc, r: acc.when(r.failed, F.lit(r.reason)),
                  rules[1:], F.when(rules[0].failed, F.lit(rules[0].reason)))
