"""Ordered rule tables folded into one JVM-side ``CASE WHEN`` expression.

A ``RuleSet`` is a list of ``(predicate, value)`` pairs plus a default; the
first predicate that is *true* wins (a null predicate falls through, exactly
like ``when``).  ``chain()`` gives the value column, ``selects(threshold)`` an
equivalent filter on the raw columns that Catalyst can push into the scan.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from typing import Any, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Rule:
    predicate: Column
    value: Any


class RuleSet:
    def __init__(self, rules: Sequence[tuple[Column, Any]], default: Any):
        self.rules = [Rule(p, v) for p, v in rules]
        self.default = default

    def chain(self) -> Column:
        """First-match-wins value as a single ``CASE WHEN`` expression."""
        expr = None
        for rule in self.rules:
            lit = F.lit(rule.value)
            expr = F.when(rule.predicate, lit) if expr is None else expr.when(rule.predicate, lit)
        if expr is None:
            return F.lit(self.default)
        return expr.otherwise(F.lit(self.default))

    def selects(self, keep) -> Column:
        """Predicate true exactly when the chosen value satisfies ``keep``.

        ``keep`` is a Python test on rule values, e.g. ``lambda s: s > 0.5``.
        A row is kept when its first true rule keeps it; rules that do not
        keep a row only matter when they come *before* a keeping rule, so
        their negation is added there.  The result is a plain boolean
        expression over the input columns (no CASE), so the parquet reader
        gets it as ``PushedFilters``.
        """
        terms = []
        blockers: list[Column] = []
        for rule in self.rules:
            if keep(rule.value):
                term = rule.predicate
                for b in blockers:
                    term = term & ~F.coalesce(b, F.lit(False))
                terms.append(term)
            else:
                blockers.append(rule.predicate)
        if keep(self.default):
            # Default rows are kept too: keep unless a non-keeping rule fires first.
            none_drop = reduce(lambda a, b: a & b,
                               [~F.coalesce(b, F.lit(False)) for b in blockers],
                               F.lit(True))
            terms.append(none_drop)
        if not terms:
            return F.lit(False)
        return reduce(lambda a, b: a | b, terms)
