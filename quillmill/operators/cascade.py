"""Ordered rules as data: the first that holds decides."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Rule:
    when: Column
    action: str
    reason: str | Column = ""


@dataclass(frozen=True)
class Cascade:
    """Rules in order and what holds if none does; compiled to one CASE for each output."""

    rules: Sequence[Rule]
    default: str
    default_reason: str = ""

    def action(self) -> Column:
        return self._case([F.lit(r.action) for r in self.rules], F.lit(self.default))

    def reason(self) -> Column:
        return self._case([F.lit(r.reason) if isinstance(r.reason, str) else r.reason for r in self.rules], F.lit(self.default_reason))

    def decided(self) -> Column:
        """struct(action, reason) by one CASE, so that each condition is tested once."""
        reasons = [F.lit(r.reason) if isinstance(r.reason, str) else r.reason for r in self.rules]
        both = [F.struct(F.lit(r.action).alias("action"), why.alias("reason")) for r, why in zip(self.rules, reasons)]
        return self._case(both, F.struct(F.lit(self.default).alias("action"), F.lit(self.default_reason).alias("reason")))

    def _case(self, values: Sequence[Column], default: Column) -> Column:
        out = None
        for rule, value in zip(self.rules, values):
            out = F.when(rule.when, value) if out is None else out.when(rule.when, value)
        return default if out is None else out.otherwise(default)


def choose(*rules: tuple[Column, str], default: str | Column) -> Column:
    """A cascade with no reasons."""
    out = None
    for when, value in rules:
        out = F.when(when, value) if out is None else out.when(when, value)
    return out.otherwise(default)
