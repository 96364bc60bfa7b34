"""Conditional labels, ordered decision rules, lookup recodes."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce
from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def flag(condition: Column) -> Column:
    """1 where the condition holds; 0 where it does not or cannot be decided (null)."""
    return F.when(condition, 1).otherwise(0)


def choose(condition: Column, yes: Any, no: Any) -> Column:
    return F.when(condition, F.lit(yes)).otherwise(F.lit(no))


def first_match(rules: Sequence[tuple[Column, Any]], default: Any = None) -> Column:
    """Value of the first condition that holds."""
    out = reduce(lambda acc, r: acc.when(r[0], F.lit(r[1])), rules[1:], F.when(rules[0][0], F.lit(rules[0][1])))
    return out.otherwise(F.lit(default))


def tiers(x, cuts: Sequence[tuple[float, str]], default: str) -> Column:
    """Label of the first cut (highest first) the value reaches."""
    return first_match([(_c(x) >= c, label) for c, label in cuts], default)


def first_rule(rules: Sequence[Column], default: Any) -> Column:
    """Outcome of the first rule that returns something (rules are null when not triggered)."""
    return F.coalesce(*rules, F.lit(default))


def rules_passed(checks: Sequence[Column]) -> Column:
    """How many checks are true."""
    return reduce(lambda a, b: a + b, [flag(c) for c in checks])


def all_rules(checks: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a & b, checks)


def apply_batch(columns: Sequence[str], fn: Callable[[Column], Column], suffix: str = "") -> list[Column]:
    """Apply one Column function to a batch of columns."""
    return [fn(F.col(c)).alias(f"{c}{suffix}") for c in columns]


def lookup(x, table: Mapping[Any, Any]) -> Column:
    """Full recode; values outside the table become null."""
    literals = F.create_map(*[F.lit(v) for kv in table.items() for v in kv])
    return F.try_element_at(literals, _c(x))


def lookup_or(x, table: Mapping[Any, Any], default: Any) -> Column:
    return F.coalesce(lookup(x, table), F.lit(default))


def replace_values(x, table: Mapping[Any, Any]) -> Column:
    """Recode listed values and keep the others."""
    return F.coalesce(lookup(x, table), _c(x))


def level_order(x, levels: Sequence[str]) -> Column:
    """Ordinal of a label in a declared order; unknown labels come last."""
    return lookup_or(x, {v: i for i, v in enumerate(levels)}, len(levels))


def text_or(x, default: str) -> Column:
    """Text with a fallback for missing and blank values."""
    col = _c(x)
    return F.coalesce(F.nullif(F.trim(col), F.lit("")), F.lit(default))
