"""Row-local quality rules as Column builders, so that a whole rule table fuses
into one projection. UNIQUE is not row-local; see operators/quality.py."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martwright.functions.lineage import quoted

UNIQUE = "UNIQUE"


@dataclass(frozen=True)
class Rule:
    column: str
    kind: str
    value: str | None = None


def not_null(column: Column, _: str | None) -> Column:
    return column.isNull()


def positive(column: Column, _: str | None) -> Column:
    return column <= 0


def matches(column: Column, pattern: str | None) -> Column:
    return ~column.rlike(pattern)


def at_least(column: Column, minimum: str | None) -> Column:
    return column < number(minimum)


def one_of(column: Column, members: str | None) -> Column:
    return ~column.isin([member.strip() for member in members.split(",")])


def within(column: Column, bounds: str | None) -> Column:
    low, high = bounds.split(",")
    return ~column.between(number(low), number(high))


def number(text: str) -> Column:
    """A bound from the rule table, as an exact literal."""
    return F.lit(Decimal(text.strip()))


@dataclass(frozen=True)
class RowRule:
    violated: Callable[[Column, str | None], Column]
    numeric: bool = False
    needs_value: bool = False


# What each rule flags; a NULL verdict counts as passed.
ROW_RULES: dict[str, RowRule] = {
    "NOT_NULL": RowRule(not_null),
    "POSITIVE": RowRule(positive, numeric=True),
    "REGEX": RowRule(matches, needs_value=True),
    "MIN_VALUE": RowRule(at_least, numeric=True, needs_value=True),
    "DOMAIN": RowRule(one_of, needs_value=True),
    "RANGE": RowRule(within, numeric=True, needs_value=True),
}


def is_known(rule: Rule) -> bool:
    return rule.kind == UNIQUE or rule.kind in ROW_RULES


def violation(rule: Rule, schema: T.StructType) -> Column:
    """True where the row breaks ``rule``, never NULL."""
    spec = ROW_RULES[rule.kind]
    if spec.needs_value and not rule.value:
        raise ValueError(f"{rule.kind} on {rule.column} needs a rule_value")
    if spec.numeric and not isinstance(schema[rule.column].dataType, T.NumericType):
        raise TypeError(f"{rule.kind} needs a numeric column, {rule.column} is not")
    return F.coalesce(spec.violated(F.col(quoted(rule.column)), rule.value), F.lit(False))
