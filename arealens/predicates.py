"""Comparison specs that build boolean columns."""

from __future__ import annotations

import operator
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F

OPERATORS = {
    "==": operator.eq,
    "!=": operator.ne,
    "<": operator.lt,
    "<=": operator.le,
    ">": operator.gt,
    ">=": operator.ge,
}


@dataclass(frozen=True)
class Comp:
    """One comparison against a constant."""

    op: str
    value: Any

    def __post_init__(self):
        if self.op not in OPERATORS:
            raise KeyError(f"unknown comparison {self.op!r}")

    def on(self, column: Column) -> Column:
        return OPERATORS[self.op](column, F.lit(self.value))


@dataclass(frozen=True)
class And:
    """All comparisons hold. One column is tested against all; several are tested pairwise."""

    comps: tuple[Comp, ...]

    def __init__(self, comps: Comp | Sequence[Comp]):
        items = (comps,) if isinstance(comps, Comp) else tuple(comps)
        if not all(isinstance(c, Comp) for c in items):
            raise TypeError("And takes Comp items only")
        object.__setattr__(self, "comps", items)

    def on(self, *columns: Column) -> Column:
        paired = columns if len(columns) > 1 else columns * len(self.comps)
        return reduce(operator.and_, [c.on(col) for c, col in zip(self.comps, paired)])


@dataclass(frozen=True)
class Or:
    """At least one of several Comp / And items holds."""

    items: tuple[Comp | And, ...]

    def __init__(self, items: Comp | And | Sequence[Comp | And]):
        listed = (items,) if isinstance(items, (Comp, And)) else tuple(items)
        object.__setattr__(self, "items", listed)

    def on(self, column: Column) -> Column:
        return reduce(operator.or_, [i.on(column) for i in self.items])


def span(low: int, high: int) -> And:
    return And([Comp(">=", low), Comp("<=", high)])


def any_of(*values: Any) -> Or:
    return Or([Comp("==", v) for v in values])


# Which land-use codes each jobs sector, and residents, can occupy.
OFFICE_CODES = (17, 18, 19)
SECTOR_LAND_USES: dict[str, Or] = {
    "CNS01": Or(span(50, 69)),
    "CNS02": any_of(92),
    "CNS03": any_of(91),
    "CNS04": any_of(17, 19),
    "CNS05": any_of(41, 42),
    "CNS06": any_of(29),
    "CNS07": Or(span(11, 16)),
    "CNS08": any_of(20, 48, 49),
    "CNS09": any_of(*OFFICE_CODES),
    "CNS10": any_of(23, 24),
    "CNS11": any_of(*OFFICE_CODES),
    "CNS12": any_of(*OFFICE_CODES),
    "CNS13": any_of(*OFFICE_CODES),
    "CNS14": any_of(89),
    "CNS15": any_of(72, 83, 84),
    "CNS16": any_of(73, 85),
    "CNS17": Or([span(30, 38), Comp("==", 82)]),
    "CNS18": any_of(21, 22, 33, 39),
    "CNS19": any_of(27, 28),
    "CNS20": Or(span(86, 89)),
}
RESIDENT_LAND_USES = Or([span(1, 9), span(100, 102)])

# The non-residential list leaves out agriculture, mining, utilities and code 83.
NON_RESIDENTIAL_CODES = (
    *range(11, 25), *range(27, 40), 41, 42, 48, 49, 72, 73, 82, *range(84, 90),
)
DEVELOPED_CODES = (*NON_RESIDENTIAL_CODES, *range(1, 10), 100, 101, 102)


def area_criteria() -> dict[str, Or]:
    """Criteria named as building-area columns: CNS_01_par ... CNS_20_par and RES_par."""
    named = {f"CNS_{k[3:]}_par": v for k, v in SECTOR_LAND_USES.items()}
    named["RES_par"] = RESIDENT_LAND_USES
    return named
