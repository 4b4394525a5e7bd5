"""Declarative column, table and calculation specs. They hold names and build Column expressions."""

from __future__ import annotations

import itertools
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Aggregates by name. "size" counts rows, whatever the column holds.
AGGREGATES: dict[str, Callable[[Column], Column]] = {
    "sum": F.sum,
    "mean": F.avg,
    "min": F.min,
    "max": F.max,
    "size": lambda c: F.count(F.lit(1)),
    "count": F.count,
}
# Medians are computed by arealens.skew.exact_median, not by one aggregate call.
MEDIAN = "median"

ROW_FOLDS: dict[str, Callable[[Sequence[Column]], Column]] = {
    "sum": lambda cols: reduce(lambda a, b: a + b, cols),
    "product": lambda cols: reduce(lambda a, b: a * b, cols),
}


def aggregate(method: str | Callable[[Column], Column], column: Column) -> Column:
    """The aggregate for a spec's method: a known name, or a function from Column to aggregate Column."""
    if callable(method):
        return method(column)
    if method not in AGGREGATES:
        raise ValueError(f"unknown aggregate {method!r}; known: {sorted(AGGREGATES) + [MEDIAN]}")
    return AGGREGATES[method](column)


def fold(method: str | Callable[[Sequence[Column]], Column], columns: Sequence[Column]) -> Column:
    if callable(method):
        return method(columns)
    if method not in ROW_FOLDS:
        raise ValueError(f"unknown row method {method!r}; known: {sorted(ROW_FOLDS)}")
    return ROW_FOLDS[method](columns)


@dataclass(frozen=True)
class DomainCol:
    """Maps category labels to order numbers, `default` for others."""

    name: str
    mapping: Mapping[Any, int]
    default: int = -1

    def of(self, label: Column) -> Column:
        if not self.mapping:
            return F.lit(self.default)
        pairs = F.create_map(*[F.lit(v) for kv in self.mapping.items() for v in kv])
        return F.coalesce(F.try_element_at(pairs, label), F.lit(self.default))


@dataclass(frozen=True)
class Col:
    """A column to group by or keep: its null default, output name and optional domain."""

    name: str
    default: Any = 0.0
    rename: str | None = None
    domain: DomainCol | None = None

    @property
    def out(self) -> str:
        return self.rename or self.name


@dataclass(frozen=True)
class AggCol(Col):
    """A column to aggregate."""

    method: str | Callable = "sum"


@dataclass(frozen=True)
class Consolidation:
    """A new column folded row by row from `inputs`, then aggregated."""

    name: str
    inputs: tuple[str, ...]
    fold: str | Callable = "sum"
    method: str | Callable = "sum"
    default: float | tuple[float, ...] = 0.0

    def defaults(self) -> dict[str, Any]:
        return _defaults(self.inputs, self.default)

    def of(self, columns: Mapping[str, Column]) -> Column:
        return fold(self.fold, [columns[i] for i in self.inputs])


@dataclass(frozen=True)
class Melt:
    """Several columns turned into a label column and a value column."""

    label: str
    value: str
    inputs: tuple[str, ...]
    method: str | Callable = "sum"
    default: float | tuple[float, ...] = 0.0
    domain: DomainCol | None = None

    def defaults(self) -> dict[str, Any]:
        return _defaults(self.inputs, self.default)


def _defaults(inputs: Sequence[str], default: Any) -> dict[str, Any]:
    if isinstance(inputs, str):
        raise ValueError("inputs must be several column names, not one string")
    if isinstance(default, (tuple, list)):
        return dict(zip(inputs, default))
    return {i: default for i in inputs}


@dataclass(frozen=True)
class FeatureSpec:
    """A layer of features: its name and id column."""

    name: str
    key: str
    dataset: str = ""


@dataclass(frozen=True)
class TableSpec:
    """A table joined to the layer named in its own name. `fields` None means all fields."""

    name: str
    key: str
    fields: tuple[str, ...] | None = None
    renames: Mapping[str, str] = field(default_factory=dict)


@dataclass(frozen=True)
class SummarySpec:
    """How the features of one layer are summarised to another layer, wide or (with `out`) as a long table."""

    target: FeatureSpec
    source: FeatureSpec
    group: tuple[Col, ...]
    aggs: tuple[AggCol, ...] = ()
    consolidate: tuple[Consolidation, ...] = ()
    melt: Melt | None = None
    out: str | None = None


@dataclass(frozen=True)
class CalcSpec:
    """A calculated field. `build` gets a function from column name to Column, plus one value per parameter list.

    With `params`, the spec stands for one field per combination; `{0}`, `{1}` in `name`
    take the combination's values.
    """

    tables: tuple[str, ...]
    name: str
    build: Callable[..., Column]
    params: tuple[tuple[str, ...], ...] = ()

    def expand(self) -> list[tuple[str, Callable[[Callable[[str], Column]], Column]]]:
        out = []
        for combo in itertools.product(*self.params):
            out.append((self.name.format(*combo), lambda col, combo=combo: self.build(col, *combo)))
        return out


@dataclass(frozen=True)
class DiffSpec:
    """A table whose years are compared on `index` columns."""

    table: str
    index: tuple[str, ...]
    key: str | None = None


def apply_calcs(df: DataFrame, table: str, specs: Sequence[CalcSpec]) -> DataFrame:
    """Add the calculated fields of `table` in order; later specs may use earlier fields."""
    for spec in specs:
        if table not in spec.tables:
            continue
        df = df.withColumns({name: build(F.col) for name, build in spec.expand()})
    return df
