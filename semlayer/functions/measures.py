"""Aggregate expressions: counts, sums, filtered forms and combinations of them.

A measure belongs to the source it is declared on (its home) and counts each row of that source
once per output group, whatever else the query joins.  Every measure breaks down into atoms, the
counts and sums that can be added up from partial results; divisions happen after the last sum.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field, replace
from typing import TYPE_CHECKING, Union

from pyspark.sql import Column
from pyspark.sql import functions as F

from semlayer.sources.scope import Bound, Expression, Path, bind

if TYPE_CHECKING:
    from semlayer.sources.source import Source

Condition = tuple[Path, Expression]


def divide(numerator: Column, denominator: Column) -> Column:
    """Division that is null, not an error, where the denominator is zero."""
    return F.try_divide(numerator, denominator)


@dataclass(frozen=True, eq=False)
class Atom:
    """One additive aggregate: the rows of ``home`` that meet ``condition``, counted or summed."""

    home: Path
    value: Bound | None  # None counts rows
    condition: Bound | None

    @property
    def paths(self) -> frozenset[Path]:
        bounds = [b for b in (self.value, self.condition) if b is not None]
        return frozenset({self.home}).union(*(b.paths for b in bounds))


@dataclass(eq=False)
class AtomTable:
    """Collects the distinct atoms of one query, so shared measures are aggregated once."""

    source: Source
    atoms: list[Atom] = field(default_factory=list)
    _index: dict = field(default_factory=dict)

    def add(self, home: Path, expression: Expression | None, conditions: tuple[Condition, ...]) -> int:
        key = (home, expression, conditions)
        if key not in self._index:
            value = None if expression is None else bind(self.source, expression, home)
            condition = None
            for path, predicate in conditions:
                bound = bind(self.source, predicate, path)
                condition = bound if condition is None else Bound(
                    condition.column & bound.column, condition.uses | bound.uses
                )
            self._index[key] = len(self.atoms)
            self.atoms.append(Atom(home, value, condition))
        return self._index[key]


Final = Callable[[list[Column]], Column]  # final atom columns -> the measure's column


class Measure:
    def where(self, predicate: Expression) -> Measure:
        """The same measure over the rows that meet a predicate."""
        return Filtered(self, predicate)

    def resolve(self, table: AtomTable, home: Path, conditions: tuple[Condition, ...]) -> Final:
        raise NotImplementedError

    def validate(self, source: Source) -> None:
        self.resolve(AtomTable(source), (), ())


@dataclass(frozen=True)
class Count(Measure):
    def resolve(self, table, home, conditions):
        index = table.add(home, None, conditions)
        return lambda atoms: atoms[index]


@dataclass(frozen=True)
class Sum(Measure):
    expression: Expression

    def resolve(self, table, home, conditions):
        index = table.add(home, self.expression, conditions)
        return lambda atoms: atoms[index]


@dataclass(frozen=True)
class Filtered(Measure):
    measure: Measure
    predicate: Expression

    def resolve(self, table, home, conditions):
        return self.measure.resolve(table, home, (*conditions, (home, self.predicate)))


@dataclass(frozen=True)
class Named(Measure):
    """A measure declared on the source, or on a joined one (``"orders.total_revenue"``)."""

    name: str

    def resolve(self, table, home, conditions):
        *joins, name = self.name.split(".")
        owner = (*home, *joins)
        source = table.source.at(owner)
        if name not in source.measures:
            raise AttributeError(
                f"source '{source.name}' has no measure '{name}'; it has {sorted(source.measures)}"
            )
        return source.measures[name].resolve(table, owner, conditions)


@dataclass(frozen=True)
class Derived(Measure):
    """A function of other measures, applied after they are fully aggregated."""

    parts: tuple[Measure, ...]
    combine: Callable[..., Column]

    def resolve(self, table, home, conditions):
        finals = [part.resolve(table, home, conditions) for part in self.parts]
        return lambda atoms: self.combine(*(final(atoms) for final in finals))


@dataclass(frozen=True)
class OfJoin(Measure):
    """An inline measure whose home is a joined source."""

    path: Path
    measure: Measure

    def resolve(self, table, home, conditions):
        return self.measure.resolve(table, (*home, *self.path), conditions)


def as_measure(measure: Union[str, Measure]) -> Measure:
    if isinstance(measure, Measure):
        return measure
    if isinstance(measure, str):
        return Named(measure)
    raise TypeError(f"expected a measure or the name of one, got {measure!r}")


def count(of: str | None = None) -> Measure:
    """Rows of this source, or of the joined source at path ``of``."""
    return Count() if of is None else OfJoin(tuple(of.split(".")), Count())


def sum_of(expression: Expression, of: str | None = None) -> Measure:
    """Sum of a row expression over this source, or over the joined source at path ``of``."""
    return Sum(expression) if of is None else OfJoin(tuple(of.split(".")), Sum(expression))


def derived(combine: Callable[..., Column], *parts: Union[str, Measure]) -> Measure:
    return Derived(tuple(as_measure(part) for part in parts), combine)


def ratio(numerator: Union[str, Measure], denominator: Union[str, Measure]) -> Measure:
    return derived(divide, numerator, denominator)
