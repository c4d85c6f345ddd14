"""The View: what to select or group, aggregate, nest, order and keep."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field, replace
from typing import Union

from semlayer.functions.measures import Measure, as_measure
from semlayer.sources.scope import Expression


def _named(kind: str, known: Mapping, names: tuple[str, ...], definitions: Mapping) -> dict:
    """Output name to definition; a path is named by its last part."""
    named = dict(known)
    for name, definition in [*((n.split(".")[-1], n) for n in names), *definitions.items()]:
        if name in named:
            raise ValueError(f"{kind} '{name}' is used twice; give one of them another name")
        named[name] = definition
    return named


@dataclass(frozen=True, eq=False)
class View:
    """Immutable: each method returns a new View."""

    columns: Mapping[str, Expression] = field(default_factory=dict)
    all_columns: bool = False
    keys: Mapping[str, Expression] = field(default_factory=dict)
    measures: Mapping[str, Measure] = field(default_factory=dict)
    filters: tuple[Expression, ...] = ()
    nests: Mapping[str, Union[str, "View"]] = field(default_factory=dict)
    order: tuple[str, ...] = ()
    row_limit: int | None = None

    def select(self, *names: str, **definitions: Expression) -> View:
        """Row-level output; ``"*"`` stands for the base columns and dimensions."""
        everything = self.all_columns or "*" in names
        names = tuple(name for name in names if name != "*")
        columns = _named("column", self.columns, names, definitions)
        return replace(self, columns=columns, all_columns=everything)

    def group_by(self, *names: str, **definitions: Expression) -> View:
        return replace(self, keys=_named("key", self.keys, names, definitions))

    def aggregate(self, *names: str, **definitions: Union[str, Measure]) -> View:
        named = _named("measure", self.measures, names, definitions)
        return replace(self, measures={name: as_measure(m) for name, m in named.items()})

    def where(self, *predicates: Expression) -> View:
        return replace(self, filters=(*self.filters, *predicates))

    def nest(self, *names: str, **views: Union[str, "View"]) -> View:
        return replace(self, nests=_named("nest", self.nests, names, views))

    def order_by(self, *names: str) -> View:
        """Output columns; a leading minus sorts descending.  Nulls always come last."""
        return replace(self, order=(*self.order, *names))

    def limit(self, rows: int) -> View:
        if rows < 0:
            raise ValueError("limit must not be negative")
        return replace(self, row_limit=rows)

    top = limit

    def __post_init__(self) -> None:
        outputs = self.columns_out
        twice = sorted({name for name in outputs if outputs.count(name) > 1})
        if twice:
            raise ValueError(f"output names {twice} are used twice")
        if (self.columns or self.all_columns) and (self.keys or self.measures or self.nests):
            raise ValueError("a view either selects rows or groups them")

    @property
    def columns_out(self) -> tuple[str, ...]:
        """Names of the output columns, without those ``"*"`` stands for."""
        return (*self.columns, *self.keys, *self.measures, *self.nests)

    @property
    def grouped(self) -> bool:
        return bool(self.keys or self.measures or self.nests)

    def ordering(self) -> list[tuple[str, bool]]:
        """(output column, descending): stated order, or the first measure from the top; then keys."""
        stated = [(n[1:], True) if n.startswith("-") else (n, False) for n in self.order]
        if not stated and self.measures:
            stated = [(next(iter(self.measures)), True)]
        named = {name for name, _ in stated}
        return [*stated, *((key, False) for key in self.keys if key not in named)]


def view() -> View:
    return View()
