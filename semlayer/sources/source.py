"""The Source: a lazy DataFrame with a primary key, joins, dimensions, measures and views."""

from __future__ import annotations

from collections.abc import Iterator, Mapping
from dataclasses import dataclass, field, replace
from functools import cached_property

from pyspark.sql import DataFrame

from semlayer.functions.measures import Measure
from semlayer.plans.view import View
from semlayer.sources.scope import Expression, Path, bind


@dataclass(frozen=True, eq=False)
class Join:
    name: str
    source: Source
    kind: str  # "one", "many" or "cross"
    on: tuple[tuple[str, str], ...]  # (field on the declaring side, field on the joined side)


@dataclass(frozen=True, eq=False)
class Source:
    """Immutable: each declaration returns a new Source over the same frame."""

    name: str
    frame: DataFrame
    key: tuple[str, ...] = ()
    joins: Mapping[str, Join] = field(default_factory=dict)
    dimensions: Mapping[str, Expression] = field(default_factory=dict)
    measures: Mapping[str, Measure] = field(default_factory=dict)
    views: Mapping[str, View] = field(default_factory=dict)
    base: Source | None = None

    @cached_property
    def columns(self) -> frozenset[str]:
        return frozenset(self.frame.columns)

    # -- declarations ---------------------------------------------------------------------

    def primary_key(self, *columns: str) -> Source:
        missing = [c for c in columns if c not in self.columns]
        if missing or not columns:
            raise ValueError(f"primary key of '{self.name}' names missing columns {missing}")
        return replace(self, key=tuple(columns))

    def join_one(self, other: Source, on: Mapping[str, str], name: str | None = None) -> Source:
        """Many rows here to at most one row there, matched by equal fields ``{here: there}``."""
        return self._joined(other, "one", on, name)

    def join_many(self, other: Source, on: Mapping[str, str], name: str | None = None) -> Source:
        """Each row here to any number of rows there, matched by equal fields ``{here: there}``."""
        return self._joined(other, "many", on, name)

    def join_cross(self, other: Source, name: str | None = None) -> Source:
        """Each row here to every row there.  Aggregates only; see ``plans.aggregate``."""
        return self._joined(other, "cross", {}, name)

    def _joined(self, other: Source, kind: str, on: Mapping[str, str], name: str | None) -> Source:
        name = name or other.name
        self._check_new(name)
        if any(column.startswith(f"{name}.") for column in self.columns):
            raise ValueError(f"columns of '{self.name}' collide with fields of join '{name}'")
        if kind != "cross" and not on:
            raise ValueError(f"join '{name}' needs at least one pair of equal fields")
        for here, there in on.items():
            for side, member in ((self, here), (other, there)):
                if bind(side, member).paths - {()}:
                    raise ValueError(f"join field '{member}' must belong to '{side.name}' itself")
        join = Join(name, other, kind, tuple(on.items()))
        return replace(self, joins={**self.joins, name: join})

    def dimension(self, **definitions: Expression) -> Source:
        """Named row expressions; each may use the ones declared before it."""
        source = self
        for name, expression in definitions.items():
            source._check_new(name)
            bind(source, expression)
            source = replace(source, dimensions={**source.dimensions, name: expression})
        return source

    def measure(self, **definitions: Measure) -> Source:
        """Named aggregates; each may use the ones declared before it."""
        source = self
        for name, measure in definitions.items():
            source._check_new(name)
            measure.validate(source)
            source = replace(source, measures={**source.measures, name: measure})
        return source

    def view(self, **definitions: View) -> Source:
        source = self
        for name, view in definitions.items():
            if name in source.views:
                raise ValueError(f"'{source.name}' already has a view '{name}'")
            source = replace(source, views={**source.views, name: view})
        return source

    def extend(self, name: str) -> Source:
        """A child source over the same frame that inherits every member."""
        return replace(self, name=name, base=self)

    def _check_new(self, name: str) -> None:
        for kind, members in (
            ("column", self.columns),
            ("dimension", self.dimensions),
            ("measure", self.measures),
            ("join", self.joins),
        ):
            if name in members:
                raise ValueError(f"'{self.name}' already has a {kind} '{name}'")

    # -- lookups --------------------------------------------------------------------------

    def at(self, path: Path) -> Source:
        source = self
        for part in path:
            if part not in source.joins:
                raise AttributeError(f"source '{source.name}' has no join '{part}'")
            source = source.joins[part].source
        return source

    def join_at(self, path: Path) -> Join:
        return self.at(path[:-1]).joins[path[-1]]

    def upstream(self) -> Iterator[tuple[str, str]]:
        """(source, source it is built from) for bases and joins, transitively, each once."""
        done: set[str] = set()
        todo = [self]
        while todo:
            source = todo.pop()
            if source.name in done:
                continue
            done.add(source.name)
            parents = [j.source for j in source.joins.values()]
            if source.base is not None:
                parents.append(source.base)
            for parent in parents:
                yield source.name, parent.name
                todo.append(parent)

    # -- queries --------------------------------------------------------------------------

    def query(self, *stages: View | str) -> DataFrame:
        """Run one view (declared or inline), or several stages each reading the one before."""
        from semlayer.plans.compose import run_view

        if not stages:
            raise ValueError("query needs at least one view")
        source = self
        for position, stage in enumerate(stages):
            view = source.resolve_view(stage)
            frame = run_view(source, view)
            source = Source(f"{self.name}#{position + 1}", frame)
        return source.frame

    def nest_rows(self, view: View | str, nest: str, rank: str | None = None) -> DataFrame:
        """The rows of one nest, flat: outer keys, inner keys and measures, no array built."""
        from semlayer.plans.compose import flat_nest

        return flat_nest(self, self.resolve_view(view), nest, rank)

    def resolve_view(self, view: View | str) -> View:
        if isinstance(view, View):
            return view
        if view not in self.views:
            raise KeyError(f"'{self.name}' has no view '{view}'; it has {sorted(self.views)}")
        return self.views[view]
