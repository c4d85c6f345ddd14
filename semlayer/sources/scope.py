"""Field access for expressions.

Every row expression in a model is a function of a ``Scope`` (``lambda o: o.price * o.quantity``)
or a dotted field path (``"customers.name"``).  Reading a field through the scope returns an
ordinary Column and notes which base column of which join path was touched, so a plan can read
those columns and build those joins, and no others.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from typing import TYPE_CHECKING, Union

from pyspark.sql import Column
from pyspark.sql import functions as F

if TYPE_CHECKING:
    from semlayer.sources.source import Source

Path = tuple[str, ...]
Field = tuple[Path, str]
Expression = Union[str, Callable[["Scope"], Column]]


def column_name(path: Path, field: str) -> str:
    """Name a base column carries inside a plan, unique per join path."""
    return ".".join((*path, field))


def quoted(name: str) -> Column:
    """Reference a column by its exact name, dots included."""
    return F.col("`" + name.replace("`", "``") + "`")


@dataclass(frozen=True, eq=False)
class Bound:
    """A Column over plan column names, and the base fields it reads."""

    column: Column
    uses: frozenset[Field]
    plain: Field | None = None  # set when the column is exactly one base field

    @property
    def paths(self) -> frozenset[Path]:
        return frozenset(path for path, _ in self.uses)


class Scope:
    """Attribute access to the fields, dimensions and joins of a source."""

    __slots__ = ("_source", "_path", "_seen")

    def __init__(self, source: Source, path: Path = (), seen: dict[Field, Column] | None = None):
        self._source = source
        self._path = path
        self._seen = {} if seen is None else seen

    def __getattr__(self, name: str):
        if name.startswith("__"):
            raise AttributeError(name)
        source = self._source
        if name in source.dimensions:
            return evaluate(source.dimensions[name], self)
        if name in source.joins:
            return Scope(source.joins[name].source, (*self._path, name), self._seen)
        if name in source.columns:
            field = (self._path, name)
            if field not in self._seen:
                self._seen[field] = quoted(column_name(self._path, name))
            return self._seen[field]
        known = sorted({*source.columns, *source.dimensions, *source.joins})
        raise AttributeError(f"source '{source.name}' has no field '{name}'; it has {known}")

    def __getitem__(self, path: str):
        if path in self._source.columns:
            return getattr(self, path)
        target = self
        for part in path.split("."):
            if not isinstance(target, Scope):
                raise AttributeError(f"'{path}' goes through a field that is not a join")
            target = getattr(target, part)
        return target


def evaluate(expression: Expression, scope: Scope) -> Column:
    if isinstance(expression, str):
        value = scope[expression]
    elif callable(expression) and not isinstance(expression, Column):
        value = expression(scope)
    else:
        raise TypeError(
            f"expected a field path or a function of the scope, got {expression!r}; "
            "write a constant as lambda s: F.lit(value)"
        )
    if isinstance(value, Scope):
        raise TypeError(f"{expression!r} names a join, not a field")
    return value


def bind(source: Source, expression: Expression, path: Path = ()) -> Bound:
    """Evaluate an expression written against the source found at ``path`` below ``source``."""
    seen: dict[Field, Column] = {}
    scope = Scope(source, (), seen)
    for part in path:
        scope = getattr(scope, part)
    column = evaluate(expression, scope)
    plain = next((field for field, seen_column in seen.items() if seen_column is column), None)
    return Bound(column, frozenset(seen), plain)
