"""Grouped aggregates by output name, and joins that pair every row with every row."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from semlayer.functions.measures import Atom, AtomTable, Measure
from semlayer.plans.grain import GrainPlan, closed
from semlayer.sources.scope import Bound, Path, quoted
from semlayer.sources.source import Source


def total_name(index: int) -> str:
    return f"__total{index}"


def aggregate(
    source: Source,
    keys: Mapping[str, Bound],
    filters: Sequence[Bound],
    measures: Mapping[str, Measure],
) -> DataFrame:
    """One row per group with its keys and measures; without keys exactly one row."""
    table = AtomTable(source)
    finals = {name: measure.resolve(table, (), ()) for name, measure in measures.items()}
    inner = {f"__key{i}": bound for i, bound in enumerate(keys.values())}
    frame = totals(source, inner, filters, dict(enumerate(table.atoms)))
    columns = [quoted(total_name(i)) for i in range(len(table.atoms))]
    return frame.select(
        *(quoted(internal).alias(name) for internal, name in zip(inner, keys)),
        *(final(columns).alias(name) for name, final in finals.items()),
    )


def totals(
    source: Source,
    keys: Mapping[str, Bound],
    filters: Sequence[Bound],
    atoms: Mapping[int, Atom],
    root: Path = (),
) -> DataFrame:
    """Key columns and ``total_name(i)`` per atom.

    The two sides of a ``join_cross`` are aggregated apart and their groups are paired.  Each side's rows count once in each group, if any row of the other side passes the filters on it;
    without filters on the other side they also count where that side has no rows at all.
    """
    plan = GrainPlan(source, keys, filters, list(atoms.values()), root)
    crossed = cross_join_of(plan)
    if crossed is not None:
        return _paired(source, keys, filters, atoms, root, crossed)
    frame = plan.aggregate()
    return frame.select(
        *(quoted(key) for key in keys),
        *(column.alias(total_name(i)) for i, column in zip(atoms, plan.atom_columns())),
    )


def cross_join_of(plan: GrainPlan) -> Path | None:
    paths = closed(plan.paths(), plan.root) - {plan.root}
    crossed = sorted(path for path in paths if plan.kind(path) == "cross")
    if crossed and len(crossed[0]) != len(plan.root) + 1:
        raise ValueError(f"join_cross '{'.'.join(crossed[0])}' can only be used from its own source")
    return crossed[0] if crossed else None


def _paired(source, keys, filters, atoms, root, crossed) -> DataFrame:
    def beyond(paths) -> bool:
        sides = {path[: len(crossed)] == crossed for path in paths}
        if len(sides) > 1:
            raise ValueError(
                f"an expression over both sides of join_cross '{crossed[-1]}' would need every "
                "pair of rows; use a join on equal fields"
            )
        return True in sides

    far_keys = {name: b for name, b in keys.items() if beyond(b.paths)}
    far_filters = [b for b in filters if beyond(b.paths)]
    far_atoms = {i: atom for i, atom in atoms.items() if beyond(atom.paths)}
    near_keys = {name: b for name, b in keys.items() if name not in far_keys}
    near_filters = [b for b in filters if b not in far_filters]
    near_atoms = {i: atom for i, atom in atoms.items() if i not in far_atoms}
    near = totals(source, near_keys, near_filters, near_atoms, root)
    far = totals(source, far_keys, far_filters, far_atoms, crossed)
    passing = _passing(source, near_filters, root, "near").crossJoin(_passing(source, far_filters, crossed, "far"))
    # a row of this side stays where the other has no row, but not where none passes the filters on it
    if far_keys:
        far = passing.where("near").join(far, F.lit(True), "inner" if far_filters else "left")
    else:
        far = passing.crossJoin(far) if far_atoms else passing
    paired = near.crossJoin(far) if near_keys or near_atoms else far
    far_ok = F.col("far") if far_filters else F.lit(True)
    if near_keys:
        paired = paired.where(far_ok)
    columns = [quoted(key) for key in keys]
    for i, atom in sorted(atoms.items()):
        joined = far_ok if i in near_atoms else F.col("near")
        total = F.when(joined, quoted(total_name(i)))
        none = F.lit(0).cast("bigint") if atom.value is None else F.lit(None)
        columns.append(F.coalesce(total, none).alias(total_name(i)))
    return paired.select(*columns)


def _passing(source: Source, filters: Sequence[Bound], root: Path, name: str) -> DataFrame:
    """One row: whether any row of this side passes the filters on it."""
    table = AtomTable(source)
    table.add(root, None, ())
    counted = totals(source, {}, filters, {0: table.atoms[0]}, root)
    return counted.select((quoted(total_name(0)) > 0).alias(name))
