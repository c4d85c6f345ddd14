"""Grain-safe aggregation over a tree of joins.

The answer is defined on the root source left-joined with every join path the keys and filters
use: after the filters, each group counts each row of a measure's home source once.  A plain join
and aggregate gives that only where no join fans the home out.  The plans here never build the
fanned-out rows.  Seen from the home,

* a side that can fan it out is first reduced to its distinct join key and group key values;
* a home below the root is first added up per join key, and joined to those distinct values;
* a filter on one side that rejects missing rows runs on that side before any of this;
* a key, filter or measure condition that reads one such side only is computed there, before the
  reduction, so that the side keeps the value and not the columns;
* only where a filter or key needs columns of both sides, so that a home row can meet one group
  several times, are rows deduplicated by the home's primary key.

Every reduction aggregates map-side before its shuffle, so a join key that holds a large share of
the rows arrives at the join as few rows.  Each plan yields contributions, rows of group keys and
partial sums; contributions of all homes are unioned and added up in one last aggregate.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, replace
from functools import cached_property, reduce
from itertools import takewhile

from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from semlayer.functions.measures import Atom
from semlayer.plans.sizes import shuffles_when_joined
from semlayer.sources.scope import Bound, Field, Path, bind, column_name, quoted
from semlayer.sources.source import Source


def closed(paths, root: Path) -> set[Path]:
    """The root, the paths, and everything between them."""
    return {root} | {path[:depth] for path in paths for depth in range(len(root), len(path) + 1)}


def common_path(paths) -> Path:
    """The longest path all of some paths start with; the root of none."""
    steps = zip(*paths) if paths else ()
    return tuple(step[0] for step in takewhile(lambda step: len(set(step)) == 1, steps))


@dataclass(frozen=True, eq=False)
class Part:
    """A joined piece of the tree: its frame, the paths in it, what was evaluated on it."""

    frame: DataFrame
    paths: frozenset[Path]
    keys: frozenset[str] = frozenset()
    filters: frozenset[int] = frozenset()
    repeats: bool = False  # a home row may meet one group more than once
    flagged: frozenset[int] = frozenset()  # filters computed as columns, not yet applied
    conditions: frozenset[int] = frozenset()  # atoms whose condition is a column
    aggregated: bool = False  # the frame ends in an aggregate
    single: bool = False  # one row for each join key

    def joined(self, other: Part, on: Sequence[tuple[str, str]], how: str, null_safe: bool = False) -> Part:
        frame = self.frame.join(other.frame, equal(on, null_safe), how).drop(*(right for _, right in on))
        return Part(
            frame,
            self.paths | other.paths,
            self.keys | other.keys,
            self.filters | other.filters,
            self.repeats or other.repeats,
            self.flagged | other.flagged,
            self.conditions | other.conditions,
        )


def equal(on: Sequence[tuple[str, str]], null_safe: bool = False) -> Column:
    pairs = ((quoted(a), quoted(b)) for a, b in on)
    return reduce(Column.__and__, (a.eqNullSafe(b) if null_safe else a == b for a, b in pairs))


class GrainPlan:
    def __init__(
        self,
        source: Source,
        keys: Mapping[str, Bound],
        filters: Sequence[Bound],
        atoms: Sequence[Atom],
        root: Path = (),
    ):
        self.source = source
        self.root = root
        self.keys = dict(keys)
        self.filters = list(filters)
        self.atoms = list(atoms)
        self.sum_types: dict[int, T.DataType] = {}

    @cached_property
    def early_filters(self) -> dict[Path, list[int]]:
        """Filters that may run below the join that attaches their side, by that side's path.

        A filter on one side of a join that fans out, which is not true for a missing row there,
        keeps no row without a match: the side can be filtered first and joined inner.
        """
        found: dict[Path, list[int]] = {}
        for index, bound in enumerate(self.filters):
            top = common_path(bound.paths)
            steps = closed(bound.paths, self.root) - {self.root}
            if len(top) > len(self.root) and any(self.kind(step) != "one" for step in steps):
                if self.rejects_missing(bound):
                    found.setdefault(top, []).append(index)
        return found

    @cached_property
    def required(self) -> set[Path]:
        """Joins that drop rows without a match, because an early filter would."""
        return closed(self.early_filters, self.root) - {self.root}

    def rejects_missing(self, bound: Bound) -> bool:
        """Whether a filter is not true where every field it reads is null."""
        types = {path: self.source.at(path).frame.schema for path in bound.paths}
        nulls = [
            F.lit(None).cast(types[path][name].dataType).alias(column_name(path, name))
            for path, name in bound.uses
        ]
        # A local relation of one row: the optimizer evaluates it, and no job runs.
        missing = self.source.frame.sparkSession.sql("SELECT * FROM VALUES (1)").select(*nulls)
        try:
            return not missing.filter(bound.column).collect()
        except PySparkException:  # it raises on nulls: leave it where the query put it
            return False

    # -- result ---------------------------------------------------------------------------

    def fans_out(self) -> bool:
        """Whether contributions are more than the plain rows of the root."""
        paths = closed(self.paths(), self.root) - {self.root}
        return any(self.kind(path) != "one" for path in paths) or any(
            atom.home != self.root for atom in self.atoms
        )

    def paths(self) -> set[Path]:
        return self.shape_paths().union(*(atom.paths for atom in self.atoms))

    def contributions(self) -> DataFrame:
        """Rows of key columns and partial sums ``atom_name(i)``; all groups occur in them."""
        everything = _HomePlan(self, self.root, list(range(len(self.atoms))))
        if not self.fans_out():
            return everything.one_row_contributions()
        if everything.sums_downward():
            return everything.downward_contributions()
        homes: dict[Path, list[int]] = {} if self.atoms else {self.root: []}
        for index, atom in enumerate(self.atoms):
            homes.setdefault(atom.home, []).append(index)
        if (side := self.home_beside_root(homes)) is not None:
            together = _HomePlan(self, side, homes[side] + homes[self.root]).contributions_with_root()
            if together is not None:
                return together
        frames = [_HomePlan(self, home, indexes).contributions() for home, indexes in homes.items()]
        union = frames[0]
        for frame in frames[1:]:
            union = union.unionByName(frame, allowMissingColumns=True)
        return union

    def home_beside_root(self, homes: Mapping[Path, list[int]]) -> Path | None:
        """The only home besides the root, if it is joined to it and no join repeats rows of the root."""
        others = [home for home in homes if home != self.root]
        joined = closed(self.paths(), self.root) - {self.root}
        if len(others) == 1 and self.root in homes and len(others[0]) == len(self.root) + 1:
            if all(self.kind(path) == "one" for path in joined):
                return others[0]
        return None

    def totals(self) -> list[Column]:
        """Aggregates that add contributions up."""
        return [F.sum(quoted(atom_name(i))).alias(atom_name(i)) for i in range(len(self.atoms))]

    def atom_columns(self) -> list[Column]:
        """The added-up atoms: counts without rows are 0, sums keep one type on every plan."""
        columns = []
        for index, atom in enumerate(self.atoms):
            total = quoted(atom_name(index))
            if atom.value is None:
                columns.append(F.coalesce(total, F.lit(0).cast("bigint")))
            else:
                columns.append(total.cast(self.sum_types[index]))
        return columns

    def aggregate(self) -> DataFrame:
        frame = self.contributions()
        keys = [quoted(key) for key in self.keys]
        if not self.atoms:
            return frame.select(*keys).distinct()
        return frame.groupBy(*keys).agg(*self.totals())

    def rows(self) -> DataFrame:
        """The keys of every joined row, not grouped."""
        home = _HomePlan(self, self.root, [])
        part = home.node(self.root)
        for path in sorted(home.edges, key=lambda path: (len(path), path)):
            part = home.attach(part, home.with_join_key(home.node(path), path), path)
        return home.evaluated(part).frame.select(*(quoted(key) for key in self.keys))

    def shape_paths(self) -> set[Path]:
        bounds = [*self.keys.values(), *self.filters]
        return set().union(*(bound.paths for bound in bounds)) if bounds else set()

    def kind(self, path: Path) -> str:
        return self.source.join_at(path).kind


def atom_name(index: int) -> str:
    return f"__atom{index}"


def condition_name(index: int) -> str:
    return f"__condition{index}"


def filter_name(index: int) -> str:
    return f"__filter{index}"


def _present(path: Path) -> str:
    return column_name(path, "__present")


def _sum_type(data_type: T.DataType) -> T.DataType:
    """What Spark's sum of a column of this type returns, whatever partial sums ran before."""
    if isinstance(data_type, T.DecimalType):
        return T.DecimalType(min(38, data_type.precision + 10), data_type.scale)
    if isinstance(data_type, (T.FloatType, T.DoubleType, T.StringType)):
        return T.DoubleType()
    if isinstance(data_type, (T.DayTimeIntervalType, T.YearMonthIntervalType)):
        return data_type
    return T.LongType()


class _HomePlan:
    """Contributions of the atoms that share one home."""

    def __init__(self, plan: GrainPlan, home: Path, indexes: list[int]):
        self.plan = plan
        self.source = plan.source
        self.home = home
        self.indexes = indexes
        atoms = [plan.atoms[i] for i in indexes]
        self.root = plan.root
        self.paths = closed(plan.shape_paths().union({home}, *(atom.paths for atom in atoms)), self.root)
        self.atom_bounds = [b for atom in atoms for b in (atom.value, atom.condition) if b]
        self.guard_home = home != self.root
        self._check_values(atoms)
        self.edges = {
            path: [
                (bind(self.source, here, path[:-1]), bind(self.source, there, path))
                for here, there in self.source.join_at(path).on
            ]
            for path in self.paths - {self.root}
        }
        self.home_key = [(home, column) for column in self.source.at(home).key]
        self.needed = self._needed_fields()
        self._large: dict[Path, bool] = {}

    def _check_values(self, atoms: list[Atom]) -> None:
        for atom in atoms:
            for path in atom.value.paths if atom.value else ():
                if not self.one_per_row(atom.home, path):
                    raise ValueError(
                        f"a measure of '{self.source.at(atom.home).name}' cannot sum fields of "
                        f"'{'.'.join(path) or self.source.name}', which has no single row per row "
                        "of it"
                    )

    def one_per_row(self, home: Path, path: Path) -> bool:
        """Whether each row of ``home`` has at most one row of ``path`` below it."""
        return path[: len(home)] == home and all(
            self.plan.kind(step) == "one" for step in closed([path], home) - {home}
        )

    def _needed_fields(self) -> dict[Path, set[str]]:
        bounds = [*self.plan.keys.values(), *self.plan.filters, *self.atom_bounds]
        bounds += [bound for pairs in self.edges.values() for pair in pairs for bound in pair]
        fields = {field for bound in bounds for field in bound.uses} | set(self.home_key)
        needed: dict[Path, set[str]] = {path: set() for path in self.paths}
        for path, name in fields:
            needed[path].add(name)
        return needed

    # -- building parts -------------------------------------------------------------------

    def node(self, path: Path) -> Part:
        columns = [
            quoted(name).alias(column_name(path, name)) for name in sorted(self.needed[path])
        ]
        if self.guard_home and path == self.home:
            columns.append(F.lit(True).alias(_present(path)))
        return Part(self.source.at(path).frame.select(*columns), frozenset({path}))

    def children(self, path: Path) -> list[Path]:
        return sorted(p for p in self.edges if p[:-1] == path)

    def below(self, path: Path, skip: Path | None = None) -> Part:
        """A node with everything used below it, except one child's side."""
        part = self.node(path)
        for child in self.children(path):
            if child != skip:
                side = self.below(child)
                side = self.with_join_key(side, child)
                if self.plan.kind(child) != "one":
                    side = self.reduced(self.computed(side), self.there_names(child))
                part = self.attach(part, side, child)
        return self.filtered_early(part, path)

    def computed(self, part: Part) -> Part:
        """A side with the keys, filters and conditions as columns that read no other side."""
        new: dict[str, Column] = {}
        keys, flagged, conditions = set(part.keys), set(part.flagged), set(part.conditions)
        for name, bound in self.plan.keys.items():
            if name not in keys and not bound.plain and bound.paths and bound.paths <= part.paths:
                new[name] = bound.column
                keys.add(name)
        for index, bound in enumerate(self.plan.filters):
            if index not in part.filters | flagged and bound.paths and bound.paths <= part.paths:
                new[filter_name(index)] = bound.column
                flagged.add(index)
        for index in self.indexes:
            condition = self.plan.atoms[index].condition
            if index not in conditions and condition is not None and condition.paths and condition.paths <= part.paths:
                new[condition_name(index)] = condition.column
                conditions.add(index)
        frame = part.frame.select("*", *(column.alias(name) for name, column in new.items())) if new else part.frame
        return replace(
            part, frame=frame, keys=frozenset(keys), flagged=frozenset(flagged), conditions=frozenset(conditions)
        )

    def computed_bounds(self, side: Part) -> dict[str, Bound]:
        """What a side holds as computed columns, by name."""
        found = {name: self.plan.keys[name] for name in side.keys if name in side.frame.columns}
        found |= {filter_name(i): self.plan.filters[i] for i in side.flagged}
        return found | {condition_name(i): self.plan.atoms[i].condition for i in side.conditions}

    def on_nulls(self, frame: DataFrame, bounds: Mapping[str, Bound], matched: Column | None = None) -> DataFrame:
        """The computed columns of rows without a match on their side: the expression on nulls."""
        fields = {field for bound in bounds.values() for field in bound.uses}
        absent = [
            F.lit(None).cast(self.source.at(path).frame.schema[name].dataType).alias(column_name(path, name))
            for path, name in sorted(fields)
            if column_name(path, name) not in frame.columns
        ]
        columns = [quoted(name) for name in frame.columns if name not in bounds]
        values = [
            (bound.column if matched is None else F.when(matched, quoted(name)).otherwise(bound.column)).alias(name)
            for name, bound in bounds.items()
        ]
        return frame.select("*", *absent).select(*columns, *values)

    def filtered_early(self, part: Part, path: Path) -> Part:
        ready = [
            index
            for index in self.plan.early_filters.get(path, ())
            if self.plan.filters[index].paths <= part.paths
        ]
        frame = part.frame
        for index in ready:
            frame = frame.filter(self.plan.filters[index].column)
        return replace(part, frame=frame, filters=part.filters | set(ready))

    def above(self, path: Path) -> Part:
        """Distinct join keys towards ``path`` and group keys of the tree without its side."""
        parent = path[:-1]
        part = self.below(parent, skip=path)
        if parent != self.root:
            part = self.attach(self.above(parent), self.with_join_key(part, parent), parent)
        part = self.with_parent_key(self.evaluated(part), path)
        unique = parent == self.root and self.one_each(part) and self.holds_key(path)
        return self.reduced(part, self.here_names(path), unique)

    def one_each(self, part: Part) -> bool:
        """Whether a part of the root has no joined side but single rows."""
        return all(self.plan.kind(path) == "one" for path in part.paths - {self.root})

    def holds_key(self, path: Path) -> bool:
        """Whether the parent's side of a join holds its primary key, so no two rows share it."""
        parent = self.source.at(path[:-1])
        plain = {here.plain for here, _ in self.edges[path]}
        return bool(parent.key) and {(path[:-1], column) for column in parent.key} <= plain

    def there_names(self, path: Path) -> list[str]:
        return [column_name(path, f"__there{i}") for i in range(len(self.edges[path]))]

    def here_names(self, path: Path) -> list[str]:
        """Names of the parent's join columns; a plain field keeps its own, and its partitioning."""
        return [
            column_name(*here.plain) if here.plain else column_name(path, f"__here{i}")
            for i, (here, _) in enumerate(self.edges[path])
        ]

    def with_join_key(self, part: Part, path: Path) -> Part:
        keys = [
            there.column.alias(name)
            for name, (_, there) in zip(self.there_names(path), self.edges[path])
        ]
        return replace(part, frame=part.frame.select("*", *keys))

    def with_parent_key(self, part: Part, path: Path) -> Part:
        computed = [
            here.column.alias(name)
            for name, (here, _) in zip(self.here_names(path), self.edges[path])
            if not here.plain
        ]
        return replace(part, frame=part.frame.select("*", *computed)) if computed else part

    def attach(self, part: Part, side: Part, path: Path) -> Part:
        """Join a side that has its join key to a part that holds the parent node."""
        part = self.with_parent_key(part, path)
        on = list(zip(self.here_names(path), self.there_names(path)))
        if path in self.plan.required:
            return part.joined(side, on, "inner")
        may_be_hot = self.plan.kind(path) != "one" and not side.single and len(side.frame.columns) > len(
            on + [i for i in self.indexes if atom_name(i) in side.frame.columns]
        )
        if may_be_hot and shuffles_when_joined(side.frame):
            return self.attach_splittable(part, side, on)
        bounds = self.computed_bounds(side)
        if not bounds:
            return part.joined(side, on, "left")
        matched = column_name(path, "__matched")
        side = replace(side, frame=side.frame.withColumn(matched, F.lit(True)))
        both = part.joined(side, on, "left")
        frame = self.on_nulls(both.frame, bounds, quoted(matched)).drop(quoted(matched))
        return replace(both, frame=frame)

    def attach_splittable(self, part: Part, side: Part, on: list[tuple[str, str]]) -> Part:
        """A left join whose right side may hold many rows of one key.

        Adaptive execution splits a hot key on either side of an inner join, but never on the right
        of a left join: so rows with a match are joined inner, and the rest are found apart.  Both
        joins compare null-safely with keys that are not null, or Spark would drop null keys from
        the part in one of them and read it twice; and the keys are counted from all columns of an
        aggregated side, or it would be aggregated again without the unused ones.
        """
        there = [name for _, name in on]
        known = reduce(Column.__and__, (quoted(name).isNotNull() for name in there))
        side = replace(side, frame=side.frame.filter(known))
        matched = part.joined(side, on, "inner", null_safe=True)
        if side.aggregated:
            # Unlike max or min, bit_xor depends on repeats: the optimizer keeps the aggregate below it.
            some = F.bit_xor(F.xxhash64(*map(quoted, side.frame.columns))).alias("__some")
            keys = side.frame.groupBy(*map(quoted, there)).agg(some).filter("__some IS NOT NULL").drop("__some")
        else:
            keys = side.frame.select(*map(quoted, there)).distinct()
        bounds = self.computed_bounds(side)
        missing = [
            F.lit(None).cast(field.dataType).alias(field.name)
            for field in side.frame.schema.fields
            if field.name not in there and field.name not in bounds
        ]
        lonely = part.frame.join(keys, equal(on, null_safe=True), "left_anti").select("*", *missing)
        if bounds:
            lonely = self.on_nulls(lonely, bounds)
        return replace(matched, frame=matched.frame.unionByName(lonely))

    # -- reducing -------------------------------------------------------------------------

    def pending(self, part: Part, with_atoms: bool = True) -> tuple[set[Field], bool]:
        """Fields later steps read from a part, and whether they may tell apart rows of one group."""
        fields: set[Field] = set()
        finer = False
        for name, bound in self.plan.keys.items():
            if name not in part.keys:
                read = {f for f in bound.uses if f[0] in part.paths}
                fields |= read
                finer = finer or (bool(read) and bound.plain is None)
        for index, bound in enumerate(self.plan.filters):
            if index not in part.filters | part.flagged:
                read = {f for f in bound.uses if f[0] in part.paths}
                fields |= read
                finer = finer or bool(read)
        for index in self.indexes if with_atoms else ():
            atom = self.plan.atoms[index]
            bounds = [atom.value, None if index in part.conditions else atom.condition]
            for bound in filter(None, bounds):
                read = {f for f in bound.uses if f[0] in part.paths}
                fields |= read
                finer = finer or bool(read)
        return fields, finer

    def reduced(self, part: Part, join_key: list[str], unique: bool = False) -> Part:
        fields, finer = self.pending(part)
        names = [*join_key, *sorted(part.keys), *map(filter_name, sorted(part.flagged))]
        names = list(dict.fromkeys([*names, *(column_name(*f) for f in sorted(fields))]))
        met = [condition_name(i) for i in sorted(part.conditions)]
        frame = part.frame.select(*map(quoted, [*names, *met]))
        if unique and not part.repeats:
            return replace(part, frame=frame)
        if met:
            frame = frame.groupBy(*map(quoted, names)).agg(*(F.max(quoted(name)).alias(name) for name in met))
        else:
            frame = frame.distinct()
        single = set(names) == set(join_key)
        return replace(part, frame=frame, repeats=part.repeats or finer, aggregated=True, single=single)

    def evaluated(self, part: Part) -> Part:
        """Apply the filters and compute the keys that a part holding the root can answer."""
        frame = part.frame
        filters, keys = set(part.filters), set(part.keys)
        for index, bound in enumerate(self.plan.filters):
            if index not in filters and bound.paths <= part.paths:
                flagged = index in part.flagged
                frame = frame.filter(quoted(filter_name(index)) if flagged else bound.column)
                frame = frame.drop(quoted(filter_name(index))) if flagged else frame
                filters.add(index)
        new = {
            name: bound.column
            for name, bound in self.plan.keys.items()
            if name not in keys and bound.paths <= part.paths
        }
        if new:
            frame = frame.select("*", *(column.alias(name) for name, column in new.items()))
        return replace(
            part,
            frame=frame,
            filters=frozenset(filters),
            keys=frozenset(keys | set(new)),
            flagged=part.flagged - filters,
        )

    # -- contributions --------------------------------------------------------------------

    def contribution_columns(self, part: Part, indexes: Sequence[int] | None = None) -> list[Column]:
        columns = []
        frame = part.frame
        indexes = self.indexes if indexes is None else indexes
        for index in indexes:
            atom = self.plan.atoms[index]
            value = F.lit(1).cast("bigint") if atom.value is None else atom.value.column
            guard = quoted(_present(self.home)) if self.guard_home and atom.home == self.home else None
            if atom.condition is not None:
                condition = quoted(condition_name(index)) if index in part.conditions else atom.condition.column
                guard = condition if guard is None else guard & condition
            if guard is not None:
                value = F.when(guard, value)
            columns.append(value.alias(atom_name(index)))
        if columns:
            for index, type_of in zip(indexes, frame.select(*columns).schema.fields):
                self.plan.sum_types[index] = _sum_type(type_of.dataType)
        return columns

    def partial_sums(self, frame: DataFrame, by: Sequence[str]) -> DataFrame:
        """Add the contributions of a frame up by some columns; the sums keep their names."""
        names = [name for name in map(atom_name, self.indexes) if name in frame.columns]
        if not names:
            return frame.select(*map(quoted, by)).distinct()
        sums = [F.sum(quoted(name)).alias(name) for name in names]
        return frame.groupBy(*map(quoted, by)).agg(*sums)

    def contributions(self) -> DataFrame:
        if self.home == self.root:
            if all(self.plan.kind(path) == "one" for path in self.edges):
                return self.one_row_contributions()
            return self.finished(self.evaluated(self.below(self.root)))
        outer = self.above(self.home)
        inner = self.below(self.home)
        all_applied = len(outer.filters | inner.filters) == len(self.plan.filters)
        if not outer.repeats and not inner.repeats and all_applied:
            return self.summed_before_join(outer, inner)
        inner = self.with_join_key(inner, self.home)
        return self.finished(self.evaluated(self.attach(outer, inner, self.home)))

    def finished(self, part: Part) -> DataFrame:
        """Contributions of a complete part; a home row that repeats within a group counts once."""
        keys = [quoted(key) for key in self.plan.keys]
        sums = self.contribution_columns(part)
        if not part.repeats:
            return part.frame.select(*keys, *sums)
        if not self.indexes:
            return part.frame.select(*keys)
        if not self.home_key:
            raise ValueError(
                f"this query joins rows that repeat rows of '{self.source.at(self.home).name}', "
                "which needs a primary key to count each of them once"
            )
        # As a struct the key is not what the join is dealt by: each task drops its own repeats and
        # the rest is dealt anew, so that adaptive execution may split a hot key in the join.
        row = F.struct(*(quoted(column_name(*field)).alias(f"key{i}") for i, field in enumerate(self.home_key)))
        names = [atom_name(i) for i in self.indexes]
        once = part.frame.select(*keys, row.alias("__row"), *sums).groupBy(*keys, "__row")
        return once.agg(*(F.max(quoted(name)).alias(name) for name in names)).select(*keys, *names)

    def summed_before_join(self, outer: Part, inner: Part) -> DataFrame:
        """Sum the home per join key, then join the sums to the distinct outer rows."""
        inner = replace(inner, frame=inner.frame.select("*", *self.contribution_columns(inner)))
        side = self.summed_side(inner, self.home)
        return self.selected(self.evaluated(self.attach(outer, side, self.home)))

    def summed_side(self, part: Part, path: Path) -> Part:
        """Contributions of a side, added up per join key and the group keys found there."""
        fields, _ = self.pending(part, with_atoms=False)
        part = self.with_join_key(part, path)
        names = [*self.there_names(path), *sorted(part.keys), *map(filter_name, sorted(part.flagged))]
        names = list(dict.fromkeys([*names, *(column_name(*f) for f in sorted(fields))]))
        frame = self.partial_sums(part.frame, names)
        return replace(part, frame=frame, conditions=frozenset(), aggregated=True)

    def contributions_with_root(self) -> DataFrame | None:
        """Root and home from one read: the root's sums for each group and join key, then the home's row.

        A home row meets a group once for each of these, as `join_one` has one row a key.  None where
        something reads the home and the root together.
        """
        part = self.evaluated(self.below(self.root, skip=self.home))
        of_root = [i for i in self.indexes if self.plan.atoms[i].home == self.root]
        if self.pending(part, with_atoms=False)[0]:
            return None
        if not all(self.plan.atoms[i].paths <= part.paths for i in of_root):
            return None
        part = self.with_parent_key(part, self.home)
        part = replace(part, frame=part.frame.select("*", *self.contribution_columns(part, of_root)))
        by = dict.fromkeys([*self.here_names(self.home), *sorted(part.keys)])
        part = replace(part, frame=self.partial_sums(part.frame, list(by)))
        part = self.evaluated(self.attach(part, self.with_join_key(self.below(self.home), self.home), self.home))
        own = [i for i in self.indexes if i not in of_root]
        columns = self.contribution_columns(part, own)
        return part.frame.select(*map(quoted, self.plan.keys), *(quoted(atom_name(i)) for i in of_root), *columns)

    def selected(self, part: Part) -> DataFrame:
        return part.frame.select(
            *map(quoted, self.plan.keys), *(quoted(atom_name(i)) for i in self.indexes)
        )

    def sums_downward(self) -> bool:
        """Whether every home can be summed per join key on the way up to the root, in one pass.

        True where homes hang below the root by one-to-many joins from a primary key, and nothing
        tells rows of one home apart across a join that fans it out.
        """
        plan = self.plan
        early = {index for indexes in plan.early_filters.values() for index in indexes}
        late = [bound for index, bound in enumerate(plan.filters) if index not in early]
        if any(
            not self.one_per_row(self.root, path)
            for bound in [*late, *(b for b in plan.keys.values() if not b.plain)]
            for path in bound.paths
        ):
            return False
        for atom in plan.atoms:
            if any(
                plan.kind(step) != "many" or not self.holds_key(step)
                for step in closed([atom.home], self.root) - {self.root}
            ):
                return False
            if atom.condition is not None and any(
                not self.one_per_row(atom.home, path) for path in atom.condition.paths
            ):
                return False
        return True

    def downward_contributions(self) -> DataFrame:
        return self.selected(self.evaluated(self.summed_tree(self.root)))

    def summed_tree(self, path: Path) -> Part:
        part = self.node(path)
        for child in self.children(path):
            if self.plan.kind(child) == "one":
                side = self.with_join_key(self.below(child), child)
            else:
                side = self.summed_side(self.summed_tree(child), child)
            part = self.attach(part, side, child)
        part = self.filtered_early(part, path)
        own = [index for index in self.indexes if self.plan.atoms[index].home == path]
        columns = self.contribution_columns(part, own)
        return replace(part, frame=part.frame.select("*", *columns))

    def one_row_contributions(self) -> DataFrame:
        """No join fans out: join small sides first, and add up before a join that shuffles.

        The early sum runs where the group keys all lie beyond one large join, so that it is
        partitioned by that join's key like the join itself and adds no shuffle.
        """
        part = self.node(self.root)
        waiting = self.children(self.root)
        summed = False
        while True:
            for path in [p for p in waiting if not self.large(p)]:
                waiting.remove(path)
                part = self.attach(part, self.with_join_key(self.node(path), path), path)
                waiting += self.children(path)
            if any(not self.large(p) for p in waiting):
                continue
            part = self.evaluated(part)
            if not summed and all(b.paths <= part.paths for b in self.atom_bounds):
                sums = self.contribution_columns(part)
                part = replace(part, frame=part.frame.select("*", *sums))
                summed = True
            if not waiting:
                break
            path = waiting.pop(0)
            if summed and not waiting and not part.keys and not self.pending(part, False)[0]:
                part = self.with_parent_key(part, path)
                part = replace(part, frame=self.partial_sums(part.frame, self.here_names(path)))
            part = self.attach(part, self.with_join_key(self.node(path), path), path)
            waiting += self.children(path)
        return self.selected(part)

    def large(self, path: Path) -> bool:
        if path not in self._large:
            columns = sorted(self.needed[path])
            frame = self.source.at(path).frame.select(*map(quoted, columns))
            self._large[path] = shuffles_when_joined(frame)
        return self._large[path]
