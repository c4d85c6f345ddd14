"""Views to DataFrames: row selections, groups, nests, order and limits."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from semlayer.functions.measures import AtomTable
from semlayer.plans.aggregate import aggregate, cross_join_of
from semlayer.plans.grain import GrainPlan, atom_name
from semlayer.plans.view import View
from semlayer.sources.scope import Bound, bind, quoted
from semlayer.sources.source import Source

Keys = Mapping[str, Bound]


def run_view(source: Source, view: View) -> DataFrame:
    frame = grouped(source, view, {}, ()) if view.grouped else selected(source, view)
    return ordered(frame, view)


def bound_all(source: Source, expressions: Mapping[str, object]) -> dict[str, Bound]:
    return {name: bind(source, expression) for name, expression in expressions.items()}


def selected(source: Source, view: View) -> DataFrame:
    """Row-level output.  Joined rows are kept as they are; a view that names nothing keeps all."""
    columns = dict(view.columns)
    if view.all_columns or not columns:
        own = [*source.frame.columns, *source.dimensions]
        columns = {**{name: name for name in own}, **columns}
    bounds = bound_all(source, columns)
    plan = GrainPlan(
        source,
        {f"__key{i}": bound for i, bound in enumerate(bounds.values())},
        [bind(source, predicate) for predicate in view.filters],
        [],
    )
    if cross_join_of(plan) is not None:
        raise ValueError("join_cross can be aggregated, not selected: it would emit every pair")
    return plan.rows().toDF(*bounds)


def sort_terms(terms: Sequence[tuple[str, bool]]) -> list[Column]:
    return [
        quoted(name).desc_nulls_last() if descending else quoted(name).asc_nulls_last()
        for name, descending in terms
    ]


def ordered(frame: DataFrame, view: View) -> DataFrame:
    if view.row_limit is None and not view.order:
        return frame
    terms = view.ordering()
    if view.order and not view.grouped:  # the rest settles ties, and spreads them over tasks
        named = {name for name, _ in terms}
        terms += [
            (field.name, False)
            for field in frame.schema.fields
            if field.name not in named and isinstance(field.dataType, T.AtomicType)
        ]
    if terms:
        frame = frame.orderBy(*sort_terms(terms))
    return frame if view.row_limit is None else frame.limit(view.row_limit)


# -- groups and nests -------------------------------------------------------------------------


def grouped(source: Source, view: View, outer: Keys, filters: Sequence[Bound]) -> DataFrame:
    """Columns of ``outer``, then the view's keys, measures and nests as sorted arrays."""
    keys = {**outer, **bound_all(source, view.keys)}
    filters = [*filters, *(bind(source, predicate) for predicate in view.filters)]
    nests = {name: source.resolve_view(nest) for name, nest in view.nests.items()}
    if not nests:
        return aggregate(source, keys, filters, view.measures)

    flat = {name: nest for name, nest in nests.items() if nest.grouped and not nest.nests}
    if len(flat) == 1 and not keys and not view.measures:  # a read to share with nothing
        flat = {name: nest for name, nest in flat.items() if nest.row_limit is None}
    base, together = one_pass(source, view, keys, filters, flat) if flat else (None, ())
    parts = [base] if base is not None else []
    if base is None and (keys or view.measures):
        parts.append(aggregate(source, keys, filters, view.measures))
    for name, nest in nests.items():
        if name not in together:
            hidden = {f"__outer{i}": bound for i, bound in enumerate(keys.values())}
            rows = nested_rows(source, nest, hidden, filters)
            parts.append(gathered(rows, nest, name, list(hidden)).toDF(*keys, name))

    outputs = [*view.measures, *nests]
    if len(parts) == 1:
        return parts[0].select(*map(quoted, [*keys, *outputs]))
    union = parts[0]
    for part in parts[1:]:
        union = union.unionByName(part, allowMissingColumns=True)
    merged = union.groupBy(*map(quoted, keys)).agg(
        *(F.first(quoted(name), ignorenulls=True).alias(name) for name in outputs)
    )
    return merged.select(
        *map(quoted, keys),
        *(quoted(name) for name in view.measures),
        *(or_empty(name, union.schema[name].dataType) for name in nests),
    )


def or_empty(name: str, data_type: T.DataType) -> Column:
    return F.coalesce(quoted(name), F.array().cast(data_type)).alias(name)


def nested_rows(
    source: Source, nest: View, outer: Keys, filters: Sequence[Bound], rank: str | None = None
) -> DataFrame:
    """Rows of a nest for every outer group, limited per outer group."""
    if not nest.grouped:
        raise ValueError("a nest groups rows; select rows in a view of their own")
    frame = grouped(source, nest, outer, filters)
    if nest.row_limit is None:
        if rank is not None:
            raise ValueError("a rank needs a limit, or one task would number a whole group")
        return frame
    terms = sort_terms(nest.ordering())
    if not outer:
        frame = frame.orderBy(*terms).limit(nest.row_limit)
        if rank is None:
            return frame
    number = rank or "__rank"
    within = Window.partitionBy(*map(quoted, outer)).orderBy(*terms)
    frame = frame.withColumn(number, F.row_number().over(within))
    frame = frame.filter(quoted(number) <= nest.row_limit)
    return frame if rank is not None else frame.drop(number)


def gathered(rows: DataFrame, nest: View, name: str, outer: Sequence[str]) -> DataFrame:
    own = [*nest.keys, *nest.measures, *nest.nests]
    array = sorted_array(F.collect_list(F.struct(*map(quoted, own))), nest)
    return rows.groupBy(*map(quoted, outer)).agg(array.alias(name))


def sorted_array(array: Column, nest: View) -> Column:
    def compare(left: Column, right: Column) -> Column:
        result = F.lit(0)
        for name, descending in reversed(nest.ordering()):
            a, b = left[name], right[name]
            less, more = (1, -1) if descending else (-1, 1)
            result = (
                F.when(a.isNull() & b.isNull(), result)
                .when(a.isNull(), 1)
                .when(b.isNull(), -1)
                .when(a < b, less)
                .when(a > b, more)
                .otherwise(result)
            )
        return result

    return F.array_sort(array, compare)


def one_pass(
    source: Source, view: View, keys: Keys, filters: Sequence[Bound], nests: Mapping[str, View]
) -> tuple[DataFrame | None, Sequence[str]]:
    """Measures and nests from one read of the joined rows, as grouping sets, and the nests it holds.

    Only where contributions are plain rows of the source, which add up at any grouping; returns
    no frame elsewhere.  A limited nest is left out if its keys are also those of the view or of
    another nest, whose rows a limit must not touch.
    """
    table = AtomTable(source)
    finals = {name: m.resolve(table, (), ()) for name, m in view.measures.items()}
    columns: dict[object, tuple[str, Bound]] = {}

    def column_of(identity: object, bound: Bound) -> str:
        identity = bound.plain or identity
        return columns.setdefault(identity, (f"__key{len(columns)}", bound))[0]

    base = [column_of(("outer", name), bound) for name, bound in keys.items()]
    shapes = {}
    sets = {}
    for name, nest in sorted(nests.items(), key=lambda item: item[1].row_limit is not None):
        inner = {k: column_of(e, bind(source, e)) for k, e in nest.keys.items()}
        members = {*base, *inner.values()}
        if nest.row_limit is not None and members in [set(base), *sets.values()]:
            continue
        sets[name] = members
        conditions = tuple(((), predicate) for predicate in nest.filters)
        shapes[name] = (
            inner,
            {k: m.resolve(table, (), conditions) for k, m in nest.measures.items()},
            table.add((), None, conditions) if conditions else None,
        )
    if not shapes:
        return None, ()
    bounds = dict(columns.values())
    plan = GrainPlan(source, bounds, filters, table.atoms)
    if cross_join_of(plan) is not None or plan.fans_out():
        return None, ()

    def set_id(members: set[str]) -> int:
        return int("".join("0" if name in members else "1" for name in bounds) or "0", 2)

    distinct_sets = {set_id(members): members for members in [set(base), *sets.values()]}
    if len(distinct_sets) == 1:
        rows = plan.aggregate().withColumn("__set", F.lit(set_id(set(base))))
    else:
        rows = plan.contributions().groupingSets(
            [[quoted(name) for name in bounds if name in s] for s in distinct_sets.values()],
            *map(quoted, bounds),
        ).agg(*plan.totals(), F.grouping_id().alias("__set"))
    atoms = plan.atom_columns()
    kept, values = {}, {}
    for name, (inner, inner_finals, exists) in shapes.items():
        kept[name] = F.col("__set") == set_id(sets[name])
        if exists is not None:
            kept[name] = kept[name] & (atoms[exists] > 0)
        values[name] = {
            **{key: quoted(internal) for key, internal in inner.items()},
            **{measure: final(atoms) for measure, final in inner_finals.items()},
        }
    cuts = {set_id(sets[name]): (nests[name], kept[name], values[name]) for name in shapes if nests[name].row_limit is not None}
    if cuts:
        rows = first_of_sets(rows, base, [name for name in bounds if name not in base], cuts)
    arrays = [
        sorted_array(
            F.collect_list(F.when(kept[name], F.struct(*(value.alias(n) for n, value in values[name].items())))), nests[name]
        ).alias(name)
        for name in shapes
    ]
    own = F.col("__set") == set_id(set(base))
    merged = rows.groupBy(*map(quoted, dict.fromkeys(base))).agg(
        *(
            F.max(F.when(own, quoted(atom_name(i)))).alias(atom_name(i))
            for i in range(len(table.atoms))
        ),
        *arrays,
    )
    frame = merged.select(
        *(quoted(internal).alias(name) for internal, name in zip(base, keys)),
        *(final(atoms).alias(name) for name, final in finals.items()),
        *map(quoted, shapes),
    )
    return frame, tuple(shapes)


def first_of_sets(
    rows: DataFrame,
    base: Sequence[str],
    others: Sequence[str],
    cuts: Mapping[int, tuple[View, Column, Mapping[str, Column]]],
) -> DataFrame:
    """Rows of grouping sets, those of limited nests cut to the first of each outer group.

    Each row of another set is a window partition of its own, so one bound on the rank holds for
    all sets and Spark cuts every task's rows by it before they are shuffled.
    """
    free = ~F.col("__set").isin(list(cuts))
    alone = [F.when(free, quoted(name)) for name in others]
    terms, own_limit, kept = [], F.lit(1), free
    for number, (nest, condition, values) in cuts.items():
        here = F.col("__set") == number
        kept = kept | condition
        own_limit = F.when(here, F.lit(nest.row_limit)).otherwise(own_limit)
        for name, descending in nest.ordering():
            value = F.when(here, values[name])
            terms.append(value.desc_nulls_last() if descending else value.asc_nulls_last())
    within = Window.partitionBy(*map(quoted, base), "__set", *alone).orderBy(*terms)
    most = max(1, *(nest.row_limit for nest, _, _ in cuts.values()))
    ranked = rows.filter(kept).withColumn("__rank", F.row_number().over(within))
    return ranked.filter((F.col("__rank") <= most) & (F.col("__rank") <= own_limit)).drop("__rank")


def flat_nest(source: Source, view: View, nest: str, rank: str | None) -> DataFrame:
    if nest not in view.nests:
        raise KeyError(f"the view has no nest '{nest}'; it has {sorted(view.nests)}")
    inner = source.resolve_view(view.nests[nest])
    keys = bound_all(source, view.keys)
    outer = {f"__outer{i}": bound for i, bound in enumerate(keys.values())}
    filters = [bind(source, predicate) for predicate in view.filters]
    rows = nested_rows(source, inner, outer, filters, rank)
    own = [*inner.keys, *inner.measures, *inner.nests, *([rank] if rank else [])]
    clash = sorted(set(keys) & set(own))
    if clash:
        raise ValueError(f"outer and inner columns share the names {clash}; rename the inner ones")
    return rows.select(
        *(quoted(internal).alias(name) for internal, name in zip(outer, keys)),
        *map(quoted, own),
    )
