"""Data-quality checks and the suite that runs them.

A check passes when its first row says ``invalid_count = 0``, else when it says ``fail_count = 0``,
and without either column when it returns no rows at all.  Checks that count the rows of one source
that meet a condition share one scan of that source, and a suite is one job: the verdict rows of all
its checks are a union of short frames.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from semlayer.functions.measures import Named, count
from semlayer.plans.grain import GrainPlan
from semlayer.plans.view import View
from semlayer.sources.scope import Expression, bind, evaluate, quoted
from semlayer.sources.source import Source

# The verdict columns in order of precedence, and the name prefixes of checks.
VERDICT_COLUMNS = ("invalid_count", "fail_count")
CHECK_PREFIXES = ("check_", "test_", "assert_")

RESULT_SCHEMA = (
    "target string, name string, passed boolean, returned_rows bigint, description string"
)


def is_check(name: str, flagged: bool = False) -> bool:
    return flagged or name.lower().startswith(CHECK_PREFIXES)


@dataclass(frozen=True, eq=False)
class Check:
    """One of: rows of a source that break a rule, counted or returned; a view; or any frame."""

    name: str
    target: str
    source: Source | None = None
    bad: Expression | None = None
    column: str | None = None  # the count column; None returns the offending rows
    shape: View | None = None
    frame: DataFrame | None = None

    @staticmethod
    def counting(
        name: str, source: Source, bad: Expression, column: str = "invalid_count", target: str | None = None
    ) -> Check:
        """Counts the rows of a source that meet ``bad`` into ``column``."""
        return Check(name, target or source.name, source, bad, column)

    @staticmethod
    def offending(name: str, source: Source, bad: Expression, target: str | None = None) -> Check:
        """Returns the rows of a source that meet ``bad``."""
        return Check(name, target or source.name, source, bad)

    @staticmethod
    def of_view(name: str, source: Source, shape: View | str, target: str | None = None) -> Check:
        """Judges a view of a source; one that filters and counts shares scans like ``counting``."""
        shape = source.resolve_view(shape)
        target = target or source.name
        if shape.filters and shape.columns_out == tuple(shape.measures) and len(shape.measures) == 1:
            ((column, measure),) = shape.measures.items()
            if isinstance(measure, Named):
                measure = source.measures.get(measure.name)
            if measure == count() and shape.row_limit is None:
                return Check(name, target, source, _all_of(shape.filters), column)
        return Check(name, target, source, shape=shape)

    @staticmethod
    def of(name: str, frame: DataFrame, target: str | None = None) -> Check:
        """Judges a frame of the caller's, by default as a check of its own name."""
        return Check(name, target or name, frame=frame)

    def result(self) -> DataFrame:
        """The rows the check returns, lazily."""
        if self.source is None:
            return self.frame
        if self.shape is not None:
            return self.source.query(self.shape)
        if self.column is None:
            return self.source.query(View().select("*").where(self.bad))
        return self.source.query(View().where(self.bad).aggregate(**{self.column: count()}))


def _all_of(filters: Sequence[Expression]) -> Expression:
    return lambda scope: reduce(Column.__and__, [evaluate(f, scope) for f in filters])


def checks_of(source: Source, target: str | None = None) -> list[Check]:
    """The views of a source that are checks by their names."""
    return [Check.of_view(name, source, name, target) for name in source.views if is_check(name)]


def judge(verdict: dict[str, int | None], rows: int) -> tuple[bool, str]:
    """The verdict rule over the verdict columns of the first row, if any, and the number of rows."""
    for column in VERDICT_COLUMNS:
        if column in verdict:
            found = verdict[column]
            if found is None:
                return False, f"{column} is null"
            return found == 0, f"{column} is {found}" + (", as it should be" if found == 0 else "; it should be 0")
    return rows == 0, "no rows came back" if rows == 0 else f"{rows} rows came back; there should be none"


def run_check(check: Check) -> Row:
    """Run one check by itself; a check that cannot run has failed."""
    return _run([[check]], {check: 0})[0]


def run_suite(spark: SparkSession, checks: Iterable[Check]) -> DataFrame:
    """One row per check, in the order given.  Only verdicts reach the driver, in one job.

    If a check raises, the job fails; then each shared scan runs by itself, and the checks of the
    one that fails one by one.
    """
    checks = list(checks)
    places = {check: i for i, check in enumerate(checks)}
    records = _run(_shared_scans(list(places)), places)
    return spark.createDataFrame([records[places[check]] for check in checks], RESULT_SCHEMA)


def _run(groups: list[list[Check]], places: dict[Check, int]) -> dict[int, Row]:
    """The records of some groups of checks, by place."""
    try:
        heads = reduce(DataFrame.union, [_heads(group, places) for group in groups]).collect() if groups else []
        found: dict[int, list[Row]] = {}
        for row in heads:
            found.setdefault(row.place, []).append(row)
        records = {}
        for group in groups:
            for check in group:
                records[places[check]] = _judged(check, found.get(places[check], []))
        return records
    except Exception as error:  # a user's expression may raise anything
        if len(groups) > 1:
            smaller = [[group] for group in groups]
        elif len(groups[0]) > 1:
            smaller = [[[check]] for check in groups[0]]
        else:
            (check,) = groups[0]
            return {places[check]: _record(check, False, 0, f"could not run: {error}")}
    records = {}
    for part in smaller:
        records |= _run(part, places)
    return records


def _heads(group: list[Check], places: dict[Check, int]) -> DataFrame:
    """(place, invalid_count, fail_count, rows): what the verdicts of one shared scan, or one check, need.

    A check with a verdict column gives its first two rows: two settle the usual case of one.
    """
    none = F.lit(None).cast("bigint")
    if len(group) > 1:
        counts = fused_counts(group[0].source, [check.bad for check in group])
        rows = [
            F.struct(
                F.lit(places[check]).alias("place"),
                *((found if column == check.column else none).alias(column) for column in VERDICT_COLUMNS),
                (found if check.column is None else F.lit(1).cast("bigint")).alias("rows"),
            )
            for check, found in zip(group, (F.col(f"bad{i}") for i in range(len(group))))
        ]
        return counts.select(F.inline(F.array(*rows)))
    (check,) = group
    frame = check.result()
    place = F.lit(places[check]).alias("place")
    if any(column in frame.columns for column in VERDICT_COLUMNS):
        values = [(quoted(c).cast("bigint") if c in frame.columns else none).alias(c) for c in VERDICT_COLUMNS]
        return frame.limit(2).select(place, *values, none.alias("rows"))
    return frame.agg(F.count(F.lit(1)).alias("rows")).select(place, *(none.alias(c) for c in VERDICT_COLUMNS), "rows")


def _judged(check: Check, heads: list[Row]) -> Row:
    columns = [check.column] if check.source is not None and check.shape is None else check.result().columns
    verdict = {c: heads[0][c] for c in VERDICT_COLUMNS if c in columns} if heads else {}
    rows = len(heads)
    if rows == 1 and heads[0].rows is not None:
        rows = heads[0].rows
    elif rows > 1:
        rows = check.result().count()
    passed, description = judge(verdict, rows)
    return _record(check, passed, rows, description)


def fused_counts(source: Source, conditions: Sequence[Expression]) -> DataFrame:
    """One row with one count per condition, from one scan that skips rows no condition wants."""
    bad = {f"bad{i}": bind(source, condition) for i, condition in enumerate(conditions)}
    rows = GrainPlan(source, bad, [], []).rows()
    wanted = reduce(Column.__or__, map(quoted, bad))
    return rows.filter(wanted).agg(*(F.count_if(quoted(name)).alias(name) for name in bad))


def _shared_scans(checks: Sequence[Check]) -> list[list[Check]]:
    """Checks that can share a scan: of sources that read alike, and without a join that fans out."""
    groups: list[list[Check]] = []
    sharing: list[list[Check]] = []
    for check in checks:
        group = None
        if check.bad is not None and check.column in (None, *VERDICT_COLUMNS):
            try:
                plan = GrainPlan(check.source, {"bad": bind(check.source, check.bad)}, [], [])
                if not plan.fans_out():
                    group = next((g for g in sharing if _read_alike(g[0].source, check.source)), None)
                    if group is None:
                        group = []
                        sharing.append(group)
                        groups.append(group)
            except Exception:  # a user's expression may raise anything: run alone, and let it fail there
                group = None
        if group is None:
            groups.append(group := [])
        group.append(check)
    return groups


def _read_alike(one: Source, other: Source) -> bool:
    """Whether expressions over one source mean the same over the other."""
    if one is other:
        return True
    if one.dimensions != other.dimensions or one.joins != other.joins:
        return False
    return one.frame is other.frame or one.frame.sameSemantics(other.frame)


def _record(check: Check, passed: bool, rows: int, description: str) -> Row:
    return Row(
        target=check.target,
        name=check.name,
        passed=passed,
        returned_rows=rows,
        description=description,
    )
