"""Random models, data and queries against a brute-force reading of the grain rule."""

import random

import pytest

from semlayer import Source, count, sum_of, view

# name: (parent path, join kind, parent field, own field); the root is ().  One step per name.
TREE = {
    ("a",): ("one", "fk", "id"),
    ("a", "g"): ("one", "fk", "id"),
    ("a", "f"): ("many", "id", "pid"),
    ("c",): ("many", "id", "pid"),
    ("c", "d"): ("many", "id", "pid"),
    ("c", "h"): ("one", "fk", "id"),
    ("e",): ("many", "id", "pid"),
    ("m",): ("many", "fk", "pid"),  # the parent field is not unique: many to many
}
FIELDS = ("id", "fk", "pid", "k", "x")


def random_table(rng, size):
    maybe = lambda top: rng.choice([None, *range(top)])
    ids = rng.sample(range(size + 3), size)
    return [
        dict(id=i, fk=maybe(6), pid=maybe(6), k=rng.choice(["p", "q", None]), x=maybe(9)) for i in ids
    ]


def build(spark, tables):
    def source(path):
        frame = spark.createDataFrame(
            [tuple(row[f] for f in FIELDS) for row in tables[path]],
            "id int, fk int, pid int, k string, x int",
        )
        result = Source("_".join(path) or "root", frame).primary_key("id")
        for child, (kind, here, there) in TREE.items():
            if child[:-1] == path:
                join = result.join_one if kind == "one" else result.join_many
                result = join(source(child), {here: there}, name=child[-1])
        return result

    return source(())


def joined(tables, paths):
    rows = [{(): row} for row in tables[()]]
    for path in sorted(paths - {()}, key=len):
        _, here, there = TREE[path]
        grown = []
        for row in rows:
            parent = row[path[:-1]]
            key = parent and parent[here]
            matches = [r for r in tables[path] if key is not None and r[there] == key]
            grown += [{**row, path: match} for match in matches or [None]]
        rows = grown
    return rows


def closed(paths):
    return {p[:i] for p in paths for i in range(len(p) + 1)}


def value(row, path, field):
    return row[path] and row[path][field]


class Predicate:
    def __init__(self, rng, paths):
        self.path = rng.choice(paths)
        self.paths = [self.path]
        self.null = rng.random() < 0.3
        self.bound = rng.randrange(6)

    def column(self, scope):
        field = scope[".".join((*self.path, "x"))]
        return field.isNull() if self.null else field > self.bound

    def holds(self, row):
        found = value(row, self.path, "x")
        return found is None if self.null else found is not None and found > self.bound


class Either:
    """A predicate over two paths, true when one of two predicates is (three-valued)."""

    def __init__(self, rng, paths):
        self.parts = [Predicate(rng, paths), Predicate(rng, paths)]
        self.paths = [part.path for part in self.parts]

    def column(self, scope):
        left, right = (part.column(scope) for part in self.parts)
        return left | right

    def holds(self, row):
        return any(part.holds(row) for part in self.parts)


def random_filter(rng, paths):
    return Either(rng, paths) if rng.random() < 0.3 else Predicate(rng, paths)


class Relative(Predicate):
    """A predicate on a measure, written from the measure's home."""

    def __init__(self, rng, home, paths):
        super().__init__(rng, [p for p in paths if p[: len(home)] == home])
        self.home = home

    def column(self, scope):
        here = self.path[len(self.home):]
        field = scope[".".join((*here, "x"))]
        return field.isNull() if self.null else field > self.bound


def one_below(home):
    return [home] + [
        p
        for p in TREE
        if p[: len(home)] == home
        and len(p) > len(home)
        and all(TREE[p[:i]][0] == "one" for i in range(len(home) + 1, len(p) + 1))
    ]


@pytest.mark.parametrize("seed", range(48))
def test_random_query(spark, seed):
    rng = random.Random(seed)
    paths = [(), *TREE]
    tables = {path: random_table(rng, rng.choice([0, 3, 6, 9]) if path else 8) for path in paths}
    source = build(spark, tables)

    keys = []
    for i in range(rng.choice([0, 1, 1, 2])):
        path = rng.choice(paths)
        computed = rng.random() < 0.3
        keys.append((f"key{i}", path, computed))
    filters = [random_filter(rng, paths) for _ in range(rng.choice([0, 1, 1, 2]))]
    measures = []
    for i in range(rng.choice([0, 1, 2, 3]) if keys else rng.choice([1, 2, 3])):
        home = rng.choice(paths)
        of = rng.choice([None, rng.choice(one_below(home))])
        condition = Relative(rng, home, paths) if rng.random() < 0.3 else None
        measures.append((f"m{i}", home, of, condition))

    query = view()
    for name, path, computed in keys:
        field = ".".join((*path, "k"))
        expression = (lambda s, f=field: s[f] == "p") if computed else field
        query = query.group_by(**{name: expression})
    for predicate in filters:
        query = query.where(predicate.column)
    for name, home, of, condition in measures:
        at = ".".join(home) or None
        if of is None:
            measure = count(at)
        else:
            measure = sum_of(".".join((*of[len(home):], "x")), at)
        if condition is not None:
            # conditions are relative to the home: wrap them where the measure itself is
            inner = count() if of is None else sum_of(".".join((*of[len(home):], "x")))
            measure = inner.where(condition.column)
            if home:
                from semlayer.functions.measures import OfJoin

                measure = OfJoin(home, measure)
        query = query.aggregate(**{name: measure})

    used = {p for _, p, _ in keys} | {p for f in filters for p in f.paths}
    expected = {}
    rows = [r for r in joined(tables, closed({(), *used})) if all(f.holds(r) for f in filters)]

    def group_of(row):
        found = []
        for _, path, computed in keys:
            k = value(row, path, "k")
            found.append((None if k is None else k == "p") if computed else k)
        return tuple(found)

    for group in {group_of(row) for row in rows} if keys else {()}:
        expected[group] = []
    for _, home, of, condition in measures:
        mine = closed({(), home, *used, *([of] if of else []), *([condition.path] if condition else [])})
        counted = {}
        for row in joined(tables, mine):
            if not all(f.holds(row) for f in filters) or row[home] is None:
                continue
            if condition is not None and not condition.holds(row):
                continue
            counted.setdefault(group_of(row), {})[row[home]["id"]] = (
                1 if of is None else value(row, of, "x")
            )
        for group, totals in expected.items():
            found = [v for v in counted.get(group, {}).values() if v is not None]
            totals.append(len(found) if of is None else (sum(found) if found else None))

    name = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(name)
    spark.conf.set(name, "-1" if seed % 2 else before)
    try:
        answer = source.query(query).collect()
    finally:
        spark.conf.set(name, before)
    found = {tuple(row)[: len(keys)]: list(row)[len(keys):] for row in answer}
    assert len(found) == len(answer)
    assert found == expected
