"""Nests of random queries: exploded arrays equal the flat rows, which no array ever held."""

import random

import pytest
from pyspark.sql import functions as F
from test_grain_random import TREE, Predicate, build, random_table

from semlayer import count, sum_of, view


@pytest.mark.parametrize("seed", range(16))
def test_arrays_equal_flat_rows(spark, seed):
    rng = random.Random(1000 + seed)
    paths = [(), *TREE] if seed % 3 == 0 else [(), ("a",), ("a", "g")]
    tables = {path: random_table(rng, 6 if path else 9) for path in [(), *TREE]}
    source = build(spark, tables)

    def shape(prefix, keys):
        made = view()
        for i in range(keys):
            made = made.group_by(**{f"{prefix}k{i}": ".".join((*rng.choice(paths), "k"))})
        made = made.aggregate(**{f"{prefix}n": count(), f"{prefix}s": sum_of("x")})
        if rng.random() < 0.5:
            made = made.where(Predicate(rng, paths).column)
        return made

    nests = {}
    for i in range(rng.choice([1, 2, 3])):
        nest = shape(f"i{i}", rng.choice([1, 2]))
        nests[f"nest{i}"] = nest.limit(2) if rng.random() < 0.4 else nest
    outer = shape("o", rng.choice([0, 1])).nest(**nests)

    frame = source.query(outer)
    plain = source.query(view().group_by(**outer.keys).where(*outer.filters).aggregate(**outer.measures))
    assert sorted(map(repr, frame.select(plain.columns).collect())) == sorted(map(repr, plain.collect()))
    for name in nests:
        exploded = frame.select(*outer.keys, F.inline(name))
        flat = source.nest_rows(outer, name)
        assert exploded.columns == flat.columns
        assert sorted(map(repr, exploded.collect())) == sorted(map(repr, flat.collect()))
        assert frame.filter(F.col(name).isNull()).count() == 0
