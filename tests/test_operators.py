import random

import pytest

from semlayer.operators.checks import is_check
from semlayer.operators.materialize import materialize
from demo import CUSTOMER_SCHEMA, CUSTOMERS, customers_source, orders_source

from semlayer import (
    Source,
    file_source,
    primary_key_violations,
    read_file,
    source_edges,
    transitive_closure,
    view,
    write_files,
)


@pytest.mark.parametrize(
    "extension, options",
    [
        ("parquet", {}),
        ("orc", {}),
        ("json", {}),
        ("csv", {"header": "true"}),
        ("tsv", {"header": "true", "sep": "\t"}),
    ],
)
def test_file_formats(spark, tmp_path, extension, options):
    rows = [*CUSTOMERS, (6, "Tab\tbed, \"quoted\"", None, "CA")]
    path = str(tmp_path / f"customers.{extension}")
    frame = spark.createDataFrame(rows, CUSTOMER_SCHEMA)
    assert write_files(frame, path, "csv" if extension == "tsv" else extension, **options) == 6
    source = file_source(spark, "customers", path, CUSTOMER_SCHEMA)
    assert sorted(map(tuple, source.query(view().select("*")).collect()), key=repr) == sorted(rows, key=repr)


def test_delimited_files_are_read_by_many_tasks(spark, tmp_path):
    """Files without text columns are cut anywhere; those with some end after a number of rows."""
    spark.conf.set("spark.sql.files.maxPartitionBytes", "65536")
    spark.conf.set("spark.sql.files.openCostInBytes", "65536")
    try:
        for name, columns, options in (
            ("numbers.csv", "id, id * 1.5D AS x, id % 2 = 0 AS even", {}),
            ("texts.csv", "id, concat('a\\n', repeat('b', 60)) AS x", {"maxRecordsPerFile": "2000"}),
        ):
            frame = spark.range(0, 20_000, 1, 1).selectExpr(*columns.split(", ") if "concat" not in columns else ["id", columns[4:]])
            path = str(tmp_path / name)
            assert write_files(frame, path, "csv", **options) == 20_000
            found = read_file(spark, path, frame.schema)
            assert found.rdd.getNumPartitions() > 4
            assert found.exceptAll(frame).isEmpty() and found.count() == 20_000
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_text_formats_need_a_schema(spark):
    with pytest.raises(ValueError):
        read_file(spark, "x.csv")
    with pytest.raises(ValueError):
        read_file(spark, "x.avro")


def test_primary_key_violations(spark):
    twice = customers_source(spark, [*CUSTOMERS, CUSTOMERS[0], (None, "a", "b", "c"), (None, "d", "e", "f")])
    found = sorted(map(tuple, primary_key_violations(twice).collect()), key=repr)
    assert found == [(1, 2), (None, 2)]
    assert primary_key_violations(customers_source(spark)).count() == 0
    with pytest.raises(ValueError):
        primary_key_violations(Source("keyless", spark.range(1)))


def pairs(frame):
    return sorted(map(tuple, frame.collect()))


def test_closure_of_a_cycle(spark):
    edges = spark.createDataFrame([("a", "b"), ("b", "c"), ("c", "a"), ("c", "d")], "src string, dst string")
    closure = transitive_closure(edges)
    assert pairs(closure) == [(s, t) for s in "abc" for t in "abcd"]
    assert pairs(transitive_closure(closure)) == pairs(closure)


def test_closure_of_nothing_and_of_other_names(spark):
    assert pairs(transitive_closure(spark.createDataFrame([], "src int, dst int"))) == []
    edges = spark.createDataFrame([(1, 2), (2, 3), (None, 1), (3, None)], "child int, parent int")
    assert pairs(transitive_closure(edges, "child", "parent")) == [(1, 2), (1, 3), (2, 3)]


def test_closure_of_a_long_chain(spark):
    edges = spark.range(12).selectExpr("id AS src", "id + 1 AS dst")
    assert transitive_closure(edges).count() == 13 * 12 // 2


def test_closure_rounds_double(spark, monkeypatch):
    from semlayer.operators import closure

    written = []
    monkeypatch.setattr(closure, "write_files", lambda frame, path: written.append(path) or write_files(frame, path))
    edges = spark.range(40).selectExpr("id AS src", "id + 1 AS dst")
    assert transitive_closure(edges).count() == 41 * 40 // 2
    assert len(written) == 7  # paths of up to 1, 2, 4 .. 64 edges


def test_closure_of_random_graphs(spark):
    rng = random.Random(5)
    for size in (5, 9, 14):
        graph = {(rng.randrange(size), rng.randrange(size)) for _ in range(size + 3)}
        reach = set(graph)
        while more := {(a, d) for a, b in reach for c, d in graph if b == c} - reach:
            reach |= more
        found = transitive_closure(spark.createDataFrame(sorted(graph), "src int, dst int"))
        assert pairs(found) == sorted(reach)


def test_closure_survives_a_hot_node(spark):
    """Every node points at one hub, which points at a few more."""
    edges = spark.range(2000).selectExpr("id AS src", "-1L AS dst").union(
        spark.range(3).selectExpr("-1L AS src", "-2L - id AS dst")
    )
    assert transitive_closure(edges).count() == 2000 * 4 + 3


def test_source_edges(spark):
    orders = orders_source(spark).extend("orders_2")
    closure = pairs(transitive_closure(source_edges(spark, [orders])))
    assert ("orders_2", "orders") in closure and ("orders", "customers") in closure


TEXTS = [
    (1, 'say ""hi"", ok'),
    (2, "two\nlines\r\nand more"),
    (3, " pad "),
    (4, ""),
    (5, None),
    (6, 'tab\t, comma, "quoted" \\ back'),
]


@pytest.mark.parametrize("file_format", ["csv", "tsv", "json", "orc", "parquet"])
def test_texts_come_back_as_they_were(spark, tmp_path, file_format):
    path = str(tmp_path / "texts")
    frame = spark.createDataFrame(TEXTS, "id int, t string")
    assert write_files(frame, path, file_format) == len(TEXTS)
    again = read_file(spark, path, frame.schema, file_format)
    assert sorted(map(tuple, again.collect())) == TEXTS


def test_foreign_files_are_read_right_or_refused(spark, tmp_path):
    good, swapped, bad = (tmp_path / f"{name}.csv" for name in ("good", "swapped", "bad"))
    good.write_text('a,b\n1,"say ""hi"", ok"\n2," x\ny "\n')
    swapped.write_text("b,a\n1,2\n")
    bad.write_text("a,b\nnone,2\n")
    schema = "a int, b string"
    assert sorted(map(tuple, read_file(spark, str(good), schema).collect())) == [(1, 'say "hi", ok'), (2, " x\ny ")]
    for path in (swapped, bad):
        with pytest.raises(Exception):
            read_file(spark, str(path), schema).collect()
    broken = tmp_path / "broken.json"
    broken.write_text('{"a": 1, "b": "x"}\n{"a": \n')
    with pytest.raises(Exception):
        read_file(spark, str(broken), schema).collect()


def test_a_folder_with_a_quote_can_be_replaced(spark, tmp_path):
    folder = str(tmp_path / "it's")
    frame = spark.createDataFrame([(1,)], "id int")
    materialize(frame, "quoted_folder", folder=folder)
    materialize(frame.union(frame), "quoted_folder", folder=folder)
    assert spark.table("quoted_folder").count() == 2
    spark.sql("DROP TABLE quoted_folder")


@pytest.mark.parametrize("name", ["Check_x", "TEST_y", "assert_z"])
def test_check_names_ignore_case(name):
    assert is_check(name)
