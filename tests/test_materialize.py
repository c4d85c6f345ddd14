from dataclasses import replace

import pytest
from demo import CUSTOMER_SCHEMA, CUSTOMERS, orders_source
from pyspark.sql import functions as F

from semlayer import (
    count,
    materialize,
    materialize_sql,
    preview,
    release,
    sql_source,
    sum_of,
    table_source,
    to_arrow,
    view,
    write_rows,
)


@pytest.fixture
def name(request):
    return "t_" + "".join(c if c.isalnum() else "_" for c in request.node.name)


def test_table_record(spark, name):
    frame = orders_source(spark).query("customer_performance")
    written = materialize(frame, name)
    assert (written.target_table, written.mode, written.row_count) == (name, "table", 5)
    assert written.columns[-1] == ("avg_order_value", "double")
    assert written.duration_seconds > 0
    assert sorted(spark.table(name).collect()) == sorted(frame.collect())
    assert len(preview(spark, name)) == 5
    assert len(preview(spark, name, rows=2)) == 2


def test_replace_with_same_and_other_schema(spark, name):
    first = materialize(spark.range(3), name)
    second = materialize(spark.range(5), name)
    assert second.previous_location.endswith(first.location.split("/")[-1])
    assert spark.table(name).count() == 5
    third = materialize(spark.range(2).withColumn("x", F.lit("a")), name)
    assert spark.table(name).columns == ["id", "x"]
    assert third.previous_location.endswith(second.location.split("/")[-1])
    fourth = materialize(spark.range(4).withColumn("x", F.lit("a")), name, file_format="orc")
    assert spark.table(name).count() == 4 and fourth.row_count == 4
    leftovers = [t.name for t in spark.catalog.listTables() if t.name.startswith(f"{name}__")]
    assert leftovers == []


def test_table_may_read_itself(spark, name):
    materialize(spark.range(3), name)
    materialize(spark.table(name).selectExpr("id + 10 AS id"), name)
    assert sorted(r.id for r in spark.table(name).collect()) == [10, 11, 12]


def test_failed_write_leaves_the_old_table(spark, name):
    materialize(spark.range(3), name)
    broken = spark.range(3).select((F.lit(1) / (F.col("id") - 1)).alias("id"))
    with pytest.raises(Exception):
        materialize(broken, name)
    assert spark.table(name).count() == 3


def test_empty_result_keeps_its_schema(spark, name):
    nothing = orders_source(spark, rows=[]).query("daily_sales_trend")
    written = materialize(nothing, name)
    assert written.row_count == 0
    assert spark.table(name).columns == ["order_date", "total_revenue", "total_orders"]


def test_impossible_targets_are_refused_before_the_write(spark):
    for target in ("odd-name", "no_such_schema.t"):
        with pytest.raises(ValueError):
            materialize(spark.range(2), target)


def test_qualified_names(spark, name):
    for target in (f"default.{name}", f"spark_catalog.default.{name}"):
        materialize(spark.range(2), target)
        materialize(spark.range(3).withColumn("x", F.lit(target)), target)
        assert spark.table(name).count() == 3


def test_session_view_and_stored_view(spark, name):
    written = materialize(orders_source(spark).query("daily_sales_trend"), name, mode="view")
    assert written.row_count is None
    assert spark.table(name).count() == 5
    with pytest.raises(ValueError):
        materialize(spark.range(1), name)
    spark.catalog.dropTempView(name)
    stored = materialize_sql(spark, "SELECT 1 AS x;", name)
    assert stored.columns == (("x", "int"),)
    assert spark.table(name).collect()[0].x == 1
    with pytest.raises(ValueError):
        materialize(spark.range(1), name)


def test_unknown_mode_is_rejected(spark, name):
    with pytest.raises(ValueError):
        materialize(spark.range(1), name, mode="dynamic")


def test_downstream_digest(spark, name):
    materialize(orders_source(spark).query("customer_performance"), name)
    vip = count().where(lambda c: c.total_revenue > 500)
    digest = table_source(spark, f"spark_catalog.default.{name}").query(view().aggregate(vip=vip))
    assert digest.first().vip == 4


def test_inline_sql_summary(spark, name):
    orders = sql_source(spark, "orders", "SELECT 1 AS id, 'Alice' AS customer, 100.0D AS amount")
    orders = orders.primary_key("id").measure(total_amount=sum_of("amount"))
    materialize(orders.query(view().group_by("customer").aggregate("total_amount")), name)
    assert [tuple(r) for r in spark.table(name).collect()] == [("Alice", 100.0)]


def test_rows_and_arrow(spark, tmp_path):
    path = str(tmp_path / "customers.parquet")
    assert write_rows(spark, CUSTOMERS, CUSTOMER_SCHEMA, path) == 5
    arrow = to_arrow(spark.read.parquet(path), row_limit=3)
    assert arrow.num_rows == 3
    assert arrow.column_names == ["id", "name", "segment", "state"]


def test_preview_and_release(spark, tmp_path):
    folder = str(tmp_path)
    first = materialize(spark.range(8), "previewed", folder=folder, preview_rows=3)
    assert [row.id for row in first.preview] and len(first.preview) == 3
    assert not release(spark, first)
    second = materialize(spark.range(9), "previewed", folder=folder)
    assert second.preview == () and second.previous_location
    assert release(spark, second) and spark.table("previewed").count() == 9
    assert not (tmp_path / "previewed" / first.location.rsplit("/", 1)[-1]).exists()
    assert not release(spark, replace(second, previous_location=second.location))
    assert not release(spark, replace(second, previous_location=str(tmp_path)))
    assert spark.table("previewed").count() == 9
    spark.sql("DROP TABLE previewed")
