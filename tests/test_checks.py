import pytest
from demo import ORDERS, orders_source
from pyspark.sql import functions as F

from semlayer import Check, Source, checks_of, count, is_check, run_check, run_suite, view
from semlayer.operators.checks import _shared_scans, fused_counts

BAD_ORDERS = [*ORDERS, (8, None, 101, 0.0, 1, "2026-08-06"), (9, 1, 101, -5.0, 1, "2026-08-06")]


def verdicts(frame):
    return [(row.name, row.passed, row.returned_rows) for row in frame.collect()]


def test_demo_checks_pass(spark):
    orders = orders_source(spark)
    suite = run_suite(
        spark,
        [
            Check.counting("check_valid_customer_ids", orders, lambda o: o.customer_id.isNull()),
            Check.counting("check_positive_prices", orders, lambda o: o.price <= 0),
        ],
    )
    assert [(r.target, r.name, r.passed, r.returned_rows) for r in suite.collect()] == [
        ("orders", "check_valid_customer_ids", True, 1),
        ("orders", "check_positive_prices", True, 1),
    ]


def test_demo_checks_fail_on_bad_rows(spark):
    orders = orders_source(spark, BAD_ORDERS)
    suite = run_suite(
        spark,
        [
            Check.counting("check_ids", orders, lambda o: o.customer_id.isNull()),
            Check.counting("check_prices", orders, lambda o: o.price <= 0, column="fail_count"),
            Check.offending("check_rows", orders, lambda o: o.price <= 0),
        ],
    )
    assert [row.description for row in suite.collect()] == [
        "invalid_count is 1; it should be 0",
        "fail_count is 2; it should be 0",
        "2 rows came back; there should be none",
    ]
    assert verdicts(suite) == [
        ("check_ids", False, 1), ("check_prices", False, 1), ("check_rows", False, 2)
    ]


@pytest.mark.parametrize(
    "text, passed, rows",
    [
        ("SELECT 0 AS invalid_count", True, 1),
        ("SELECT 3 AS invalid_count", False, 1),
        ("SELECT 0 AS fail_count", True, 1),
        ("SELECT 2 AS fail_count", False, 1),
        ("SELECT 0 AS invalid_count, 5 AS fail_count", True, 1),
        ("SELECT 5 AS invalid_count, 0 AS fail_count", False, 1),
        ("SELECT CAST(NULL AS int) AS invalid_count", False, 1),
        ("SELECT 0 AS null_count", False, 1),
        ("SELECT 0 AS INVALID_COUNT", False, 1),
        ("SELECT 1 AS x WHERE false", True, 0),
        ("SELECT 1 AS invalid_count WHERE false", True, 0),
        ("SELECT id AS invalid_count FROM range(3) ORDER BY id", True, 3),
        ("SELECT id AS invalid_count FROM range(3) ORDER BY id DESC", False, 3),
    ],
)
def test_verdict_rule(spark, text, passed, rows):
    record = run_check(Check.of("check_x", spark.sql(text)))
    assert (record.passed, record.returned_rows, record.target) == (passed, rows, "check_x")


def test_error_is_a_failed_check_and_does_not_spread(spark):
    orders = orders_source(spark)
    suite = run_suite(
        spark,
        [
            Check.counting("check_good", orders, lambda o: o.price < 0),
            Check.counting("check_raises", orders, lambda o: F.lit(1) / (o.quantity - 1) > 5),
            Check.counting("check_unbound", orders, lambda o: o.no_such_field),
        ],
    )
    good, raises, unbound = suite.collect()
    assert good.passed
    assert not raises.passed and raises.description.startswith("could not run: ")
    assert not unbound.passed and "no_such_field" in unbound.description


def test_suite_equals_single_checks(spark):
    orders = orders_source(spark, BAD_ORDERS)
    checks = [
        Check.counting("check_a", orders, lambda o: o.customers.state == "CA"),
        Check.counting("check_b", orders, lambda o: o.customers.name.isNull()),
        Check.offending("check_c", orders, lambda o: o.line_item_amount < 1),
        Check.of("check_d", orders.query(view().aggregate(invalid_count=count()))),
    ]
    assert run_suite(spark, checks).collect() == [run_check(check) for check in checks]


def test_offending_rows_are_the_source_rows(spark):
    orders = orders_source(spark, BAD_ORDERS)
    frame = Check.offending("check_c", orders, lambda o: o.price <= 0).result()
    assert sorted(row.id for row in frame.collect()) == [8, 9]
    assert "line_item_amount" in frame.columns


def test_checks_across_a_fan_out_count_source_rows_once(spark):
    lines = Source("lines", spark.createDataFrame([(1, 5), (1, 6), (2, 7)], "order_id int, q int"))
    orders = Source("orders", spark.createDataFrame([(1,), (2,), (3,)], "id int")).primary_key("id")
    orders = orders.join_many(lines, {"id": "order_id"})
    check = Check.counting("check_lines", orders, lambda o: o.lines.q > 4)
    (record,) = run_suite(spark, [check, check]).limit(1).collect()
    assert record.description == "invalid_count is 2; it should be 0"


def test_fused_checks_scan_once(spark, tmp_path):
    path = str(tmp_path / "orders.parquet")
    spark.createDataFrame(ORDERS, "id bigint, c bigint, p bigint, price double, q bigint, d string").write.parquet(path)
    source = Source("orders", spark.read.parquet(path))
    frame = fused_counts(source, [lambda o: o.price <= 0, lambda o: o.c.isNull(), lambda o: o.q > 5])
    plan = frame._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1
    assert "PushedFilters: [Or(" in plan
    assert tuple(frame.first()) == (0, 0, 1)


def test_a_suite_is_one_job(spark, tmp_path):
    """Shared scans, checks of views and checks by rows: one job, and one read for a source and its views."""
    path = str(tmp_path / "orders.parquet")
    spark.createDataFrame(ORDERS, "id bigint, c bigint, p bigint, price double, q bigint, d string").write.parquet(path)
    source = Source("orders", spark.read.parquet(path)).measure(orders=count())
    again = Source("orders_again", spark.read.parquet(path))
    dear = source.view(check_dear=view().where(lambda o: o.price > 1000).aggregate(fail_count="orders"))
    checks = [
        Check.counting("check_price", source, lambda o: o.price <= 0),
        Check.counting("check_c", again, lambda o: o.c.isNull()),
        *checks_of(dear),
        Check.of_view("check_groups", source, view().group_by("c").aggregate("orders")),
        Check.of("check_frame", spark.range(1).selectExpr("0L AS invalid_count")),
    ]
    tracker, group = spark.sparkContext.statusTracker(), "one-suite"
    spark.sparkContext.setJobGroup(group, group)
    try:
        suite = run_suite(spark, checks)
        jobs = tracker.getJobIdsForGroup(group)
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert verdicts(suite) == [
        ("check_price", True, 1), ("check_c", True, 1), ("check_dear", False, 1), ("check_groups", False, 5), ("check_frame", True, 1)
    ]
    assert len(_shared_scans(checks)) == 3
    # Adaptive execution submits the map stage of each shuffle as a job of its own.
    stages = {stage for job in jobs for stage in tracker.getJobInfo(job).stageIds}
    assert len(stages) <= 8
    assert suite.collect() == [run_check(check) for check in checks]


def test_names_of_checks():
    assert [is_check(n) for n in ("check_a", "test_a", "assert_a", "sales")] == [True, True, True, False]
    assert is_check("sales", flagged=True)


def test_views_named_like_checks_are_checks(spark):
    counted = view().where(lambda o: o.customer_id.isNull(), lambda o: o.price <= 0)
    orders = orders_source(spark, BAD_ORDERS).view(
        check_free_and_anonymous=counted.aggregate(invalid_count=count()),
        check_named_measure=view().where(lambda o: o.price <= 0).aggregate(fail_count="total_orders"),
        check_other_name=view().where(lambda o: o.price < -100).aggregate(null_count=count()),
        test_grouped=view().where(lambda o: o.price < 0).group_by("customers.name"),
        assert_wrong=view().aggregate(invalid_count="no_such_measure"),
    )
    checks = checks_of(orders)
    assert [check.column for check in checks] == ["invalid_count", "fail_count", "null_count", None, None]
    assert verdicts(run_suite(spark, checks)) == [
        ("check_free_and_anonymous", False, 1),
        ("check_named_measure", False, 1),
        ("check_other_name", False, 1),
        ("test_grouped", False, 1),
        ("assert_wrong", False, 0),
    ]
