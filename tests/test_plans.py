"""What the plans must not contain, and answers under skew."""

import pytest
from pyspark.sql import functions as F

from semlayer import Source, count, file_source, sum_of, view

THRESHOLD = "spark.sql.autoBroadcastJoinThreshold"


def plan_of(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def model(spark, tmp_path):
    def stored(name, frame):
        frame.write.parquet(str(tmp_path / f"{name}.parquet"))
        return file_source(spark, name, str(tmp_path / f"{name}.parquet"))

    # a third of the lines belong to order 0, a third of the orders to customer 0
    orders = spark.range(300).selectExpr(
        "id", "IF(id % 3 = 0, 0, id % 50) AS customer_id", "id * 1.5D AS price", "id % 4 AS kind"
    )
    lines = spark.range(3000).selectExpr(
        "IF(id % 3 = 0, 0, id % 290) AS order_id", "id % 7 AS q", "CAST(id % 5 AS string) AS flag"
    )
    customers = spark.range(50).selectExpr("id", "CAST(id % 3 AS string) AS segment", "id * 10L AS balance")
    customer = stored("customers", customers).primary_key("id")
    customer = customer.measure(customers=count(), balances=sum_of("balance"))
    return (
        stored("orders", orders)
        .primary_key("id")
        .join_one(customer, {"customer_id": "id"})
        .join_many(stored("lines", lines).measure(lines=count(), quantity=sum_of("q")), {"id": "order_id"})
        .measure(total=sum_of("price"), orders=count())
    )


def test_unused_joins_are_absent(spark, model):
    frame = model.query(view().group_by("kind").aggregate("total"))
    plan = plan_of(frame)
    assert "Join" not in plan and plan.count("FileScan") == 1
    assert "ReadSchema: struct<price:double,kind:bigint>" in plan


def test_only_needed_columns_are_read(spark, model):
    plan = plan_of(model.query(view().group_by("customers.segment").aggregate("total")))
    assert "ReadSchema: struct<customer_id:bigint,price:double>" in plan
    assert "ReadSchema: struct<id:bigint,segment:string>" in plan


def test_child_filter_reaches_the_scan(spark, model):
    returned = view().where(lambda o: o.lines.q > 5).group_by("kind").aggregate("orders")
    plan = plan_of(model.query(returned))
    assert "GreaterThan(q,5)" in plan
    assert "Inner" in plan and "LeftOuter" not in plan


def test_large_join_sums_first_and_adds_no_shuffle(spark, model):
    before = spark.conf.get(THRESHOLD)
    spark.conf.set(THRESHOLD, "-1")
    try:
        plan = plan_of(model.query(view().group_by("customers.segment").aggregate("total")))
    finally:
        spark.conf.set(THRESHOLD, before)
    assert plan.count("Exchange hashpartitioning") == 3  # orders' sums, customers, the result
    assert plan.index("SortMergeJoin") < plan.index("partial_sum", plan.index("SortMergeJoin"))


def test_two_homes_read_each_table_once(spark, model):
    frame = model.query(view().group_by("lines.flag").aggregate("total", "lines.lines"))
    plan = plan_of(frame)
    assert plan.count("FileScan") == 2 and "Union" not in plan


def test_children_are_summed_before_their_join(spark, model):
    before = spark.conf.get(THRESHOLD)
    spark.conf.set(THRESHOLD, "-1")
    try:
        frame = model.query(view().group_by("kind").aggregate("lines.quantity", "orders"))
        plan = plan_of(frame)
    finally:
        spark.conf.set(THRESHOLD, before)
    assert plan.index("SortMergeJoin") < plan.index("partial_sum(", plan.index("SortMergeJoin"))
    assert plan.count("Exchange hashpartitioning") == 3


def test_hot_keys_on_the_many_side_can_be_split(spark, model):
    """Adaptive execution splits inner joins on both sides, left joins never on the right."""
    by_flag = view().group_by("lines.flag").aggregate("total", "lines.quantity")
    rows = view().select("id", "lines.q")
    small = [sorted(map(repr, model.query(v).collect())) for v in (by_flag, rows)]
    before = spark.conf.get(THRESHOLD)
    spark.conf.set(THRESHOLD, "-1")
    try:
        frames = [model.query(v) for v in (by_flag, rows)]
        for frame in frames:
            plan = plan_of(frame)
            assert "Inner" in plan and "LeftAnti" in plan and "LeftOuter" not in plan
        large = [sorted(map(repr, frame.collect())) for frame in frames]
    finally:
        spark.conf.set(THRESHOLD, before)
    assert small == large


def test_a_hot_order_is_split_at_run_time(spark, tmp_path):
    lines = spark.range(120_000).selectExpr("IF(id % 3 = 0, 0, id) AS order_id", "id AS q")
    lines.repartition(8).write.parquet(str(tmp_path / "lines.parquet"))
    spark.range(40_000).write.parquet(str(tmp_path / "orders.parquet"))
    child = file_source(spark, "lines", str(tmp_path / "lines.parquet"))
    orders = file_source(spark, "orders", str(tmp_path / "orders.parquet")).primary_key("id")
    orders = orders.join_many(child, {"id": "order_id"})
    settings = {
        THRESHOLD: "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "100KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "50KB",
    }
    before = {name: spark.conf.get(name, None) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        frame = orders.query(view().select("id", "lines.q"))
        found = frame.agg(F.count("q"), F.count("id")).collect()[0]
        frame.collect()
        plan = plan_of(frame)
    finally:
        for name, value in before.items():
            spark.conf.set(name, value) if value is not None else spark.conf.unset(name)
    matched = 40_000 + sum(1 for i in range(40_000) if i % 3)
    assert tuple(found) == (matched, matched + sum(1 for i in range(1, 40_000) if i % 3 == 0))
    assert "skew=true" in plan


def test_limited_nest_limits_before_its_shuffle(spark, model):
    best = view().group_by("id").aggregate("total").limit(2)
    outer = view().group_by("customers.segment").nest(best=best)
    plan = plan_of(model.nest_rows(outer, "best", rank="place"))
    assert plan.count("WindowGroupLimit") == 2


def test_global_limited_nest_sorts_in_parallel(spark, model):
    best = view().group_by("id").aggregate("total").limit(2)
    plan = plan_of(model.query(view().nest(best=best)))
    assert "TakeOrderedAndProject" in plan and "Window " not in plan


def test_dashboard_shares_one_read(spark, model):
    by_kind = view().group_by("kind").aggregate("orders")
    by_segment = view().group_by("customers.segment").aggregate("total")
    plan = plan_of(model.query(view().aggregate("total").nest(by_kind=by_kind, by_segment=by_segment)))
    assert plan.count("Expand") == 1 and plan.count("FileScan") == 2


@pytest.mark.parametrize("threshold", ["10485760", "-1"])
def test_hot_keys_give_whole_results(spark, model, threshold):
    before = spark.conf.get(THRESHOLD)
    spark.conf.set(THRESHOLD, threshold)
    try:
        by_segment = view().group_by("customers.segment").aggregate("orders", "lines.lines", "customers.balances")
        found = model.query(by_segment).agg(F.sum("orders"), F.sum("lines"), F.sum("balances")).first()
        assert found[0] == 300 and found[1] == 3000
        assert found[2] == model.query(view().aggregate("customers.balances")).first()[0]
        by_flag = model.query(view().group_by("lines.flag").aggregate("lines.quantity", "orders"))
        assert by_flag.agg(F.sum("quantity")).first()[0] == sum(i % 7 for i in range(3000))
    finally:
        spark.conf.set(THRESHOLD, before)


def test_joins_leave_root_measures_alone(spark, model):
    plain = view().group_by("kind").aggregate("total", "orders")
    wide = plain.aggregate("lines.lines", "customers.customers")
    narrow = {r.kind: (r.total, r.orders) for r in model.query(plain).collect()}
    assert {r.kind: (r.total, r.orders) for r in model.query(wide).collect()} == narrow


def test_missing_primary_key_is_an_error(spark):
    child = Source("lines", spark.createDataFrame([(1, 2)], "order_id int, q int"))
    root = Source("orders", spark.createDataFrame([(1,)], "id int")).join_many(child, {"id": "order_id"})
    with pytest.raises(ValueError, match="primary key"):
        root.query(view().where(lambda o: o.lines.q > o.id).aggregate(n=count()))
    assert root.query(view().where(lambda o: o.lines.q > 1).aggregate(n=count())).first().n == 1
    assert root.query(view().group_by("lines.q").aggregate(n=count())).count() == 1


def test_measure_over_a_fanned_out_field_is_an_error(spark, model):
    with pytest.raises(ValueError, match="no single row"):
        model.query(view().aggregate(wrong=sum_of("lines.q")))


def test_cross_join_counts_both_sides_once(spark):
    left = Source("left", spark.createDataFrame([(1, "a"), (2, "a"), (3, "b")], "id int, k string"))
    right = Source("right", spark.createDataFrame([(1, "x"), (2, "y"), (3, "y")], "id int, k string"))
    both = left.join_cross(right).measure(lefts=count())
    by_left = both.query(view().group_by("k").aggregate("lefts", rights=count("right")))
    assert sorted(map(tuple, by_left.collect())) == [("a", 2, 3), ("b", 1, 3)]
    pairs = both.query(view().group_by("k", other="right.k").aggregate("lefts", rights=count("right")))
    assert sorted(map(tuple, pairs.collect())) == [
        ("a", "x", 2, 1), ("a", "y", 2, 2), ("b", "x", 1, 1), ("b", "y", 1, 2)
    ]
    only = both.query(view().where(lambda s: s.right.k == "y").aggregate("lefts", rights=count("right")))
    assert sorted(map(tuple, only.collect())) == [(3, 2)]
    with pytest.raises(ValueError, match="every pair"):
        both.query(view().where(lambda s: s.id == s.right.id).aggregate("lefts"))
    with pytest.raises(ValueError, match="every pair"):
        both.query(view().select("id", "right.k"))
    pruned = both.query(view().group_by("k").aggregate("lefts"))
    assert "Join" not in plan_of(pruned)


@pytest.fixture
def crossed(spark):
    left = Source("left", spark.createDataFrame([(1, "a"), (2, "a"), (3, "b")], "id int, k string"))
    right = Source("right", spark.createDataFrame([(1, "x"), (2, "y"), (3, "y")], "id int, k string"))
    return left.join_cross(right).measure(lefts=count())


def rows(frame):
    return sorted(map(tuple, frame.collect()), key=repr)


def test_cross_join_where_no_far_row_passes(crossed):
    nothing = view().where(lambda s: s.right.k == "nope")
    assert rows(crossed.query(nothing.aggregate("lefts"))) == [(0,)]
    assert rows(crossed.query(nothing.aggregate("lefts", rights=count("right")))) == [(0, 0)]
    assert rows(crossed.query(nothing.group_by("k").aggregate("lefts", rights=count("right")))) == []


def test_cross_join_where_no_near_row_passes(crossed):
    nothing = view().where(lambda s: s.k == "nope")
    assert rows(crossed.query(nothing.aggregate(rights=count("right")))) == [(0,)]
    assert rows(crossed.query(nothing.group_by(other="right.k").aggregate(rights=count("right")))) == []


def test_cross_join_of_an_empty_side(spark):
    left = Source("left", spark.createDataFrame([(1, "a"), (2, "a")], "id int, k string"))
    right = Source("right", spark.createDataFrame([], "id int, k string"))
    both = left.join_cross(right).measure(lefts=count())
    grouped = both.query(view().group_by(other="right.k").aggregate("lefts", rights=count("right")))
    assert rows(grouped) == [(None, 2, 0)]
    assert rows(both.query(view().aggregate("lefts", rights=count("right")))) == [(2, 0)]


@pytest.fixture
def filed(spark, tmp_path):
    """Orders and lines in files, a third of the lines of one order, joined as if both were large."""
    lines = spark.range(120_000).selectExpr(
        "IF(id % 3 = 0, 0, id) AS order_id", "id AS serial", "id % 97 AS q", "CAST(id % 5 AS string) AS flag"
    )
    lines.repartition(8).write.parquet(str(tmp_path / "lines.parquet"))
    orders = spark.range(40_000).selectExpr("id", "id % 10 AS kind", "id % 211 AS price")
    orders.write.parquet(str(tmp_path / "orders.parquet"))
    lines = file_source(spark, "lines", str(tmp_path / "lines.parquet")).measure(lines=count(), quantity=sum_of("q"))
    orders = file_source(spark, "orders", str(tmp_path / "orders.parquet")).primary_key("id")
    orders = orders.measure(orders=count(), total=sum_of("price"))
    settings = {
        THRESHOLD: "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "100KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "50KB",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    before = {name: spark.conf.get(name, None) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    yield orders.join_many(lines, {"id": "order_id"}), lines.join_one(orders, {"order_id": "id"})
    for name, value in before.items():
        spark.conf.set(name, value) if value is not None else spark.conf.unset(name)


def run_and_plan(frame):
    found = frame.collect()
    return found, plan_of(frame).split("== Initial Plan ==")[0]


def test_a_reduced_side_is_read_once(filed):
    """The joined rows and those without a match share the reads of both sides."""
    orders, _ = filed
    found, plan = run_and_plan(orders.query(view().group_by("lines.flag").aggregate("orders", "lines.lines")))
    assert plan.count("FileScan") == 2 and "ReusedExchange" in plan and "LeftAnti" in plan
    assert sum(row.lines for row in found) == 40_000 + sum(1 for i in range(40_000) if i % 3)
    by_flag = view().group_by("lines.flag").aggregate("total")
    found, plan = run_and_plan(orders.query(by_flag))
    assert plan.count("FileScan") == 2 and len(found) == 6


def test_one_sided_keys_and_conditions_need_no_deduplication(filed):
    """Both are computed on the many side; orders without lines get their value on nulls."""
    orders, _ = filed
    odd = view().group_by(half=lambda o: F.coalesce(o.lines.q % 2, F.lit(-1))).aggregate("orders", "total")
    found, plan = run_and_plan(orders.query(odd))
    assert "__row" not in plan and plan.count("FileScan") == 2
    alone = sum(1 for i in range(1, 40_000) if i % 3 == 0)
    assert {row.half: row.orders for row in found}[-1] == alone
    some = count().where(lambda o: o.lines.flag == "2")
    none = count().where(lambda o: o.lines.flag.isNull())
    found, plan = run_and_plan(orders.query(view().aggregate("orders", some=some, none=none)))
    assert "__row" not in plan and plan.count("FileScan") == 2 and "LeftAnti" not in plan
    with_two = {(0 if i % 3 == 0 else i) for i in range(120_000) if i % 5 == 2 and (i % 3 == 0 or i < 40_000)}
    assert tuple(found[0]) == (40_000, len(with_two), alone)


def test_a_late_filter_on_one_side_needs_no_deduplication(filed):
    orders, _ = filed
    kept = view().where(lambda o: F.coalesce(o.lines.flag, F.lit("2")) == "2").aggregate("orders", "total")
    found, plan = run_and_plan(orders.query(kept))
    matched = {(0 if i % 3 == 0 else i) for i in range(120_000) if i % 5 == 2 and (i % 3 == 0 or i < 40_000)}
    kept = matched | {i for i in range(1, 40_000) if i % 3 == 0}
    assert tuple(found[0]) == (len(kept), sum(i % 211 for i in kept)) and "__row" not in plan


def test_a_hot_key_under_deduplication_is_split(filed):
    """A filter over both sides: each task drops its own repeats, and the rest is dealt anew."""
    orders, _ = filed
    both = view().where(lambda o: (o.lines.serial + o.price) % 2 == 0).group_by("kind").aggregate("orders")
    found, plan = run_and_plan(orders.query(both))
    assert "skew=true" in plan and "__row" in plan
    kept = {}
    for i in range(120_000):
        order = 0 if i % 3 == 0 else i
        if order < 40_000 and (i + order % 211) % 2 == 0:
            kept.setdefault(order % 10, set()).add(order)
    assert {row.kind: row.orders for row in found} == {kind: len(ids) for kind, ids in kept.items()}


def test_root_and_one_side_measures_share_a_read(filed):
    _, lines = filed
    found, plan = run_and_plan(lines.query(view().group_by("flag").aggregate("lines", "orders.orders", "orders.total")))
    assert plan.count("FileScan") == 2
    assert sum(row.lines for row in found) == 120_000
    orders_of = {}
    for i in range(120_000):
        order = 0 if i % 3 == 0 else i
        if order < 40_000:
            orders_of.setdefault(str(i % 5), set()).add(order)
    assert {row.flag: row.orders for row in found} == {flag: len(ids) for flag, ids in orders_of.items()}
    by_kind = view().group_by("orders.kind").aggregate("lines", "orders.orders")
    found, plan = run_and_plan(lines.query(by_kind))
    assert plan.count("FileScan") == 2 and sum(row.lines for row in found) == 120_000
    assert sum(row.orders for row in found) == len(set().union(*orders_of.values()))


def test_limited_and_whole_nests_share_a_read(filed):
    """Limited nests are ranked among the grouping sets, cut in each task before the shuffle."""
    orders, _ = filed
    top = view().group_by("id").aggregate("total").limit(2)
    dear = view().where(lambda o: o.price > 209).group_by("price").aggregate("orders").order_by("price").limit(3)
    outer = view().group_by("kind").aggregate("orders")
    found, plan = run_and_plan(orders.query(outer.nest(top=top, dear=dear, prices=view().group_by("price").aggregate("orders"))))
    assert plan.count("FileScan") == 2  # `dear` has the keys of `prices`, so it has a read of its own
    assert "WindowGroupLimit" in plan
    rows = [(i, i % 211, i % 10) for i in range(40_000)]
    for row in found:
        own = [(i, price) for i, price, kind in rows if kind == row.kind]
        best = sorted(own, key=lambda r: (-r[1], r[0]))[:2]
        assert [tuple(r) for r in row.top] == best and row.orders == len(own)
        assert sum(r.orders for r in row.prices) == len(own) and len(row.prices) == 211
        assert [tuple(r) for r in row.dear] == [(210, sum(price == 210 for _, price in own))]
    found, plan = run_and_plan(orders.query(view().aggregate("total").nest(top=top, none=top.limit(0).group_by("kind"))))
    assert plan.count("FileScan") == 1
    assert len(found) == 1 and len(found[0].top) == 2 and found[0].none == [] and found[0].total == sum(r[1] for r in rows)
