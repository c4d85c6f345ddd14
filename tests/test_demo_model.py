import pytest
from demo import customers_source, executive_sales, orders_source
from pyspark.sql import functions as F

from semlayer import Source, count, derived, ratio, sum_of, view

pytestmark = pytest.mark.usefixtures("join_strategy")


def rows(frame):
    return sorted(tuple(row) for row in frame.collect())


def test_customer_analytics(spark):
    assert rows(orders_source(spark).query("customer_performance")) == [
        ("Alice Smith", "Enterprise", "CA", 2, 3100.0, 1550.0),
        ("Bob Jones", "SMB", "NY", 2, 550.0, 275.0),
        ("Charlie Brown", "Consumer", "TX", 1, 140.0, 140.0),
        ("Diana Prince", "Enterprise", "CA", 1, 550.0, 550.0),
        ("Evan Wright", "SMB", "WA", 1, 1200.0, 1200.0),
    ]


def test_high_value_orders(spark):
    high = (
        view()
        .where(lambda o: o.line_item_amount >= 300.0)
        .group_by("customers.name", "price", "quantity")
        .aggregate("total_revenue")
    )
    assert rows(orders_source(spark).query(high)) == [
        ("Alice Smith", 350.0, 2, 700.0),
        ("Alice Smith", 1200.0, 2, 2400.0),
        ("Bob Jones", 35.0, 10, 350.0),
        ("Diana Prince", 550.0, 1, 550.0),
        ("Evan Wright", 1200.0, 1, 1200.0),
    ]


def test_executive_sales(spark):
    (row,) = orders_source(spark).query(executive_sales()).collect()
    assert (row.total_revenue, row.total_orders) == (5540.0, 7)
    assert row.avg_order_value == pytest.approx(791.4285714285714)
    assert sorted(map(tuple, row.category_performance)) == [
        ("Electronics", "Consumer", 140.0),
        ("Electronics", "Enterprise", 3100.0),
        ("Electronics", "SMB", 1550.0),
        ("Furniture", "Enterprise", 550.0),
        ("Furniture", "SMB", 200.0),
    ]
    assert [tuple(day) for day in row.daily_sales_trend] == [
        ("2026-08-01", 2400.0, 1),
        ("2026-08-05", 1550.0, 2),
        ("2026-08-03", 700.0, 1),
        ("2026-08-04", 550.0, 1),
        ("2026-08-02", 340.0, 2),
    ]
    assert [(c.name, c.total_revenue) for c in row.top_customers] == [
        ("Alice Smith", 3100.0),
        ("Evan Wright", 1200.0),
        ("Bob Jones", 550.0),
        ("Diana Prince", 550.0),
        ("Charlie Brown", 140.0),
    ]


def test_dashboard_of_nothing_is_one_row_of_empty_arrays(spark):
    nothing = executive_sales().where(lambda o: o.price < 0)
    (row,) = orders_source(spark).query(nothing).collect()
    assert tuple(row) == (None, 0, None, [], [], [])


def test_tie_at_the_limit_is_broken_by_key(spark):
    top = view().group_by("customers.name").aggregate("total_revenue").limit(3)
    names = [row.name for row in orders_source(spark).query(top).collect()]
    assert names == ["Alice Smith", "Evan Wright", "Bob Jones"]


def test_nest_of_groups_equals_its_flat_rows(spark):
    orders = orders_source(spark)
    outer = view().group_by("customers.state").nest("category_performance")
    nested = orders.query(outer).select("state", F.inline("category_performance"))
    flat = orders.nest_rows(outer, "category_performance")
    assert nested.columns == flat.columns
    assert rows(nested) == rows(flat)


def test_limited_nest_with_rank(spark):
    best = view().group_by("customers.name").aggregate("total_revenue").limit(1)
    outer = view().group_by("customers.segment").nest(best=best)
    flat = orders_source(spark).nest_rows(outer, "best", rank="place")
    assert rows(flat) == [
        ("Consumer", "Charlie Brown", 140.0, 1),
        ("Enterprise", "Alice Smith", 3100.0, 1),
        ("SMB", "Evan Wright", 1200.0, 1),
    ]


def test_nest_may_share_the_outer_key_and_hold_nests(spark):
    inner = (
        view()
        .group_by("customers.state", "customers.name")
        .aggregate("total_revenue")
        .nest("daily_sales_trend")
        .limit(1)
    )
    outer = view().group_by("customers.state").aggregate("total_orders").nest(best=inner)
    found = {row.state: row.best for row in orders_source(spark).query(outer).collect()}
    assert set(found) == {"CA", "NY", "TX", "WA"}
    (best,) = found["CA"]
    assert (best.state, best.name, best.total_revenue) == ("CA", "Alice Smith", 3100.0)
    assert [day.order_date for day in best.daily_sales_trend] == ["2026-08-01", "2026-08-03"]


def test_nest_emptied_by_its_own_filter_is_an_empty_array(spark):
    rich = view().where(lambda o: o.line_item_amount > 1000).group_by("order_date")
    limited = rich.aggregate("total_orders").limit(2)
    outer = view().group_by("customers.state").nest(rich=rich, limited=limited)
    found = {row.state: (row.rich, row.limited) for row in orders_source(spark).query(outer).collect()}
    assert found["NY"] == ([], [])
    assert [len(part) for part in found["WA"]] == [1, 1]


def test_nest_of_a_query_alone_gives_one_row(spark):
    (row,) = orders_source(spark).query(view().nest("daily_sales_trend")).collect()
    assert len(row.daily_sales_trend) == 5


def test_nest_follows_a_stated_order(spark):
    by_date = view().group_by("order_date").aggregate("total_orders").order_by("-order_date")
    (row,) = orders_source(spark).query(view().nest(days=by_date)).collect()
    dates = [day.order_date for day in row.days]
    assert dates == sorted(dates, reverse=True)


def test_stages(spark):
    orders = orders_source(spark)
    by_category = view().group_by("products.category").aggregate("total_revenue")
    top = view().order_by("-total_revenue").top(1)
    assert rows(orders.query(by_category, top)) == [("Electronics", 4790.0)]
    doubled = view().select("category", twice=lambda r: r.total_revenue * 2)
    assert rows(orders.query(by_category, top, doubled)) == [("Electronics", 9580.0)]


def test_select_star_is_columns_and_dimensions(spark):
    frame = orders_source(spark).query(view().select("*"))
    assert frame.columns == [
        "id", "customer_id", "product_id", "price", "quantity", "order_date", "line_item_amount"
    ]
    assert frame.count() == 7


def test_order_places_nulls_last_both_ways(spark):
    source = Source("t", spark.createDataFrame([(1,), (None,), (2,)], "x int"))
    up = [r.x for r in source.query(view().select("x").order_by("x")).collect()]
    down = [r.x for r in source.query(view().select("x").order_by("-x")).collect()]
    assert (up, down) == ([1, 2, None], [2, 1, None])


def test_rows_without_customer_survive(spark):
    extra = [(8, None, 101, 10.0, 1, "2026-08-06"), (9, 77, 101, 10.0, 1, "2026-08-06")]
    orders = orders_source(spark, rows=[*extra])
    by_name = view().group_by("customers.name").aggregate("total_orders")
    assert rows(orders.query(by_name)) == [(None, 2)]


def test_empty_source(spark):
    orders = orders_source(spark, rows=[])
    assert rows(orders.query(view().aggregate("total_orders", "total_revenue"))) == [(0, None)]
    assert rows(orders.query("daily_sales_trend")) == []


def test_zero_denominator_is_null(spark):
    orders = orders_source(spark)
    none = view().aggregate(share=ratio("total_orders", count().where(lambda o: o.price < 0)))
    assert rows(orders.query(none)) == [(None,)]


def test_filtered_and_derived_measures(spark):
    orders = orders_source(spark)
    ca = lambda o: o.customers.state == "CA"
    measures = view().aggregate(
        "high_value_order_count",
        ca_average=ratio("total_revenue", "total_orders").where(ca),
        others=derived(lambda a, b: a - b, "total_orders", count().where(ca)),
        inline=sum_of(lambda o: o.price * o.quantity),
    )
    assert rows(orders.query(measures)) == [(5, 3650.0 / 3, 4, 5540.0)]


def test_extension_inherits_and_adds(spark):
    child = orders_source(spark).extend("orders_2").dimension(year=lambda o: o.order_date[0:4])
    by_year = view().group_by("year").aggregate("total_orders")
    assert rows(child.query(by_year)) == [("2026", 7)]
    assert "year" not in orders_source(spark).dimensions
    assert set(child.upstream()) == {
        ("orders_2", "customers"),
        ("orders_2", "products"),
        ("orders_2", "orders"),
        ("orders", "customers"),
        ("orders", "products"),
    }


def test_declaration_errors(spark):
    orders = orders_source(spark)
    with pytest.raises(ValueError):
        orders.dimension(price=lambda o: o.quantity)
    with pytest.raises(AttributeError):
        orders.dimension(wrong=lambda o: o.no_such_field)
    with pytest.raises(AttributeError):
        orders.measure(wrong=ratio("total_revenue", "no_such_measure"))
    with pytest.raises(ValueError):
        orders.join_one(customers_source(spark), {}, name="again")
    with pytest.raises(ValueError):
        orders.primary_key("nope")
    with pytest.raises(TypeError):
        orders.dimension(constant=F.lit(1))
    with pytest.raises(KeyError):
        orders.query("no_such_view")
    with pytest.raises(ValueError):
        view().group_by("customers.name", "products.name")
    with pytest.raises(ValueError):
        view().select("a").group_by("b")
