"""The seven-order demo model and its rows."""

from semlayer import Source, count, ratio, sum_of, view

CUSTOMERS = [
    (1, "Alice Smith", "Enterprise", "CA"),
    (2, "Bob Jones", "SMB", "NY"),
    (3, "Charlie Brown", "Consumer", "TX"),
    (4, "Diana Prince", "Enterprise", "CA"),
    (5, "Evan Wright", "SMB", "WA"),
]
PRODUCTS = [
    (101, "Laptop Pro 15", "Electronics", 800.0),
    (102, "Ergonomic Chair", "Furniture", 150.0),
    (103, "Wireless Mouse", "Electronics", 25.0),
    (104, "4K Monitor", "Electronics", 300.0),
    (105, "Standing Desk", "Furniture", 450.0),
]
ORDERS = [
    (1, 1, 101, 1200.0, 2, "2026-08-01"),
    (2, 2, 102, 200.0, 1, "2026-08-02"),
    (3, 3, 103, 35.0, 4, "2026-08-02"),
    (4, 1, 104, 350.0, 2, "2026-08-03"),
    (5, 4, 105, 550.0, 1, "2026-08-04"),
    (6, 5, 101, 1200.0, 1, "2026-08-05"),
    (7, 2, 103, 35.0, 10, "2026-08-05"),
]
CUSTOMER_SCHEMA = "id bigint, name string, segment string, state string"
PRODUCT_SCHEMA = "id bigint, title string, category string, base_cost double"
ORDER_SCHEMA = (
    "id bigint, customer_id bigint, product_id bigint, price double, quantity bigint, "
    "order_date string"
)


def customers_source(spark, rows=CUSTOMERS):
    return Source("customers", spark.createDataFrame(rows, CUSTOMER_SCHEMA)).primary_key("id")


def products_source(spark, rows=PRODUCTS):
    return Source("products", spark.createDataFrame(rows, PRODUCT_SCHEMA)).primary_key("id")


def orders_source(spark, rows=ORDERS):
    return (
        Source("orders", spark.createDataFrame(rows, ORDER_SCHEMA))
        .primary_key("id")
        .join_one(customers_source(spark), {"customer_id": "id"})
        .join_one(products_source(spark), {"product_id": "id"})
        .dimension(line_item_amount=lambda o: o.price * o.quantity)
        .measure(
            total_revenue=sum_of("line_item_amount"),
            total_orders=count(),
            avg_order_value=ratio("total_revenue", "total_orders"),
            high_value_order_count=count().where(lambda o: o.line_item_amount >= 300.0),
        )
        .view(
            customer_performance=view()
            .group_by("customers.name", "customers.segment", "customers.state")
            .aggregate("total_orders", "total_revenue", "avg_order_value"),
            category_performance=view()
            .group_by("products.category", "customers.segment")
            .aggregate("total_revenue"),
            daily_sales_trend=view()
            .group_by("order_date")
            .aggregate("total_revenue", "total_orders"),
        )
    )


def executive_sales():
    top = view().group_by("customers.name", "customers.segment").aggregate("total_revenue")
    return (
        view()
        .aggregate("total_revenue", "total_orders", "avg_order_value")
        .nest("category_performance", "daily_sales_trend", top_customers=top.limit(5))
    )
