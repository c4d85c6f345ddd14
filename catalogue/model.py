"""The supplied tables as sources with keys, joins, dimensions, measures and views."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from semlayer import Source, count, file_source, ratio, sum_of, view


class Model:
    """Sources are built on first use, so a query touches only the tables it needs."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder

    def table(self, name: str) -> Source:
        return file_source(self.spark, name, f"{self.folder}/{name}.parquet")

    @cached_property
    def region(self) -> Source:
        return self.table("region").primary_key("r_regionkey").measure(regions=count())

    @cached_property
    def nation(self) -> Source:
        return (
            self.table("nation")
            .primary_key("n_nationkey")
            .join_one(self.region, {"n_regionkey": "r_regionkey"})
            .measure(nations=count())
        )

    @cached_property
    def customer(self) -> Source:
        return (
            self.table("customer")
            .primary_key("c_custkey")
            .join_one(self.nation, {"c_nationkey": "n_nationkey"})
            .dimension(name="c_name", segment="c_mktsegment")
            .measure(customers=count(), balance=sum_of("c_acctbal"))
        )

    @cached_property
    def part(self) -> Source:
        return self.table("part").primary_key("p_partkey").measure(parts=count())

    @cached_property
    def orders(self) -> Source:
        return (
            self.table("orders")
            .primary_key("o_orderkey")
            .join_one(self.customer, {"o_custkey": "c_custkey"})
            .dimension(
                status="o_orderstatus",
                priority="o_orderpriority",
                order_date=lambda o: o.o_orderdate.cast("date"),
            )
            .measure(
                total_revenue=sum_of("o_totalprice"),
                total_orders=count(),
                avg_order_value=ratio("total_revenue", "total_orders"),
                high_value_orders=count().where(lambda o: o.o_totalprice >= 300000.0),
            )
            .view(
                customer_performance=view()
                .group_by("customer.name", "customer.segment")
                .aggregate("total_orders", "total_revenue", "avg_order_value"),
                segment_performance=view()
                .group_by("customer.segment", "status")
                .aggregate("total_revenue"),
                daily_trend=view()
                .group_by("order_date")
                .aggregate("total_revenue", "total_orders"),
                status_breakdown=view()
                .group_by("status")
                .aggregate("total_revenue", "total_orders"),
                top_customers=view()
                .group_by("customer.name")
                .aggregate("total_revenue")
                .limit(5),
            )
        )

    @cached_property
    def lineitem(self) -> Source:
        """Lines have no key: (l_orderkey, l_linenumber) repeats."""
        return (
            self.table("lineitem")
            .join_one(self.orders, {"l_orderkey": "o_orderkey"})
            .join_one(self.part, {"l_partkey": "p_partkey"})
            .dimension(net_price=lambda l: l.l_extendedprice * (1 - l.l_discount))
            .measure(lines=count(), quantity=sum_of("l_quantity"), net_revenue=sum_of("net_price"))
        )

    @cached_property
    def plain_lineitem(self) -> Source:
        return self.table("lineitem").measure(lines=count(), quantity=sum_of("l_quantity"))

    @cached_property
    def events(self) -> Source:
        return (
            self.table("events")
            .primary_key("event_id")
            .measure(events=count(), event_value=sum_of("value"))
        )

    @cached_property
    def orders_with_lines(self) -> Source:
        return self.orders.join_many(self.plain_lineitem, {"o_orderkey": "l_orderkey"}, name="items")

    @cached_property
    def orders_with_events(self) -> Source:
        """Many to many: several orders of a customer meet the same events."""
        return self.orders.join_many(self.events, {"o_custkey": "user_id"})

    @cached_property
    def customer_activity(self) -> Source:
        orders = self.table("orders").primary_key("o_orderkey")
        orders = orders.measure(total_orders=count(), total_revenue=sum_of("o_totalprice"))
        return self.customer.join_many(orders, {"c_custkey": "o_custkey"}).join_many(
            self.events, {"c_custkey": "user_id"}
        )

    @cached_property
    def nation_sales(self) -> Source:
        orders = self.table("orders").primary_key("o_orderkey")
        orders = orders.measure(total_orders=count(), total_revenue=sum_of("o_totalprice"))
        customers = (
            self.table("customer")
            .primary_key("c_custkey")
            .measure(customers=count(), balance=sum_of("c_acctbal"))
            .join_many(orders, {"c_custkey": "o_custkey"})
        )
        return self.nation.join_many(customers, {"n_nationkey": "c_nationkey"})

    @cached_property
    def region_pairs(self) -> Source:
        nations = self.table("nation").primary_key("n_nationkey").measure(nations=count())
        return self.region.join_cross(nations)

    @cached_property
    def documents(self) -> Source:
        labels = self.table("labels").primary_key("doc_id")
        return (
            self.table("documents")
            .primary_key("doc_id")
            .join_one(labels, {"doc_id": "doc_id"})
            .measure(documents=count())
        )

    @cached_property
    def measured_documents(self) -> Source:
        """Extends documents with the length of the whole text."""
        return (
            self.documents.extend("measured_documents")
            .dimension(body_len=lambda d: F.length(d.text))
            .measure(total_len=sum_of("body_len"))
        )
