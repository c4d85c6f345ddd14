"""Registered queries: name to a function of (session, folder of the tables)."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from catalogue.model import Model
from semlayer import (
    PREVIEW_ROWS,
    Check,
    Written,
    checks_of,
    count,
    materialize,
    materialize_sql,
    primary_key_violations,
    file_source,
    read_file,
    release,
    run_suite,
    shared_folder,
    sql_source,
    sum_of,
    table_source,
    transitive_closure,
    view,
    write_files,
)

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def model_of(spark: SparkSession, folder: str) -> Model:
    """A new model for each query, so that files are listed as they are now."""
    return Model(spark, folder)


def registered(function: Callable[[Model], DataFrame]) -> Callable[[Model], DataFrame]:
    QUERIES[function.__name__] = lambda spark, folder: function(model_of(spark, folder))
    return function


def rounded(frame: DataFrame, **scales: int) -> DataFrame:
    """Exact decimals for the named columns, so that float sums compare across engines."""
    return frame.withColumns(
        {name: F.col(name).cast(f"decimal(38,{scale})") for name, scale in scales.items()}
    )


# -- sources ----------------------------------------------------------------------------------


@registered
def scan_parquet(m: Model) -> DataFrame:
    return m.table("nation").query(view().select("*"))


@registered
def scan_csv(m: Model) -> DataFrame:
    return _round_trip(m, "csv", header="true")


@registered
def scan_tsv(m: Model) -> DataFrame:
    return _round_trip(m, "tsv", header="true", sep="\t")


@registered
def scan_json(m: Model) -> DataFrame:
    return _round_trip(m, "json")


@registered
def scan_orc(m: Model) -> DataFrame:
    return _round_trip(m, "orc")


def _round_trip(m: Model, extension: str, **options: str) -> DataFrame:
    customer = m.customer.frame
    file_format = "csv" if extension == "tsv" else extension
    path = f"{scratch(m.spark)}/run-{uuid.uuid4().hex}/customer.{extension}"
    write_files(customer, path, file_format, **options)
    return read_file(m.spark, path, customer.schema)


def _texts_round_trip(m: Model, file_format: str, name: str) -> DataFrame:
    """Texts with separators, quotes, blanks at the ends and line breaks, through files of text."""
    turns = m.table("conversations").frame
    path = f"{scratch(m.spark)}/run-{uuid.uuid4().hex}/{name}"
    write_files(turns, path, file_format)
    return file_source(m.spark, "turns", path, turns.schema, file_format).query(view().select("*"))


@registered
def scan_csv_texts(m: Model) -> DataFrame:
    return _texts_round_trip(m, "csv", "turns.csv")


@registered
def scan_tsv_texts(m: Model) -> DataFrame:
    return _texts_round_trip(m, "tsv", "turns.tsv")


@registered
def scan_json_texts(m: Model) -> DataFrame:
    return _texts_round_trip(m, "json", "turns.json")


@registered
def scan_folder(m: Model) -> DataFrame:
    """A folder without an extension."""
    return _texts_round_trip(m, "orc", "turns")


def scratch(spark: SparkSession) -> str:
    """Written results go to the folder all executors share."""
    return f"{shared_folder(spark)}/written"


@registered
def catalog_table(m: Model) -> DataFrame:
    stored(m, m.table("supplier").frame, "default.semlayer_supplier")
    source = table_source(m.spark, "spark_catalog.default.semlayer_supplier")
    balances = source.query(
        view().group_by("s_nationkey").aggregate(suppliers=count(), balance=sum_of("s_acctbal"))
    )
    return rounded(balances, balance=2)


@registered
def sql_source_select(m: Model) -> DataFrame:
    text = f"SELECT o_orderkey, o_orderstatus, o_totalprice FROM parquet.`{m.folder}/orders.parquet`"
    source = sql_source(m.spark, "order_values", text)
    return source.query(view().select("o_orderkey", "o_totalprice"))


@registered
def source_extend(m: Model) -> DataFrame:
    return m.measured_documents.query(
        view().group_by("lang").aggregate("documents", "total_len")
    )


@registered
def primary_key_violations_lines(m: Model) -> DataFrame:
    return primary_key_violations(m.plain_lineitem.primary_key("l_orderkey", "l_linenumber"))


# -- projection, filter, scalar ---------------------------------------------------------------


@registered
def select_columns(m: Model) -> DataFrame:
    return m.table("supplier").query(view().select("s_suppkey", "s_name"))


@registered
def select_star(m: Model) -> DataFrame:
    region = m.table("region").dimension(key_plus_one=lambda r: r.r_regionkey + 1)
    return region.query(view().select("*"))


@registered
def select_joined_field(m: Model) -> DataFrame:
    return m.orders.query(view().select("o_orderkey", "customer.name", "customer.nation.n_name"))


@registered
def row_limit_select(m: Model) -> DataFrame:
    """A row cap on a run: the dearest orders, ties by the other columns."""
    dearest = view().select("o_orderkey", "o_totalprice").order_by("-o_totalprice").limit(25)
    return m.orders.query(dearest)


@registered
def select_joined_many(m: Model) -> DataFrame:
    """One row per order and line, and one for each order without lines."""
    fields = view().select("o_orderkey", "items.l_partkey", "items.l_quantity")
    return m.orders_with_lines.query(fields)


@registered
def computed_dimension(m: Model) -> DataFrame:
    rows = m.lineitem.query(view().select("l_orderkey", "l_linenumber", "net_price"))
    return rounded(rows, net_price=4)


@registered
def rename_dimension(m: Model) -> DataFrame:
    return m.customer.query(view().select("c_custkey", "segment"))


@registered
def literal_dimension(m: Model) -> DataFrame:
    customer = m.customer.dimension(category=lambda c: F.lit("general"))
    return customer.query(view().group_by("category").aggregate("customers"))


@registered
def concat_dimension(m: Model) -> DataFrame:
    part = m.part.dimension(label=lambda p: F.concat(p.p_brand, F.lit(" "), p.p_type))
    return part.query(view().select("p_partkey", "label"))


@registered
def cast_dimension(m: Model) -> DataFrame:
    nation = m.nation.dimension(key_text=lambda n: n.n_nationkey.cast("string"))
    return nation.query(view().select("key_text", "n_name"))


@registered
def where_compare(m: Model) -> DataFrame:
    large = view().select("o_orderkey", "o_totalprice").where(lambda o: o.o_totalprice >= 300000.0)
    return m.orders.query(large)


@registered
def where_null(m: Model) -> DataFrame:
    unlabelled = view().select("doc_id", "lang").where(lambda d: d.labels.quality.isNull())
    return m.documents.query(unlabelled)


# -- aggregates -------------------------------------------------------------------------------


@registered
def global_aggregate(m: Model) -> DataFrame:
    return rounded(
        m.orders.query(view().aggregate("total_orders", "total_revenue")), total_revenue=2
    )


@registered
def global_aggregate_of_nothing(m: Model) -> DataFrame:
    nothing = view().where(lambda o: o.o_totalprice < 0)
    totals = m.orders.query(nothing.aggregate("total_orders", "total_revenue", "avg_order_value"))
    return rounded(totals, total_revenue=2, avg_order_value=6)


@registered
def sum_inline_expr(m: Model) -> DataFrame:
    by_flag = view().group_by("l_returnflag")
    worth = by_flag.aggregate(worth=sum_of(lambda l: l.l_extendedprice * l.l_quantity))
    return rounded(m.lineitem.query(worth), worth=2)


@registered
def ratio_measure(m: Model) -> DataFrame:
    by_priority = view().group_by("priority").aggregate("avg_order_value")
    return rounded(m.orders.query(by_priority), avg_order_value=6)


@registered
def filtered_measure(m: Model) -> DataFrame:
    return m.orders.query(view().group_by("priority").aggregate("high_value_orders"))


@registered
def group_by_only(m: Model) -> DataFrame:
    return m.customer.query(view().group_by("segment"))


@registered
def group_by_join_one(m: Model) -> DataFrame:
    by_segment = view().group_by("customer.segment").aggregate("total_revenue")
    return rounded(m.orders.query(by_segment), total_revenue=2)


@registered
def view_customer_performance(m: Model) -> DataFrame:
    return rounded(m.orders.query("customer_performance"), total_revenue=2, avg_order_value=6)


@registered
def view_daily_trend(m: Model) -> DataFrame:
    return rounded(m.orders.query("daily_trend"), total_revenue=2)


@registered
def high_value_orders(m: Model) -> DataFrame:
    rich = (
        view()
        .where(lambda o: o.o_totalprice >= 300000.0)
        .group_by("customer.name", "priority")
        .aggregate("total_revenue")
    )
    return rounded(m.orders.query(rich), total_revenue=2)


# -- joins and grain --------------------------------------------------------------------------


@registered
def transitive_join(m: Model) -> DataFrame:
    by_region = view().group_by("orders.customer.nation.region.r_name").aggregate("net_revenue")
    return rounded(m.lineitem.query(by_region), net_revenue=0)


@registered
def join_many_root_measure(m: Model) -> DataFrame:
    by_flag = view().group_by("items.l_returnflag").aggregate("total_revenue", "total_orders")
    return rounded(m.orders_with_lines.query(by_flag), total_revenue=2)


@registered
def join_many_root_filter(m: Model) -> DataFrame:
    returned = (
        view()
        .where(lambda o: (o.items.l_returnflag == "R") & (o.items.l_quantity > 40))
        .group_by("priority")
        .aggregate("total_revenue", "total_orders")
    )
    return rounded(m.orders_with_lines.query(returned), total_revenue=2)


@registered
def join_many_spanning_filter(m: Model) -> DataFrame:
    """The filter compares both sides of the join, so orders are deduplicated by their key."""
    dominated = (
        view()
        .where(lambda o: o.items.l_extendedprice * 4 > o.o_totalprice)
        .group_by("priority")
        .aggregate("total_revenue", "total_orders", "items.lines")
    )
    return rounded(m.orders_with_lines.query(dominated), total_revenue=2)


@registered
def join_many_computed_key(m: Model) -> DataFrame:
    by_year = (
        view()
        .group_by(ship_year=lambda o: F.year(o.items.l_shipdate))
        .aggregate("total_revenue", "total_orders")
    )
    return rounded(m.orders_with_lines.query(by_year), total_revenue=2)


@registered
def join_many_filtered_measure(m: Model) -> DataFrame:
    returned = count().where(lambda o: o.items.l_returnflag == "R")
    by_priority = view().group_by("priority").aggregate("total_orders", returned_orders=returned)
    return m.orders_with_lines.query(by_priority)


@registered
def join_many_child_measure(m: Model) -> DataFrame:
    by_priority = view().group_by("priority").aggregate("items.quantity", "items.lines")
    return rounded(m.orders_with_lines.query(by_priority), quantity=2)


@registered
def join_many_child_filter(m: Model) -> DataFrame:
    big = (
        view()
        .where(lambda o: o.items.l_quantity > 25, lambda o: o.o_totalprice > 100000)
        .group_by("priority", "items.l_returnflag")
        .aggregate("items.quantity", "items.lines")
    )
    return rounded(m.orders_with_lines.query(big), quantity=2)


@registered
def join_many_mixed(m: Model) -> DataFrame:
    mixed = view().group_by("items.l_returnflag").aggregate("total_revenue", "items.lines")
    return rounded(m.orders_with_lines.query(mixed), total_revenue=2)


@registered
def join_two_many(m: Model) -> DataFrame:
    by_segment = (
        view()
        .group_by("segment")
        .aggregate("customers", "orders.total_revenue", "events.event_value", "events.events")
    )
    return rounded(m.customer_activity.query(by_segment), total_revenue=2, event_value=2)


@registered
def join_many_to_many(m: Model) -> DataFrame:
    by_priority = view().group_by("priority").aggregate("events.events", "events.event_value")
    return rounded(m.orders_with_events.query(by_priority), event_value=2)


@registered
def join_many_nested(m: Model) -> DataFrame:
    by_nation = (
        view()
        .group_by("region.r_name", "n_name")
        .aggregate("nations", "customer.customers", "customer.balance")
        .aggregate("customer.orders.total_orders", "customer.orders.total_revenue")
    )
    return rounded(m.nation_sales.query(by_nation), balance=2, total_revenue=2)


@registered
def join_one_side_measure(m: Model) -> DataFrame:
    by_status = view().group_by("status").aggregate("customer.balance", "customer.customers")
    return rounded(m.orders.query(by_status), balance=2)


@registered
def join_one_side_order_value(m: Model) -> DataFrame:
    by_flag = view().group_by("l_returnflag")
    values = by_flag.aggregate("lines", "orders.total_orders", "orders.total_revenue")
    return rounded(m.lineitem.query(values), total_revenue=2)


@registered
def join_cross(m: Model) -> DataFrame:
    return m.region_pairs.query(
        view().group_by("r_name").aggregate("regions", pairs="nation.nations")
    )


@registered
def join_cross_filtered(m: Model) -> DataFrame:
    few = view().where(lambda r: r.nation.n_nationkey < 5)
    return m.region_pairs.query(few.group_by("r_name").aggregate("regions", pairs="nation.nations"))


@registered
def join_cross_nothing(m: Model) -> DataFrame:
    none = view().where(lambda r: r.nation.n_nationkey < 0)
    return m.region_pairs.query(none.aggregate("regions", pairs="nation.nations"))


@registered
def join_pruned(m: Model) -> DataFrame:
    by_priority = view().group_by("priority").aggregate("total_revenue", "total_orders")
    return rounded(m.orders_with_lines.query(by_priority), total_revenue=2)


# -- stages, order, limits, nests -------------------------------------------------------------


@registered
def two_stage_top_brands(m: Model) -> DataFrame:
    brands = view().group_by("part.p_brand").aggregate("net_revenue")
    top = view().order_by("-net_revenue").top(5)
    return rounded(m.lineitem.query(brands, top), net_revenue=0)


@registered
def stage_over_groups(m: Model) -> DataFrame:
    """The second stage groups what the first stage aggregated."""
    per_customer = view().group_by("o_custkey").aggregate("total_orders")
    spread = view().group_by("total_orders").aggregate(customers=count())
    return m.orders.query(per_customer, spread)


@registered
def limited_view(m: Model) -> DataFrame:
    """A limit without an order keeps the largest first measures."""
    return rounded(m.orders.query("top_customers"), total_revenue=2)


@registered
def nest_named_flat(m: Model) -> DataFrame:
    outer = view().group_by("customer.segment").nest("status_breakdown")
    return rounded(m.orders.nest_rows(outer, "status_breakdown"), total_revenue=2)


@registered
def nest_topk_flat(m: Model) -> DataFrame:
    outer = view().group_by("customer.segment").nest("top_customers")
    return rounded(m.orders.nest_rows(outer, "top_customers", rank="rank"), total_revenue=2)


def _dashboard():
    return (
        view()
        .aggregate("total_revenue", "total_orders", "avg_order_value")
        .nest("segment_performance", "daily_trend", "top_customers")
    )


@registered
def executive_dashboard_text(m: Model) -> DataFrame:
    frame = m.orders.query(_dashboard())
    frame = frame.withColumns(
        {
            "segment_performance": lines_of(
                "segment_performance",
                lambda r: [r.segment, r.status, r.total_revenue.cast("decimal(38,2)")],
            ),
            "daily_trend": lines_of(
                "daily_trend",
                lambda r: [r.order_date, r.total_revenue.cast("decimal(38,2)"), r.total_orders],
            ),
            "top_customers": lines_of(
                "top_customers", lambda r: [r["name"], r.total_revenue.cast("decimal(38,2)")]
            ),
        }
    )
    return rounded(frame, total_revenue=2, avg_order_value=6)


def lines_of(name: str, fields: Callable[[Column], list[Column]]) -> Column:
    """An array of structs as text, one line per element in array order."""
    line = F.transform(
        F.col(name), lambda r: F.concat_ws("|", *(field.cast("string") for field in fields(r)))
    )
    return F.array_join(line, "\n")


@registered
def nest_in_groups(m: Model) -> DataFrame:
    """Two sibling nests per segment, one limited and with a filter that may leave it empty."""
    rich = (
        view()
        .where(lambda o: o.o_totalprice >= 499000.0)
        .group_by("customer.name")
        .aggregate("total_revenue")
        .limit(3)
    )
    outer = view().group_by("customer.nation.n_name").aggregate("total_orders")
    frame = m.orders.query(outer.nest("status_breakdown", rich=rich))
    return frame.withColumns(
        {
            "status_breakdown": lines_of(
                "status_breakdown",
                lambda r: [r.status, r.total_revenue.cast("decimal(38,2)"), r.total_orders],
            ),
            "rich": lines_of("rich", lambda r: [r["name"], r.total_revenue.cast("decimal(38,2)")]),
        }
    )


# -- materialisation --------------------------------------------------------------------------


def stored(m: Model, frame: DataFrame, target: str) -> Written:
    return materialize(frame, target, folder=scratch(m.spark))


@registered
def materialized_table(m: Model) -> DataFrame:
    stored(m, view_customer_performance(m), "semlayer_customer_performance")
    return m.spark.table("semlayer_customer_performance")


@registered
def materialized_view(m: Model) -> DataFrame:
    materialize(view_daily_trend(m), "semlayer_daily_trend", mode="view")
    return m.spark.table("semlayer_daily_trend")


@registered
def materialized_sql_view(m: Model) -> DataFrame:
    text = (
        "SELECT o_orderstatus AS status, count(*) AS total_orders "
        f"FROM parquet.`{m.folder}/orders.parquet` GROUP BY o_orderstatus"
    )
    materialize_sql(m.spark, text, "semlayer_status_counts")
    return m.spark.table("semlayer_status_counts")


@registered
def materialized_record(m: Model) -> DataFrame:
    """Schema and row count as the write reports them."""
    written = stored(m, m.orders.frame, "semlayer_orders")
    rows = [(written.target_table, written.row_count, *column) for column in written.columns]
    return m.spark.createDataFrame(
        rows, "target_table string, row_count bigint, column_name string, column_type string"
    )


@registered
def materialized_preview(m: Model) -> DataFrame:
    """The first rows of the record, here all of a small table, after the table was written twice."""
    first = m.orders.query("status_breakdown")
    stored(m, rounded(first, total_revenue=2), "semlayer_status")
    record = materialize(rounded(first, total_revenue=2), "semlayer_status", folder=scratch(m.spark), preview_rows=PREVIEW_ROWS)
    release(m.spark, record)
    return m.spark.createDataFrame(list(record.preview), m.spark.table("semlayer_status").schema)


@registered
def downstream_digest(m: Model) -> DataFrame:
    stored(m, view_customer_performance(m), "semlayer_digest_input")
    source = table_source(m.spark, "semlayer_digest_input")
    vip = count().where(lambda c: c.total_revenue > 2500000)
    return source.query(view().aggregate(vip_count=vip))


# -- checks -----------------------------------------------------------------------------------


@registered
def check_null_key(m: Model) -> DataFrame:
    return Check.counting("check_null_key", m.orders, lambda o: o.o_custkey.isNull()).result()


@registered
def check_positive_amount(m: Model) -> DataFrame:
    return Check.counting("check_positive", m.orders, lambda o: o.o_totalprice <= 0).result()


@registered
def check_offending_rows(m: Model) -> DataFrame:
    plain = m.table("customer")
    return Check.offending("check_balance", plain, lambda c: c.c_acctbal < 0).result()


@registered
def check_verdicts(m: Model) -> DataFrame:
    """Each rule alone: invalid_count, fail_count, both, and rows."""
    both = m.customer.query(
        view().aggregate(
            invalid_count=count().where(lambda c: c.c_acctbal < -1e9),
            fail_count=count().where(lambda c: c.c_acctbal < 0),
        )
    )
    other = m.customer.query(view().aggregate(null_count=count().where(lambda c: c.name.isNull())))
    checks = [
        Check.counting("check_invalid", m.customer, lambda c: c.c_acctbal < 0),
        Check.counting("check_fail", m.orders, lambda o: o.o_custkey.isNull(), column="fail_count"),
        Check.of("check_both", both, target="customer"),
        Check.of("check_other_count", other, target="customer"),
        Check.offending("check_rows", m.orders, lambda o: o.o_totalprice < 0),
        Check.offending("check_unlabelled", m.documents, lambda d: d.labels.quality.isNull()),
    ]
    return run_suite(m.spark, checks).select("name", "passed", "returned_rows")


@registered
def check_error(m: Model) -> DataFrame:
    """A check that raises has failed, and the others of its shared scan still have their verdicts."""
    checks = [
        Check.counting("check_small_amount", m.orders, lambda o: o.o_totalprice <= 5000),
        Check.counting("check_raises", m.orders, lambda o: o.o_orderpriority.cast("int") > 0),
        Check.counting("check_null_customer", m.orders, lambda o: o.o_custkey.isNull()),
    ]
    told = F.substring_index("description", ":", 1).alias("description")
    return run_suite(m.spark, checks).select("target", "name", "passed", "returned_rows", told)


@registered
def check_suite(m: Model) -> DataFrame:
    """Three checks of orders share one scan; the one on documents follows a join."""
    checks = [
        Check.counting("check_null_customer", m.orders, lambda o: o.o_custkey.isNull()),
        Check.counting("check_small_amount", m.orders, lambda o: o.o_totalprice <= 5000),
        Check.offending("check_status", m.orders, lambda o: ~o.status.isin("O", "F", "P")),
        Check.counting("check_labelled", m.documents, lambda d: d.labels.quality.isNull()),
    ]
    return run_suite(m.spark, checks)


@registered
def check_views(m: Model) -> DataFrame:
    """Views named like checks; those that filter and count share one scan."""
    no_parent = view().where(lambda o: o.customer.c_custkey.isNull())
    cheap = view().where(lambda o: o.o_totalprice < 20000, lambda o: o.status == "F")
    orders = m.orders.view(
        check_parents=no_parent.aggregate(invalid_count="total_orders"),
        check_cheap=cheap.aggregate(fail_count=count()),
        test_poor_customers=view()
        .where(lambda o: o.customer.c_acctbal < -900)
        .group_by("customer.name"),
    )
    return run_suite(m.spark, checks_of(orders, target="order_report"))


# -- lineage ----------------------------------------------------------------------------------


@registered
def lineage_closure(m: Model) -> DataFrame:
    """Every ancestor of every order, customer and nation along the foreign keys."""

    def node(kind: str, key: str) -> Column:
        return F.concat(F.lit(f"{kind}:"), F.col(key).cast("string"))

    def edges(table: str, kind: str, key: str, parent: str, parent_key: str) -> DataFrame:
        frame = m.table(table).frame
        return frame.select(node(kind, key).alias("src"), node(parent, parent_key).alias("dst"))

    graph = (
        edges("orders", "order", "o_orderkey", "customer", "o_custkey")
        .unionByName(edges("customer", "customer", "c_custkey", "nation", "c_nationkey"))
        .unionByName(edges("nation", "nation", "n_nationkey", "region", "n_regionkey"))
    )
    return transitive_closure(graph)
