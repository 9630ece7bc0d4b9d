"""Sources, sinks, cleaning, forecasts and change tracking as queries.

The raw inputs are derived from the given tables by writing them as a careless export would
(padding, blanks, unparsable cells, repeated keys) and then taking them through the library.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, Window, functions as F

from mercato.functions.columns import (
    as_timestamp,
    cents_to_units,
    money,
    parse_timestamp,
    real,
    rounded,
    whole,
)
from mercato.operators.changes import RangedSnapshot, cancel_orders, change_audit, change_audit_ranged
from mercato.operators.clean import (
    augment_date_parts,
    clean_strings,
    coerce_numeric,
    coerce_timestamps,
    dedupe,
    distinct_on,
    normalise_place,
)
from mercato.operators.forecast import (
    holt_forecast,
    moving_average_forecast,
    trim_incomplete_tail,
)
from mercato.plans.basics import down, paid_by_known, up
from mercato.plans.ingest import ingest_table, report_frame
from mercato.plans.marts import monthly_revenue_view
from mercato.plans.registry import query
from mercato.plans.reports import monthly_orders_extract
from mercato.plans.warehouse import Warehouse
from mercato.session import scratch_path
from mercato.sources.publish import read_published
from mercato.sources.readers import read_csv, read_parquet, read_table, register_staging
from mercato.sources.sinks import (
    export_csv,
    refresh_snapshot,
    write_parquet,
    write_partitioned,
)
from mercato.specs import CATALOG, Field, spec_of, table

# ---- sources and sinks -------------------------------------------------------------------------


def _text(df: DataFrame) -> DataFrame:
    return df.select(*[F.col(c).cast("string").alias(c) for c in df.columns])


def export_raw(wh: Warehouse, source: str, table: str) -> str:
    """A source table as raw CSV under a fresh folder, compressed as such exports are kept."""
    folder = scratch_path(wh.spark, "raw")
    export_csv(_text(wh.source(source)), f"{folder}/{table}.csv", compression="gzip")
    return folder


@query("read_csv")
def csv_round_trip(wh: Warehouse) -> DataFrame:
    """Orders exported as CSV and read back as raw text, then typed and deduplicated."""
    spec = spec_of("orders")
    folder = export_raw(wh, "orders", "orders")
    raw = read_csv(wh.spark, f"{folder}/orders.csv", multi_line=False)
    typed = coerce_timestamps(clean_strings(raw), spec)
    return dedupe(typed, spec)


@query("read_csv_nullable")
def csv_nulls(wh: Warehouse) -> DataFrame:
    """Blank cells read as NULL, whatever the type of the column."""
    folder = export_raw(wh, "orders", "orders")
    raw = read_csv(wh.spark, f"{folder}/orders.csv", multi_line=False)
    return raw.agg(
        F.count(F.lit(1)).alias("orders"),
        F.count_if(F.col("order_approved_at").isNull()).alias("not_approved"),
        F.count_if(F.col("order_delivered_customer_date").isNull()).alias("not_delivered"),
    )


@query("run_report")
def run_report(wh: Warehouse) -> DataFrame:
    """Full ingestion of all nine raw tables (items with repeated keys), with row accounting."""
    out = scratch_path(wh.spark, "processed")
    reports = []
    for name in CATALOG:
        source = "order_items_uncleaned" if name == "order_items" else name
        reports.append(ingest_table(wh.spark, name, export_raw(wh, source, name), out))
    return report_frame(wh.spark, reports)


@query("read_parquet")
def parquet_scan(wh: Warehouse) -> DataFrame:
    """A pruned scan of all rows."""
    return wh.source("raw", "lineitem").select(
        "l_orderkey", whole("l_linenumber").alias("l_linenumber"), "l_quantity"
    )


@query("external_parquet_source")
def external_source(wh: Warehouse) -> DataFrame:
    """Tables written to a folder and read through a path template."""
    base = scratch_path(wh.spark, "external")
    write_parquet(wh.dim_sellers, f"{base}/tables/dim_sellers")
    return read_table(wh.spark, "dim_sellers", base, "{base_dir}/tables/{table}")


@query("register_staging")
def staging_views(wh: Warehouse) -> DataFrame:
    """All nine tables as ``stg_`` views, then queried with SQL.

    Items are summed per order and seller before they are joined.
    """
    base = scratch_path(wh.spark, "staging")
    for name in CATALOG:
        write_parquet(wh.source(name), f"{base}/{name}.parquet")
    register_staging(wh.spark, base)
    counts = " union all ".join(
        f"select '{name}' as label, count(*) as items, cast(null as double) as revenue from stg_{name}"
        for name in CATALOG
    )
    return wh.spark.sql(
        f"""
        select concat(s.seller_state, ' ', o.order_status) as label, sum(i.n) as items,
               cast(sum(i.price) as double) as revenue
        from (select order_id, seller_id, count(*) as n, sum(price) as price
              from stg_order_items group by all) i
        join stg_orders o using (order_id)
        join stg_sellers s using (seller_id)
        group by all
        union all {counts}
        """
    )


@query("write_parquet")
def parquet_round_trip(wh: Warehouse) -> DataFrame:
    path = write_parquet(wh.fact_payments, scratch_path(wh.spark, "payments"))
    return read_parquet(wh.spark, path).select(
        "order_id",
        whole("payment_sequential").alias("payment_sequential"),
        real("payment_value").alias("payment_value"),
    )


@query("write_partitioned")
def partitioned_round_trip(wh: Warehouse) -> DataFrame:
    """Orders partitioned by year and month, every row read back."""
    path = write_partitioned(
        augment_date_parts(wh.fact_orders),
        scratch_path(wh.spark, "orders-by-month"),
        ["purchase_year", "purchase_month"],
    )
    return (
        read_parquet(wh.spark, path)
        .groupBy(
            whole("purchase_year").alias("purchase_year"),
            whole("purchase_month").alias("purchase_month"),
            "order_status",
        )
        .agg(F.count(F.lit(1)).alias("orders"))
    )


@query("export_csv")
def csv_extract(wh: Warehouse) -> DataFrame:
    """The monthly extract as one CSV file, read back."""
    path = export_csv(
        monthly_orders_extract(wh), scratch_path(wh.spark, "extract"), single_file=True
    )
    return wh.spark.read.schema("month string, orders bigint").option("header", True).csv(path)


@query("refresh_snapshot")
def monthly_snapshot(wh: Warehouse) -> DataFrame:
    """Published twice, first without its last month; readers have the second version."""
    monthly, path = monthly_revenue_view(wh), scratch_path(wh.spark, "snapshot")
    last = monthly.agg(F.max("order_month").alias("last"))
    refresh_snapshot(monthly.join(F.broadcast(last), monthly["order_month"] < last["last"]).drop("last"), path)
    refresh_snapshot(monthly, path)
    return read_published(wh.spark, path).select(
        as_timestamp("order_month").alias("order_month"),
        "orders",
        "revenue",
        F.col("refreshed_at").isNotNull().alias("stamped"),
    )


# ---- cleaning -----------------------------------------------------------------------------------


@query("clean_strings")
def padded_text(wh: Warehouse) -> DataFrame:
    padded = wh.source("raw", "customer").select(
        "c_custkey",
        F.concat(F.lit("  "), "c_name", F.lit("   ")).alias("c_name"),
        F.when(F.col("c_mktsegment") == "MACHINERY", "   ").otherwise(F.col("c_mktsegment")).alias(
            "c_mktsegment"
        ),
    )
    return clean_strings(padded)


@query("coerce_timestamps")
def text_timestamps(wh: Warehouse) -> DataFrame:
    text = wh.source("raw", "orders").select(
        "o_orderkey",
        F.when(F.col("o_orderstatus") == "P", "not a date")
        .when(F.col("o_orderpriority").startswith("5"), " ")
        .otherwise(F.col("o_orderdate").cast("string"))
        .alias("o_orderdate"),
    )
    spec = table("orders_text", "o_orderkey", Field("o_orderdate", "timestamp"))
    return coerce_timestamps(text, spec)


@query("coerce_numeric")
def text_numbers(wh: Warehouse) -> DataFrame:
    text = wh.source("raw", "part").select(
        "p_partkey",
        F.when(F.col("p_brand") == "Brand#1", "n/a").otherwise(F.col("p_retailprice").cast("string")).alias(
            "p_retailprice"
        ),
        F.when(F.col("p_brand") == "Brand#2", "").otherwise(F.col("p_size").cast("string")).alias(
            "p_size"
        ),
    )
    spec = table("part_text", "p_partkey", Field("p_retailprice", "double"), Field("p_size", "int"))
    return coerce_numeric(text, spec).withColumn("p_size", whole("p_size"))


@query("dedupe")
def deduplicated_lines(wh: Warehouse) -> DataFrame:
    """One row per (order, line): the first one by all other columns."""
    spec = table("lineitem", Field("l_orderkey", in_key=True), Field("l_linenumber", in_key=True))
    lines = wh.source("raw", "lineitem").select(
        "l_orderkey",
        whole("l_linenumber").alias("l_linenumber"),
        "l_partkey",
        "l_suppkey",
        "l_extendedprice",
        "l_shipdate",
    )
    return dedupe(lines, spec)


@query("dedupe_rows")
def deduplicated_rows(wh: Warehouse) -> DataFrame:
    """A table without a key: exact copies only."""
    places = wh.source("geolocation").select("geolocation_city", "geolocation_state")
    return dedupe(places, table("places", *places.columns))


@query("distinct_on")
def latest_order_per_customer(wh: Warehouse) -> DataFrame:
    orders = wh.source("raw", "orders").select("o_custkey", "o_orderdate", "o_orderkey", "o_totalprice")
    return distinct_on(orders, ["o_custkey"], [down("o_orderdate"), up("o_orderkey")])


@query("augment_date_parts")
def order_date_parts(wh: Warehouse) -> DataFrame:
    return (
        augment_date_parts(wh.fact_orders)
        .groupBy(
            whole("purchase_year").alias("purchase_year"),
            whole("purchase_month").alias("purchase_month"),
        )
        .agg(F.count(F.lit(1)).alias("orders"))
    )


@query("normalise_geo_text")
def normalised_places(wh: Warehouse) -> DataFrame:
    raw = wh.source("raw", "customer").select(
        "c_custkey",
        F.concat(F.lit(" "), "c_mktsegment", F.lit(" ")).alias("city"),
        F.lower("c_mktsegment").alias("state"),
    )
    return normalise_place(raw, "city", "state")


@query("coalesce_label")
def product_labels(wh: Warehouse) -> DataFrame:
    return (
        wh.dim_products.groupBy(
            F.coalesce("product_category_english", F.lit("unknown")).alias("category")
        )
        .agg(F.count(F.lit(1)).alias("products"), F.avg("product_weight_g").alias("avg_weight"))
        .withColumn("avg_weight", rounded("avg_weight"))
    )


@query("nullif_blank_cast")
def blank_to_null_timestamp(wh: Warehouse) -> DataFrame:
    text = F.coalesce(F.col("order_delivered_customer_date").cast("string"), F.lit(""))
    return wh.fact_orders.select(
        "order_id", parse_timestamp(text).alias("order_delivered_customer_date")
    )


@query("cents_to_units")
def cents(wh: Warehouse) -> DataFrame:
    """Amounts kept as whole cents and shown in units."""
    in_cents = wh.fact_payments.select(
        "order_id",
        whole("payment_sequential").alias("payment_sequential"),
        (F.col("payment_value") * 100).cast("bigint").alias("cents"),
    )
    return in_cents.withColumn("amount", cents_to_units("cents"))


# ---- forecasts ------------------------------------------------------------------------------------


def state_series(wh: Warehouse) -> DataFrame:
    """Monthly revenue per state: all series are forecast in one job."""
    return (
        paid_by_known(wh)
        .groupBy("customer_state", "order_month")
        .agg(F.sum("payment_value").alias("revenue"))
    )


def with_weak_end(series: DataFrame) -> DataFrame:
    """The last month of every second series (by name) shrinks to a tenth, as when collection stops."""
    last = F.max("order_month").over(Window.partitionBy("customer_state"))
    even = F.element_at(F.split("customer_state", "_"), -1).cast("int") % 2 == 0
    weak = even & (F.col("order_month") == last)
    return series.withColumn(
        "revenue", F.when(weak, real("revenue") * F.lit(0.1)).otherwise(real("revenue"))
    )


@query("trim_incomplete_tail")
def trimmed_series(wh: Warehouse) -> DataFrame:
    return trim_incomplete_tail(
        with_weak_end(state_series(wh)), "customer_state", "order_month", "revenue"
    ).select("customer_state", as_timestamp("order_month").alias("order_month"), rounded("revenue").alias("revenue"))


@query("moving_average_forecast")
def moving_average(wh: Warehouse, horizon: int = 3) -> DataFrame:
    trimmed = trim_incomplete_tail(state_series(wh), "customer_state", "order_month", "revenue")
    return moving_average_forecast(trimmed, "customer_state", "order_month", "revenue", horizon)


@query("holt_forecast")
def holt(wh: Warehouse, horizon: int = 3) -> DataFrame:
    trimmed = trim_incomplete_tail(state_series(wh), "customer_state", "order_month", "revenue")
    return holt_forecast(trimmed, "customer_state", "order_month", "revenue", horizon)


# ---- lookups and changes ------------------------------------------------------------------------------

AS_OF = datetime(2002, 1, 1)


def customer_rfm(wh: Warehouse, as_of: datetime, customer: object | None = None) -> DataFrame:
    """Recency against a given date, frequency and spend: of one person, or of everyone."""
    people = wh.buyers
    if customer is not None:
        people = people.filter(F.col("customer_unique_id") == F.lit(customer))
    return people.select(
        "customer_unique_id",
        whole(F.datediff(F.lit(as_of.date()), "last_purchase")).alias("recency_days"),
        F.col("orders").alias("frequency"),
        rounded("spent").alias("monetary"),
    )


@query("customer_rfm", as_of=AS_OF)
def customer_rfm_table(wh: Warehouse, as_of: datetime) -> DataFrame:
    return customer_rfm(wh, as_of)


@query("customer_rfm_sql")
def customer_rfm_function(wh: Warehouse) -> DataFrame:
    """The same as a SQL table function, called for the biggest spender."""
    wh.buyers.createOrReplaceTempView("buyers")
    wh.spark.sql(
        """
        create or replace temporary function rfm_of(person bigint, as_of date)
        returns table (customer_unique_id bigint, recency_days bigint, frequency bigint, monetary double)
        return select b.customer_unique_id, cast(datediff(as_of, b.last_purchase) as bigint),
                      b.orders, cast(b.spent as double)
               from buyers b where b.customer_unique_id = rfm_of.person
        """
    )
    biggest = wh.buyers.orderBy(down("spent"), up("customer_unique_id")).first()
    return wh.spark.sql(
        "select * from rfm_of(:person, date'2002-01-01')",
        args={"person": biggest["customer_unique_id"]},
    )


def review_snapshots(wh: Warehouse) -> tuple[DataFrame, DataFrame]:
    """Reviews, and a new snapshot in which those answered after more than five days lose a point."""
    old = wh.fact_reviews.select("review_id", "review_score", "answer_latency_days")
    lowered = F.when(
        F.col("answer_latency_days") > 5, F.greatest(F.col("review_score") - 1, F.lit(1))
    ).otherwise(F.col("review_score"))
    return old, old.withColumn("review_score", lowered)


def _audited(audit: DataFrame) -> DataFrame:
    return audit.select(
        "review_id",
        whole("old_value").alias("old_score"),
        whole("new_value").alias("new_score"),
        "changed_at",
    )


@query("change_audit")
def review_audit(wh: Warehouse) -> DataFrame:
    return _audited(change_audit(*review_snapshots(wh), "review_id", "review_score", AS_OF))


@query("change_audit_ranged", ranges=64)
def ranged_review_audit(wh: Warehouse, ranges: int) -> DataFrame:
    """The same from stored snapshots, whose checksums tell which ranges have to be read."""
    old, new = (
        RangedSnapshot.store(df, scratch_path(wh.spark, f"reviews-{i}"), "review_id", ranges)
        for i, df in enumerate(review_snapshots(wh))
    )
    return _audited(change_audit_ranged(old, new, "review_score", AS_OF))


@query("cancel_orders")
def canceled_orders(wh: Warehouse) -> DataFrame:
    """Orders that were created but never paid become canceled; counts per status."""
    ids = wh.sales.filter("order_status = 'created' and payment_value is null").select("order_id")
    return (
        cancel_orders(wh.fact_orders, ids)
        .groupBy("order_status")
        .agg(F.count(F.lit(1)).alias("orders"))
    )
