"""Q58-Q66: RFM, tiers and affinity."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from mercato.functions.columns import bands, mean, money, percent, ratio, rounded
from mercato.operators import ordered
from mercato.operators.affinity import pair_counts
from mercato.operators.rfm import rfm_metrics, rfm_segment
from mercato.operators.topn import share_of_total, top
from mercato.plans.basics import down, paid_by_known, up
from mercato.plans.registry import query
from mercato.plans.warehouse import Warehouse
from mercato.plans.windows import spenders


@query("q58_rfm_raw")
def rfm_raw(wh: Warehouse, n: int | None = 25) -> DataFrame:
    metrics = rfm_metrics(wh.buyers, wh.latest_purchase())
    frame = metrics.withColumn("monetary", rounded("monetary"))
    return top(frame, [down("monetary"), up("customer_unique_id")], n)


@query("q59_rfm_scores", n=25)
@query("q59_rfm_scores_all", n=None)
def scores(wh: Warehouse, n: int | None = 25) -> DataFrame:
    frame = wh.rfm.withColumn("monetary", rounded("monetary"))
    return top(frame, [down("monetary"), up("customer_unique_id")], n)


def segmented(wh: Warehouse) -> DataFrame:
    return wh.rfm.withColumn("segment", rfm_segment())


@query("q60_rfm_segments")
def segment_sizes(wh: Warehouse) -> DataFrame:
    return (
        segmented(wh)
        .groupBy("segment")
        .agg(F.count(F.lit(1)).alias("customers"))
        .orderBy(down("customers"), "segment")
    )


@query("q61_quintile_revenue")
def quintile_revenue(wh: Warehouse, tiles: int = 5) -> DataFrame:
    """The monetary score of the RFM mart is the quintile when five tiles are asked for and the mart is there."""
    by_spend = [F.col("spent"), F.col("customer_unique_id")]
    if tiles == 5 and wh.has("rfm"):
        tiled = wh.rfm.select(F.col("m_score").alias("m_quintile"), F.col("monetary").alias("spent"))
    else:
        tiled = ordered.ntiles(wh.spending, {"m_quintile": (tiles, by_spend)})
    summary = tiled.groupBy("m_quintile").agg(
        F.count(F.lit(1)).alias("customers"), F.sum("spent").alias("total")
    )
    return summary.select(
        "m_quintile",
        "customers",
        rounded("total").alias("revenue"),
        share_of_total("total").alias("pct_revenue"),
    ).orderBy(F.desc("m_quintile"))


# Spend limits and labels of the original currency.
SPEND_TIERS = [(100.0, "1_Low (<100)"), (300.0, "2_Mid (100-300)"), (1000.0, "3_High (300-1000)")]
TOP_TIER = "4_VIP (1000+)"
# The test data spends about a thousand times as much per person.
SCALED_TIERS = [
    (100_000.0, "1_Low (<100k)"),
    (300_000.0, "2_Mid (100k-300k)"),
    (1_000_000.0, "3_High (300k-1M)"),
]


@query("q62_spend_tiers", tiers=SCALED_TIERS, top_tier="4_VIP (1M+)")
@query("q62_spend_tiers_default")
def spend_tiers(
    wh: Warehouse, tiers: list[tuple[float, str]] = SPEND_TIERS, top_tier: str = TOP_TIER
) -> DataFrame:
    return (
        spenders(wh)
        .groupBy(bands(F.col("spent"), tiers, top_tier).alias("tier"))
        .agg(F.count(F.lit(1)).alias("customers"), money("spent").alias("revenue"))
        .orderBy("tier")
    )


@query("q63_frequency_vs_review")
def frequency_vs_review(wh: Warehouse) -> DataFrame:
    """Mean of person means; a person's mean weighs every review of all their orders."""
    orders = F.col("orders")
    band = F.when(orders == 1, "single").when(orders <= 3, "2-3").otherwise("4+")
    average = ratio(F.col("review_sum"), F.col("review_scored"))
    return (
        wh.buyers.groupBy(band.alias("freq_band"))
        .agg(
            F.count(F.lit(1)).alias("customers"),
            rounded(F.avg(average), 3).alias("avg_review"),
        )
        .orderBy("freq_band")
    )


@query("q64_state_concentration")
def state_concentration(wh: Warehouse) -> DataFrame:
    return (
        paid_by_known(wh)
        .groupBy("customer_state")
        .agg(
            F.count_distinct("customer_unique_id").alias("customers"),
            F.sum("payment_value").alias("total"),
        )
        .select(
            "customer_state",
            "customers",
            rounded("total").alias("revenue"),
            rounded(ratio(F.col("total"), F.col("customers"))).alias("revenue_per_customer"),
        )
        .orderBy(down("revenue"), up("customer_state"))
    )


@query("q65_cross_sell_affinity")
def cross_sell_affinity(wh: Warehouse, n: int | None = 20) -> DataFrame:
    """An order's categories go to its person: no payment, review or total of the order is needed."""
    if wh.has("lines"):
        bought = wh.lines.filter("known_product and category is not null and customer_unique_id is not null")
    else:
        labels = wh.priced_items().filter("known_product and category is not null and order_id is not null")
        people = wh.placed_orders().filter("customer_unique_id is not null").select("order_id", "customer_unique_id")
        bought = labels.select("order_id", "category").distinct().join(people, "order_id")
    pairs = pair_counts(bought, "customer_unique_id", "category", "shared_customers")
    return top(pairs, [down("shared_customers"), up("category_a"), up("category_b")], n)


@query("q66_winback_high_aov", multiple=1.2)
def single_purchase_high_value(wh: Warehouse, multiple: float = 2.0, n: int = 25) -> DataFrame:
    people = spenders(wh)
    average = F.broadcast(people.agg(mean("spent").alias("average")))
    found = (
        people.filter("paid_orders = 1")
        .crossJoin(average)
        .filter(F.col("spent").cast("double") > F.col("average") * F.lit(float(multiple)))
        .select("customer_unique_id", rounded("spent").alias("total_spent"))
    )
    return top(found, [down("total_spent"), up("customer_unique_id")], n)
