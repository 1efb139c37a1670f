"""Silver -> gold: one row per PC4, with revenue estimates and ranks.

PC4s have four digits, so no gold table exceeds 10,000 rows; sorting one in a single task is safe at any input size. The
aggregations combine rows of a PC4 inside each input task first, so a PC4 with most of the listings is no bottleneck.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lettora.functions import money
from lettora.operators.ranking import rank_desc
from lettora.params import Economics, StrategyLabels

# This name and all column names below, equal to those users have today.
KEY = "postalcode4"


def gold_short_term(listings: DataFrame, economics: Economics = Economics()) -> DataFrame:
    summary = listings.groupBy(KEY).agg(
        money.mean(F.col("price"), 2).alias("avg_nightly_price"),
        money.mean(F.col("review_scores_value"), 1).alias("avg_review_score"),
        money.mean(F.col("bedrooms"), 1).alias("avg_bedrooms"),
        F.count(F.lit(1)).alias("airbnb_listing_count"),
    )
    revenue = money.short_term_revenue(F.col("avg_nightly_price"), economics)
    return summary.withColumn("est_annual_airbnb_revenue", revenue).withColumns(
        {
            "airbnb_revenue_rank": rank_desc("est_annual_airbnb_revenue"),
            "occupancy_rate": F.lit(float(economics.occupancy_rate)),
        }
    )


def gold_long_term(rentals: DataFrame, economics: Economics = Economics()) -> DataFrame:
    summary = rentals.groupBy(KEY).agg(
        money.mean(F.col("monthly_rent"), 2).alias("avg_monthly_rent"),
        money.mean(F.col("area_sqm"), 1).alias("avg_area_sqm"),
        F.count(F.lit(1)).alias("rental_listing_count"),
    )
    revenue = money.long_term_revenue(F.col("avg_monthly_rent"), economics)
    return summary.withColumn("est_annual_rental_revenue", revenue).withColumn(
        "rental_revenue_rank", rank_desc("est_annual_rental_revenue")
    )


def gold_comparison(
    short_term: DataFrame, long_term: DataFrame, labels: StrategyLabels = StrategyLabels()
) -> DataFrame:
    """PC4s that have both kinds of letting, best short-term advantage first."""
    short, long = F.col("est_annual_airbnb_revenue"), F.col("est_annual_rental_revenue")
    advantage = F.col("revenue_airbnb_minus_rentals")
    return (
        short_term.join(long_term, KEY)
        .withColumns(
            {
                "revenue_airbnb_minus_rentals": money.difference(short, long),
                "revenue_ratio": money.ratio(short, long),
                "total_listings": F.col("airbnb_listing_count") + F.col("rental_listing_count"),
            }
        )
        .withColumns(
            {
                "recommended_strategy": money.strategy(advantage, labels),
                "investment_rank": rank_desc("revenue_airbnb_minus_rentals"),
            }
        )
        .orderBy("investment_rank")
    )
