"""Spend tiers: yearly and average spend, value fallback, grouped quartiles, bins.

The reporting chain works at customer-profile grain: one map-side combined pass over the orders collapses a
customer's rows per distinct set of attributes, and every later step reads that much smaller table.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tierloom.functions.columns import (
    money_units, spend_bin, spend_source, spend_value, tier_code, units_to_money)
from tierloom.operators.quantiles import exact_quantiles
from tierloom.schemas import PROFILE_DIMS
from tierloom.sources.staging import stage, with_size_check

BINNED_SOURCES = ("TAM", "AVG_ANNUAL_SPEND")


def yearly_spend(orders: DataFrame) -> DataFrame:
    return (
        orders.groupBy("CUSTOMER_ID", F.year("ORDER_DATE").alias("ORDER_YEAR"))
        .agg(units_to_money(F.sum(money_units(F.col("GSAR")))).alias("YEARLY_GSAR"))
    )


def avg_annual_spend(orders: DataFrame) -> DataFrame:
    return yearly_spend(orders).groupBy("CUSTOMER_ID").agg(F.avg("YEARLY_GSAR").alias("AVG_ANNUAL_SPEND"))


def customer_profiles(orders: DataFrame) -> DataFrame:
    """One row per customer and distinct attribute set, with its order totals and spend tier inputs.

    The first aggregate combines map-side, so a customer with a huge share of the orders shuffles a few rows
    per task. Its result is hashed by customer once; window and second aggregate both use that layout, on one
    row per attribute set and year of a customer. Orders without a customer have no average spend; they are spread
    by their attributes.
    """
    units = money_units(F.col("GSAR"))
    spread = F.when(F.col("CUSTOMER_ID").isNull(), F.xxhash64(*PROFILE_DIMS)).alias("__spread")
    yearly = orders.groupBy("CUSTOMER_ID", spread, *PROFILE_DIMS, F.year("ORDER_DATE").alias("ORDER_YEAR")).agg(
        F.count(F.lit(1)).alias("__rows"),
        F.sum(units).alias("__units"),
        F.count(units).alias("__valued"),
        F.min("ORDER_DATE").alias("__first"),
        F.max("ORDER_DATE").alias("__last"),
    )
    per_customer = Window.partitionBy("CUSTOMER_ID", "__spread")
    spending_years = F.size(F.collect_set(
        F.when(F.col("__units").isNotNull(), F.col("ORDER_YEAR"))).over(per_customer))
    with_avg = yearly.withColumn(
        "AVG_ANNUAL_SPEND",
        F.when(F.col("CUSTOMER_ID").isNotNull(), F.try_divide(
            units_to_money(F.sum("__units").over(per_customer)), spending_years)))
    profiles = with_avg.groupBy("CUSTOMER_ID", "__spread", *PROFILE_DIMS).agg(
        F.sum("__rows").alias("ORDER_ROWS"),
        F.sum("__units").alias("GSAR_UNITS"),
        F.sum("__valued").alias("VALUED_ORDERS"),
        F.min("__first").alias("FIRST_ORDER"),
        F.max("__last").alias("LAST_ORDER"),
        F.first("AVG_ANNUAL_SPEND").alias("AVG_ANNUAL_SPEND"),
    )
    return with_spend_source(profiles.drop("__spread"))


def with_spend_source(df: DataFrame) -> DataFrame:
    """TIER_NUMERIC, TAM_TIER_OR_AVGSPEND and TAM_TIER_SOURCE from TAM, TIER and AVG_ANNUAL_SPEND."""
    df = df.withColumn("TIER_NUMERIC", tier_code(F.col("TIER")))
    picks = [F.col("TAM"), F.col("TIER_NUMERIC"), F.col("AVG_ANNUAL_SPEND")]
    return df.withColumns({
        "TAM_TIER_OR_AVGSPEND": spend_value(*picks),
        "TAM_TIER_SOURCE": spend_source(*picks),
    })


def null_pct_by_industry(profiles: DataFrame) -> DataFrame:
    """Share of customers without any spend value per industry; an industry that is NULL is not reported."""
    missing = F.when(F.col("TAM_TIER_OR_AVGSPEND").isNull(), F.col("CUSTOMER_ID"))
    return (
        profiles.where(F.col("INDUSTRY_CODE_DESC").isNotNull())
        .groupBy("INDUSTRY_CODE_DESC")
        .agg(F.countDistinct("CUSTOMER_ID").alias("CUSTOMER_COUNT"), F.countDistinct(missing).alias("__nulls"))
        .select(
            "INDUSTRY_CODE_DESC", "CUSTOMER_COUNT",
            F.round(F.col("__nulls") * 100 / F.col("CUSTOMER_COUNT"), 2).alias("NULL_PCT"))
        .orderBy("INDUSTRY_CODE_DESC")
    )


def spend_thresholds(
    profiles: DataFrame, sources: Sequence[str] = BINNED_SOURCES, accuracy: int = 10_000,
) -> DataFrame:
    """Exact quartiles of the distinct customer values per (industry, source); a NULL industry is a group of its own."""
    group = ["INDUSTRY_CODE_DESC", "TAM_TIER_SOURCE"]
    values = stage(
        profiles.where(F.col("TAM_TIER_SOURCE").isin(*sources) & F.col("TAM_TIER_OR_AVGSPEND").isNotNull())
        .select(*group, "CUSTOMER_ID", "TAM_TIER_OR_AVGSPEND").distinct()
        .select(
            F.col(group[0]).isNull().alias("__none"), F.coalesce(group[0], F.lit("")).alias("__industry"), group[1],
            F.col("TAM_TIER_OR_AVGSPEND").alias("VALUE")),
        "spend-values")
    found = exact_quantiles(
        values, ["__none", "__industry", group[1]], [0.25, 0.5, 0.75], accuracy=accuracy, discrete=True)
    return found.select(
        F.when(~F.col("__none"), F.col("__industry")).alias(group[0]), group[1],
        *[F.col("Q")[i].alias(f"value_q{i + 1}") for i in range(3)])


def tier_bins(profiles: DataFrame, thresholds: DataFrame) -> DataFrame:
    """Adds value_q1..value_q3 and TAM_TIER_BIN. Pass staged thresholds, so that their size is known."""
    joined = profiles.join(with_size_check(thresholds), ["INDUSTRY_CODE_DESC", "TAM_TIER_SOURCE"], "left")
    return joined.withColumn("TAM_TIER_BIN", spend_bin(*[F.col(c) for c in (
        "TAM_TIER_SOURCE", "TIER", "TAM_TIER_OR_AVGSPEND", "value_q1", "value_q2", "value_q3")]))
