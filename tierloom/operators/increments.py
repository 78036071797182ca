"""Results kept up to date from deltas: spend per customer and year, and exact distinct customers as bitmaps.

State tables merge: the state of a union is the merge of the states. Only what a delta touches is computed anew.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierloom.functions.columns import money_units, units_to_money
from tierloom.schemas import SEGMENT_LEVELS
from tierloom.sources.staging import stage


def spend_state(orders: DataFrame) -> DataFrame:
    """CUSTOMER_ID, ORDER_YEAR, UNITS (exact decimal sum, null without an amount), ORDERS."""
    return orders.groupBy("CUSTOMER_ID", F.year("ORDER_DATE").alias("ORDER_YEAR")).agg(
        F.sum(money_units(F.col("GSAR"))).alias("UNITS"), F.count(F.lit(1)).alias("ORDERS"))


def merge_spend(*states: DataFrame) -> DataFrame:
    """The state of all orders that the given states stand for."""
    every = states[0]
    for s in states[1:]:
        every = every.unionByName(s)
    return every.groupBy("CUSTOMER_ID", "ORDER_YEAR").agg(F.sum("UNITS").alias("UNITS"), F.sum("ORDERS").alias("ORDERS"))


def average_spend(state: DataFrame) -> DataFrame:
    """CUSTOMER_ID, AVG_ANNUAL_SPEND: mean of the yearly sums."""
    return state.groupBy("CUSTOMER_ID").agg(F.avg(units_to_money(F.col("UNITS"))).alias("AVG_ANNUAL_SPEND"))


def apply_orders(state: DataFrame, averages: DataFrame, delta: DataFrame) -> tuple[DataFrame, DataFrame]:
    """State and averages after the orders of `delta`.

    The delta is summed up first. Customers it does not name keep their rows of both tables as they are: these are only
    split off by an anti join with the delta's customers, and the sums and means are made for the others alone.
    """
    fresh = stage(spend_state(delta), "spend-delta")
    touched = stage(fresh.select(F.col("CUSTOMER_ID").alias("__id")).distinct(), "touched-customers")
    same = F.col("CUSTOMER_ID").eqNullSafe(F.col("__id"))
    changed = stage(merge_spend(state.join(touched, same, "left_semi"), fresh), "spend-changed")
    return (
        state.join(touched, same, "left_anti").unionByName(changed),
        averages.join(touched, same, "left_anti").unionByName(average_spend(changed)))


_BITS = "BUCKET", "BITS"


def customer_bitmaps(keyed: DataFrame, levels: Sequence[str] = tuple(SEGMENT_LEVELS), id_col: str = "CUSTOMER_ID") -> DataFrame:
    """LEVEL_NAME, SEGMENT_KEY, BUCKET, BITS: the ids (long) of every key as bitmaps of 32,768 ids each.

    A bitmap is 4 kB however many ids it holds, so ids should be dense; a segment with a third of all customers is spread
    over its buckets.
    """
    ids = keyed.select(F.col(id_col).cast("long").alias("__id"), *levels).unpivot(["__id"], list(levels), "LEVEL_NAME", "SEGMENT_KEY")
    return ids.groupBy("LEVEL_NAME", "SEGMENT_KEY", F.bitmap_bucket_number("__id").alias("BUCKET")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("__id")).alias("BITS"))


def merge_bitmaps(*parts: DataFrame) -> DataFrame:
    every = parts[0]
    for p in parts[1:]:
        every = every.unionByName(p)
    return every.groupBy("LEVEL_NAME", "SEGMENT_KEY", "BUCKET").agg(F.bitmap_or_agg("BITS").alias("BITS"))


def bitmap_counts(bitmaps: DataFrame) -> DataFrame:
    """LEVEL_NAME, SEGMENT_KEY, CUSTOMERS: exact distinct ids; a key with null ids only counts 0."""
    return bitmaps.groupBy("LEVEL_NAME", "SEGMENT_KEY").agg(
        F.coalesce(F.sum(F.when(F.col("BUCKET").isNotNull(), F.bitmap_count("BITS"))), F.lit(0)).alias("CUSTOMERS"))
