"""Rule-based segments: three key levels, distinct-customer counts, hierarchical back-off."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierloom.functions.columns import segment_name
from tierloom.operators import spend
from tierloom.schemas import PROFILE_DIMS, SEGMENT_LEVELS
from tierloom.sources.staging import stage, with_size_check


def segment_keys(binned: DataFrame) -> DataFrame:
    head, tail = ["INDUSTRY_CODE_DESC", "COMPANY_TYPE_DESC"], ["TAM_TIER_SOURCE", "TAM_TIER_BIN"]
    middles = (["MSA_REGION", "MSA"], ["MSA_REGION"], [])
    return binned.withColumns({
        level: segment_name(*head, *middle, *tail) for level, middle in zip(SEGMENT_LEVELS, middles)})


def segment_counts(keyed: DataFrame) -> DataFrame:
    """LEVEL_NAME, SEGMENT_KEY, CUSTOMERS: distinct customers of all three levels from one scan.

    The distinct step shuffles by (level, key, customer), so a segment with a third of all customers is spread.
    """
    return (
        keyed.select("CUSTOMER_ID", *SEGMENT_LEVELS)
        .unpivot(["CUSTOMER_ID"], SEGMENT_LEVELS, "LEVEL_NAME", "SEGMENT_KEY")
        .groupBy("LEVEL_NAME", "SEGMENT_KEY")
        .agg(F.countDistinct("CUSTOMER_ID").alias("CUSTOMERS"))
    )


def segment_map(keyed: DataFrame, counts: DataFrame, min_segment_size: int = 60, use_msa: bool = True) -> DataFrame:
    """The back-off decision once per key combination, so that rows need a single join for it."""
    combos = keyed.select(*SEGMENT_LEVELS).distinct()
    for i, level in enumerate(SEGMENT_LEVELS, start=1):
        at_level = counts.where(F.col("LEVEL_NAME") == level).select(
            F.col("SEGMENT_KEY").alias(level), F.col("CUSTOMERS").alias(f"COUNT_SEG_{i}"))
        combos = combos.join(at_level, level, "left")
    level = F.when(F.lit(use_msa) & (F.col("COUNT_SEG_1") > min_segment_size), 1).when(
        F.col("COUNT_SEG_2") > min_segment_size, 2).otherwise(3)
    combos = combos.withColumn("SEGMENT_LEVEL", level)
    return combos.withColumn("SEGMENT", F.element_at(F.array(*SEGMENT_LEVELS), F.col("SEGMENT_LEVEL")))


def segment_profiles(
    orders: DataFrame, min_segment_size: int = 60, use_msa: bool = True, accuracy: int = 10_000,
) -> DataFrame:
    """Customer profiles with spend tier, bin, keys, counts and SEGMENT: one scan of the orders in total."""
    profiles = stage(spend.customer_profiles(orders), "profiles")
    thresholds = stage(spend.spend_thresholds(profiles, accuracy=accuracy), "thresholds")
    keyed = segment_keys(spend.tier_bins(profiles, thresholds))
    counts = stage(segment_counts(keyed), "segment-counts")
    decided = stage(segment_map(keyed, counts, min_segment_size, use_msa), "segment-map")
    return keyed.join(with_size_check(decided), SEGMENT_LEVELS, "left")


def prepare_orders(orders: DataFrame, profiles: DataFrame) -> DataFrame:
    """Every order row with the columns of its customer profile; one equi-join at order grain.

    `profiles` is the result of segment_profiles, best staged. Ids and attributes match NULL-safe, so an order without
    a customer gets source, bin and keys from its own attributes. A customer
    with very many orders is split by adaptive skew handling, which can split the left side of a left join.
    """
    derived = [c for c in profiles.columns if c not in {
        "CUSTOMER_ID", *PROFILE_DIMS, "ORDER_ROWS", "GSAR_UNITS", "VALUED_ORDERS", "FIRST_ORDER", "LAST_ORDER"}]
    right = profiles.select(
        *[F.col(c).alias(f"__{c}") for c in ("CUSTOMER_ID", *PROFILE_DIMS)], *derived)
    match = F.lit(True)
    for c in ("CUSTOMER_ID", *PROFILE_DIMS):
        match = match & F.col(c).eqNullSafe(F.col(f"__{c}"))
    return (
        orders.withColumn("ORDER_YEAR", F.year("ORDER_DATE"))
        .join(right, match, "left")
        .drop(*[f"__{c}" for c in ("CUSTOMER_ID", *PROFILE_DIMS)])
    )
