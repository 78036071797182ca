"""Customer grain: purchase features, training rows, segment size bookkeeping."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierloom.functions.columns import model_key, to_number, units_to_money
from tierloom.functions.sampling import hash_order
from tierloom.operators.topn import top_n_per_group
from tierloom.schemas import DEFAULT_FEATURES


def customer_features(profiles: DataFrame, as_of: str, carry: Sequence[str] = ()) -> DataFrame:
    """One row per customer: recency, frequency, age, order value, latest industry, segment and spend source.

    Works on customer profiles; the orders are not read again. `carry` names further profile columns to take
    from the latest profile.
    """
    traits = [c for c in ("INDUSTRY_CODE_DESC", "SEGMENT", "TAM_TIER_SOURCE", *carry) if c in profiles.columns]
    day = F.to_date(F.lit(as_of))
    per_customer = profiles.groupBy("CUSTOMER_ID").agg(
        F.max(F.struct("LAST_ORDER", *traits)).alias("__latest"),
        F.datediff(day, F.to_date(F.max("LAST_ORDER"))).cast("double").alias("RECENCY_DAYS"),
        F.sum("ORDER_ROWS").cast("double").alias("ORDER_FREQUENCY"),
        (F.datediff(day, F.to_date(F.min("FIRST_ORDER"))) / F.lit(365.25)).alias("CUSTOMER_AGE_YEARS"),
        F.try_divide(units_to_money(F.sum("GSAR_UNITS")), F.sum("VALUED_ORDERS")).alias("AVG_ORDER_VALUE"),
    )
    names = {"INDUSTRY_CODE_DESC": "MOST_RECENT_INDUSTRY_CODE_DESC"}
    return per_customer.select(
        "CUSTOMER_ID", *[F.col("__latest")[t].alias(names.get(t, t)) for t in traits], *DEFAULT_FEATURES)


def missing_features(df: DataFrame, features: Sequence[str]) -> list[str]:
    return [f for f in features if f not in df.columns]


def training_rows(
    customers: DataFrame, features: Sequence[str] = DEFAULT_FEATURES, industries: Sequence[str] = (),
    segment_col: str = "SEGMENT", industry_col: str = "MOST_RECENT_INDUSTRY_CODE_DESC",
) -> DataFrame:
    """Pruned rows of the wanted industries with SEGMENT_KEY, numeric features and a USABLE flag.

    Infinite and non-numeric values are NULL; a row is usable if every feature is present. No industries
    given means all of them. Feature columns the table lacks are left out and make no row usable.
    """
    if industries:
        customers = customers.where(F.upper(industry_col).isin([i.upper() for i in industries]))
    present = [f for f in features if f in customers.columns]
    segment = F.coalesce(F.col(segment_col).cast("string"), F.lit("NA"))
    rows = customers.select(
        "CUSTOMER_ID",
        model_key(F.col(industry_col), F.col(segment_col)).alias("SEGMENT_KEY"),
        F.upper(F.coalesce(F.col(industry_col), F.lit("NA"))).alias("INDUSTRY"),
        segment.alias("SEGMENT"),
        *[to_number(F.col(f)).alias(f) for f in present],
    )
    usable = F.lit(not missing_features(customers, features))
    for f in present:
        usable = usable & F.col(f).isNotNull()
    return rows.withColumn("USABLE", usable)


def train_input(rows: DataFrame, features: Sequence[str] = DEFAULT_FEATURES) -> DataFrame:
    return rows.where("USABLE").select("CUSTOMER_ID", "SEGMENT_KEY", *features)


def cap_per_industry(rows: DataFrame, max_rows: int = 0, industry_col: str = "INDUSTRY") -> DataFrame:
    """At most max_rows rows per industry, chosen in hash order; 0 keeps all."""
    if max_rows <= 0:
        return rows
    return top_n_per_group(rows, [industry_col], [hash_order("CUSTOMER_ID"), F.col("CUSTOMER_ID")], max_rows)


def segment_sizes(rows: DataFrame) -> DataFrame:
    return rows.groupBy("SEGMENT_KEY", "INDUSTRY", "SEGMENT").agg(
        F.count(F.lit(1)).alias("CUSTOMER_COUNT"), F.count_if("USABLE").alias("USABLE_COUNT"))


def k_candidates(sizes: DataFrame, clusters_min: int = 2, clusters_max: int = 10) -> DataFrame:
    """Adds K_LO and K_HI; K_HI below K_LO means that there is no candidate."""
    return sizes.withColumns({
        "K_LO": F.lit(max(clusters_min, 2)),
        "K_HI": F.least(
            F.lit(clusters_max), F.greatest(F.lit(2), F.floor(F.col("USABLE_COUNT") / 2).cast("int"))),
    })


def explode_k(candidates: DataFrame) -> DataFrame:
    """One row per (segment, K). Guarded, because sequence() counts down when the end lies below the start."""
    return candidates.where("K_HI >= K_LO").withColumn("K", F.explode(F.sequence("K_LO", "K_HI")))


def readiness(
    sizes: DataFrame, min_customers: int = 60, features_missing: bool = False,
    clusters_min: int = 2, clusters_max: int = 10,
) -> DataFrame:
    """Sizes with K_LO, K_HI and STATUS: why a segment is skipped, or READY."""
    status = (
        F.when(F.col("CUSTOMER_COUNT") < min_customers, "SKIPPED_TOO_SMALL")
        .when(F.lit(features_missing), "MISSING_FEATURES")
        .when(F.col("USABLE_COUNT") < min_customers, "SKIPPED_AFTER_DROPOFF")
        .when(F.col("K_HI") < F.col("K_LO"), "NO_K_CANDIDATES")
        .otherwise("READY")
    )
    return k_candidates(sizes, clusters_min, clusters_max).withColumn("STATUS", status)


def segment_status(ready: DataFrame, best: DataFrame) -> DataFrame:
    """READY becomes CLUSTERED when a best k exists and NO_VALID_K otherwise."""
    settled = F.when(F.col("STATUS") != "READY", F.col("STATUS")).when(
        F.col("BEST_K").isNotNull(), "CLUSTERED").otherwise("NO_VALID_K")
    return ready.join(best, "SEGMENT_KEY", "left").withColumn("STATUS", settled)
