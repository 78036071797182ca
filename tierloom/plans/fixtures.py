"""The order-grain input, drift halves and fixed-centroid models, derived from the star-schema test tables."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tierloom.functions.columns import tier_code
from tierloom.operators import customers as cust
from tierloom.operators import kmeans, scaling, selection, spend
from tierloom.operators.silhouette import silhouette
from tierloom.operators.topn import top_n_per_group
from tierloom.schemas import DEFAULT_FEATURES
from tierloom.sources.staging import stage

AS_OF = "2001-08-01"
SPLIT_DATE = "1998-05-01"
MIN_SEGMENT_SIZE = 2
MIN_CUSTOMERS = 20
FIXED_KS = (2, 3, 4)
RUN_ID = "run_fixed"
RUN_STAMP = "20010801_000000"
COARSE = "TAM_TIER_SOURCE"
GLOBAL_FEATURES = ["RECENCY_DAYS", "ORDER_FREQUENCY", "AVG_ORDER_VALUE", "TAM"]
DRIFT_FEATURES = ["GSAR", "TAM", "TIER_NUMERIC", "FLAT", "RARE"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def orders_input(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("c_custkey")
    tiers = {1: "Tier 0", 2: "Tier 1", 4: "Tier 3", 5: "Other", 7: "Tier 9"}
    tier = F.lit(None).cast("string")
    for rest, name in tiers.items():
        tier = F.when(key % 9 == rest, name).otherwise(tier)
    customer = table(spark, sf_dir, "customer")
    places = table(spark, sf_dir, "nation").join(
        table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    return (
        table(spark, sf_dir, "orders")
        .join(customer, F.col("o_custkey") == key)
        .join(places, F.col("c_nationkey") == F.col("n_nationkey"))
        .select(
            F.col("o_orderkey").alias("ORDER_ID"),
            F.col("o_custkey").alias("CUSTOMER_ID"),
            F.col("o_orderdate").alias("ORDER_DATE"),
            F.col("o_totalprice").alias("GSAR"),
            F.when(key % 50 != 49, F.col("c_mktsegment")).alias("INDUSTRY_CODE_DESC"),
            F.when(key % 2 == 0, "CHAIN").when(key % 7 != 0, "SINGLE").alias("COMPANY_TYPE_DESC"),
            F.col("r_name").alias("MSA_REGION"),
            F.when(F.col("c_nationkey") % 5 != 4, F.col("n_name")).alias("MSA"),
            F.when(key % 3 == 0, F.col("c_acctbal")).alias("TAM"),
            tier.alias("TIER"))
    )


def customers(orders: DataFrame) -> DataFrame:
    """Customer features with the spend source as coarse segment, and TAM."""
    profiles = spend.customer_profiles(orders)
    return cust.customer_features(profiles, AS_OF, carry=["TAM"])


def drift_columns(orders: DataFrame) -> DataFrame:
    """Orders with the numeric columns that drift is watched on."""
    return orders.withColumns({
        "TIER_NUMERIC": tier_code(F.col("TIER")),
        "FLAT": F.lit(1.0),
        "RARE": F.when(F.col("CUSTOMER_ID") % 997 == 0, F.col("GSAR")),
    })


def drift_halves(orders: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Orders before and from SPLIT_DATE; the later half has raised revenue and more missing TAM."""
    before = F.col("ORDER_DATE") < F.lit(SPLIT_DATE).cast("timestamp_ntz")
    df = drift_columns(orders)
    later = df.where(~before).withColumns({
        "GSAR": F.col("GSAR") * 2.5,
        "TAM": F.when(F.col("CUSTOMER_ID") % 2 == 1, F.col("TAM")),
    })
    return df.where(before), later


def stored_baseline(stats: DataFrame) -> DataFrame:
    """Baseline rows from feature_stats, plus a feature that no table has."""
    rows = stats.select(
        "FEATURE", F.col("P1").alias("BASE_P1"), F.col("P99").alias("BASE_P99"), F.col("MEAN").alias("BASE_MEAN"),
        F.col("NULL_PCT").alias("BASE_NULL_PCT"))
    absent = stats.sparkSession.createDataFrame([("LIFETIME_VALUE", 0.0, 9.0, 1.0, 0.0)], rows.schema)
    return rows.unionByName(absent)


class FixedModels:
    """Models whose centroids are the scaled vectors of the customers with the smallest ids of a segment."""

    def __init__(self, all_customers: DataFrame):
        self.rows = cust.training_rows(all_customers, DEFAULT_FEATURES, segment_col=COARSE)

    @cached_property
    def ready(self) -> DataFrame:
        sizes = cust.segment_sizes(self.rows)
        return stage(cust.readiness(sizes, MIN_CUSTOMERS, clusters_max=max(FIXED_KS)), "ready")

    @cached_property
    def train(self) -> DataFrame:
        keys = self.ready.where("STATUS = 'READY'").select("SEGMENT_KEY")
        return self.rows.where("USABLE").join(keys, "SEGMENT_KEY").select(
            "CUSTOMER_ID", "SEGMENT_KEY", *DEFAULT_FEATURES)

    @cached_property
    def scaler(self) -> DataFrame:
        return stage(scaling.robust_scaler(self.train, DEFAULT_FEATURES), "scaler")

    @cached_property
    def scaled(self) -> DataFrame:
        return scaling.scaled_rows(self.train, self.scaler, DEFAULT_FEATURES)

    @cached_property
    def points(self) -> DataFrame:
        return stage(kmeans.weighted_points(self.scaled), "points")

    @cached_property
    def models(self) -> DataFrame:
        seeds = top_n_per_group(
            self.scaled, ["SEGMENT_KEY"], [F.col("CUSTOMER_ID")], max(FIXED_KS), rank_col="NO")
        firsts = seeds.groupBy("SEGMENT_KEY").agg(
            F.transform(F.array_sort(F.collect_list(F.struct("NO", "Z"))), lambda s: s["Z"]).alias("ALL"))
        return stage(
            firsts.withColumn("K", F.explode(F.array(*[F.lit(k) for k in FIXED_KS])))
            .select("SEGMENT_KEY", "K", F.lit(1).alias("RESTART"), F.slice("ALL", 1, F.col("K")).alias("CENTERS")),
            "fixed-models")

    def scores(self) -> DataFrame:
        labelled = kmeans.label_points(self.points, self.models, len(DEFAULT_FEATURES))
        return stage(silhouette(labelled), "scores")

    def model_table(self) -> DataFrame:
        scores = self.scores()
        status = cust.segment_status(self.ready, selection.best_k(scores))
        return stage(
            selection.model_table(
                status, scores, self.models, self.scaler, DEFAULT_FEATURES, RUN_ID, RUN_STAMP),
            "model-table")

    def model_of_k(self, k: int) -> DataFrame:
        """Model table with one fixed k for every segment; needs no silhouettes."""
        status = self.ready.withColumns({
            "STATUS": F.when(F.col("STATUS") == "READY", "CLUSTERED").otherwise(F.col("STATUS")),
            "BEST_K": F.lit(k), "BEST_SILHOUETTE": F.lit(None).cast("double")})
        no_scores = self.models.where("K = 0").select("SEGMENT_KEY", "K", F.lit(0.0).alias("SILHOUETTE"))
        return stage(
            selection.model_table(
                status, no_scores, self.models, self.scaler, DEFAULT_FEATURES, RUN_ID, RUN_STAMP),
            "model-table")


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """All double columns rounded, for value comparison between engines (adding 0.0 turns -0.0 into 0.0)."""
    return df.select(*[
        (F.round(F.col(f.name), digits) + F.lit(0.0)).alias(f.name) if f.dataType.typeName() == "double"
        else F.col(f.name) for f in df.schema])

