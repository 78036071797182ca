"""Column names and table schemas shared by the stages."""

from pyspark.sql import types as T

PROFILE_DIMS = ["INDUSTRY_CODE_DESC", "COMPANY_TYPE_DESC", "MSA_REGION", "MSA", "TAM", "TIER"]

SEGMENT_LEVELS = [
    "RULE_BASED_SEGMENT",
    "RULE_BASED_SEGMENT_NO_MSA",
    "RULE_BASED_SEGMENT_NO_MSA_NO_MSA_REGION",
]

DEFAULT_FEATURES = ["RECENCY_DAYS", "ORDER_FREQUENCY", "CUSTOMER_AGE_YEARS", "AVG_ORDER_VALUE"]

ORDERS_INPUT = T.StructType([
    T.StructField("CUSTOMER_ID", T.LongType(), False),
    T.StructField("ORDER_DATE", T.TimestampNTZType(), False),
    T.StructField("GSAR", T.DoubleType()),
    T.StructField("INDUSTRY_CODE_DESC", T.StringType()),
    T.StructField("COMPANY_TYPE_DESC", T.StringType()),
    T.StructField("MSA_REGION", T.StringType()),
    T.StructField("MSA", T.StringType()),
    T.StructField("TAM", T.DoubleType()),
    T.StructField("TIER", T.StringType()),
])

BASELINE_STATS = T.StructType([
    T.StructField("p1", T.DoubleType()),
    T.StructField("p99", T.DoubleType()),
    T.StructField("mean", T.DoubleType()),
    T.StructField("null_pct", T.DoubleType()),
])

K_SCORE = T.StructType([
    T.StructField("k", T.IntegerType()),
    T.StructField("silhouette", T.DoubleType()),
])

VECTOR = T.ArrayType(T.DoubleType())

# One row per (run_id, segment_key); the canonical form of a trained model bundle.
SEGMENT_MODEL = T.StructType([
    T.StructField("run_id", T.StringType()),
    T.StructField("run_timestamp", T.StringType()),
    T.StructField("segment_key", T.StringType()),
    T.StructField("industry", T.StringType()),
    T.StructField("segment", T.StringType()),
    T.StructField("status", T.StringType()),
    T.StructField("customer_count", T.LongType()),
    T.StructField("best_k", T.IntegerType()),
    T.StructField("best_silhouette", T.DoubleType()),
    T.StructField("results_k", T.ArrayType(K_SCORE)),
    T.StructField("features", T.ArrayType(T.StringType())),
    T.StructField("center", VECTOR),
    T.StructField("scale", VECTOR),
    T.StructField("centroids", T.ArrayType(VECTOR)),
    T.StructField("input_table", T.StringType()),
    # What an explanation of the segment reads and writes, where it is not the job's: columns, label column, table.
    T.StructField("x_cols", T.ArrayType(T.StringType())),
    T.StructField("y_col", T.StringType()),
    T.StructField("output_table", T.StringType()),
])

# JSON documents of a bundle folder: manifest.json and the segment files it names.
MANIFEST_DOCUMENT = T.StructType([
    T.StructField("run_id", T.StringType()),
    T.StructField("run_timestamp", T.StringType()),
    T.StructField("industries", T.ArrayType(T.StringType())),
    T.StructField("feature_cols", T.ArrayType(T.StringType())),
    T.StructField("clusters_min", T.IntegerType()),
    T.StructField("clusters_max", T.IntegerType()),
    T.StructField("min_customers_for_cluster", T.IntegerType()),
    T.StructField("segments", T.MapType(T.StringType(), T.StructType([
        T.StructField("status", T.StringType()),
        T.StructField("customer_count", T.LongType()),
        T.StructField("best_k", T.IntegerType()),
        T.StructField("best_silhouette", T.DoubleType()),
        T.StructField("results_k", T.ArrayType(K_SCORE)),
        T.StructField("artifact", T.StringType()),
    ]))),
])

SEGMENT_DOCUMENT = T.StructType([
    T.StructField("status", T.StringType()),
    T.StructField("industry", T.StringType()),
    T.StructField("segment", T.StringType()),
    T.StructField("customer_count", T.LongType()),
    T.StructField("best_k", T.IntegerType()),
    T.StructField("best_silhouette", T.DoubleType()),
    T.StructField("results_k", T.ArrayType(K_SCORE)),
    T.StructField("features", T.ArrayType(T.StringType())),
    T.StructField("scaler", T.StructType([
        T.StructField("center", VECTOR),
        T.StructField("scale", VECTOR),
    ])),
    T.StructField("centroids", T.ArrayType(VECTOR)),
    T.StructField("input_table", T.StringType()),
    T.StructField("data_table", T.StringType()),
    T.StructField("x_cols", T.ArrayType(T.StringType())),
    T.StructField("y_col", T.StringType()),
    T.StructField("output_table", T.StringType()),
    T.StructField("target_table", T.StringType()),
])
