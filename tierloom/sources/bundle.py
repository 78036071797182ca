"""Model bundles: the model table partitioned by run, run selection, JSON export and import."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierloom.functions.columns import model_key
from tierloom.schemas import MANIFEST_DOCUMENT, SEGMENT_DOCUMENT, SEGMENT_MODEL


def write_bundle(models: DataFrame, root: str) -> None:
    """Writes the runs found in `models` under root/run_id=...; writing a run again replaces it."""
    models.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("run_id").parquet(root)


def read_bundle(spark: SparkSession, root: str) -> DataFrame:
    models = spark.read.schema(SEGMENT_MODEL).parquet(root)
    return models.select(*SEGMENT_MODEL.fieldNames())


def latest_run(models: DataFrame) -> DataFrame:
    """Models of the run with the greatest run_id, by a filter that prunes the partitions of other runs."""
    newest = models.agg(F.max("run_id").alias("run_id")).first()["run_id"]
    return models.where(F.col("run_id") == newest)


def resolve_run(models: DataFrame, run_id: str = "latest") -> DataFrame:
    """Models of the named run, or of the newest one; an unknown run is an error."""
    if not run_id or run_id.lower() == "latest":
        return latest_run(models)
    chosen = models.where(F.col("run_id") == run_id)
    if chosen.isEmpty():
        raise ValueError(f"run {run_id!r} is not in the model table")
    return chosen


def open_run(spark: SparkSession, base: str, run_id: str = "latest") -> DataFrame:
    """As resolve_run from storage; `base` may also be the folder of one run itself (.../run_id=X)."""
    leaf = base.rstrip("/").rsplit("/", 1)[-1]
    if leaf.startswith("run_id="):
        own = leaf.split("=", 1)[1]
        inner = T.StructType([f for f in SEGMENT_MODEL if f.name != "run_id"])
        return spark.read.schema(inner).parquet(base).withColumn("run_id", F.lit(own)).select(
            *SEGMENT_MODEL.fieldNames())
    return resolve_run(read_bundle(spark, base), run_id)


def artifact_name(industry, segment):
    """A name that tells the segment, with a digest of the key, as different keys can read alike in it."""
    return F.concat(
        F.lit("segment_"), F.upper(industry), F.lit("_"), F.replace(segment, F.lit(" "), F.lit("_")), F.lit("_"),
        F.substring(F.md5(model_key(industry, segment).cast("binary")), 1, 16), F.lit(".json"))


def export_json(
    models: DataFrame, folder: str, clusters_min: int = 2, clusters_max: int = 10, min_customers: int = 60,
) -> None:
    """JSON copy of one run: folder/manifest.json and folder/segments, one line per clustered segment.

    The manifest document lists all segments in one object by its format; the model table has no such limit.
    """
    artifact = F.when(F.col("status") == "CLUSTERED", artifact_name(F.col("industry"), F.col("segment")))
    entry = F.struct(
        "segment_key", F.struct(
            "status", "customer_count", "best_k", "best_silhouette", "results_k", artifact.alias("artifact")))
    manifest = models.groupBy("run_id", "run_timestamp").agg(
        F.array_sort(F.collect_set("industry")).alias("industries"),
        F.max("features").alias("feature_cols"),
        F.map_from_entries(F.collect_list(entry)).alias("segments"),
    ).withColumns({
        "clusters_min": F.lit(clusters_min), "clusters_max": F.lit(clusters_max),
        "min_customers_for_cluster": F.lit(min_customers)})
    manifest.select(*MANIFEST_DOCUMENT.fieldNames()).write.mode("overwrite").json(f"{folder}/manifest.json")
    models.where(F.col("status") == "CLUSTERED").select(
        "status", "industry", "segment", "customer_count", "best_k", "best_silhouette", "results_k", "features",
        F.struct("center", "scale").alias("scaler"), "centroids", "input_table", "x_cols", "y_col", "output_table", artifact.alias("artifact"),
    ).write.mode("overwrite").json(f"{folder}/segments")


def import_json(
    spark: SparkSession, folder: str, segments: str = "segment_*.json", multi_line: bool = True,
) -> DataFrame:
    """The model table of a JSON bundle: every manifest entry, with the segment file it names if that exists.

    The defaults read one pretty-printed document per segment; a folder written by export_json is read with
    segments="segments", multi_line=False.
    """
    manifest = spark.read.schema(MANIFEST_DOCUMENT).json(f"{folder}/manifest.json", multiLine=multi_line)
    entries = manifest.select("run_id", "run_timestamp", F.explode("segments").alias("segment_key", "info"))
    document = T.StructType([*SEGMENT_DOCUMENT, T.StructField("artifact", T.StringType())])
    files = spark.read.schema(document).json(f"{folder}/{segments}", multiLine=multi_line)
    files = files.select(
        F.struct(*[c for c in files.columns if c != "artifact"]).alias("doc"),
        F.coalesce("artifact", "_metadata.file_name").alias("__file"))
    joined = entries.join(files, F.col("info.artifact") == F.col("__file"), "left")
    parts = F.split("segment_key", "::", 2)
    found = F.col("doc").isNotNull()
    table = joined.select(
        "run_id", "run_timestamp",
        F.when(found, model_key(F.col("doc.industry"), F.col("doc.segment"))).otherwise(F.col("segment_key"))
        .alias("segment_key"),
        F.coalesce("doc.industry", parts[0]).alias("industry"),
        F.coalesce("doc.segment", F.try_element_at(parts, F.lit(2))).alias("segment"),
        F.when((F.col("info.status") == "CLUSTERED") & ~found, "ARTIFACT_MISSING")
        .otherwise(F.col("info.status")).alias("status"),
        F.coalesce("info.customer_count", "doc.customer_count").alias("customer_count"),
        F.coalesce("info.best_k", "doc.best_k").alias("best_k"),
        F.coalesce("info.best_silhouette", "doc.best_silhouette").alias("best_silhouette"),
        F.coalesce("doc.results_k", "info.results_k").alias("results_k"),
        "doc.features", "doc.scaler.center", "doc.scaler.scale", "doc.centroids",
        F.coalesce("doc.input_table", "doc.data_table").alias("input_table"), "doc.x_cols",
        # The label column comes as a name or as a list with one name.
        F.nullif(F.regexp_extract("doc.y_col", r'^\s*\[?\s*"?([^"\[\]]*?)"?\s*\]?\s*$', 1), F.lit("")).alias("y_col"),
        F.coalesce("doc.output_table", "doc.target_table").alias("output_table"))
    return table.select(*[F.col(f.name).cast(f.dataType) for f in SEGMENT_MODEL])


def bundle_files(spark: SparkSession, folder: str) -> DataFrame:
    """PATH and BYTES of the files of a bundle; the contents are not read."""
    return (
        spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder)
        .select(F.col("path").alias("PATH"), F.col("length").alias("BYTES"))
    )


def centroid_rows(models: DataFrame) -> DataFrame:
    """Long form of the clustered models: one row per (run, segment, cluster, feature)."""
    per_cluster = models.where(F.col("status") == "CLUSTERED").select(
        "run_id", "segment_key", "best_k", "features", "center", "scale",
        F.posexplode("centroids").alias("CLUSTER", "c"))
    fields = F.arrays_zip("features", "center", "scale", "c")
    return per_cluster.select("run_id", "segment_key", "best_k", "CLUSTER", F.explode(fields).alias("f")).select(
        "run_id", "segment_key", "best_k", "CLUSTER", F.col("f.features").alias("FEATURE"),
        F.col("f.center").alias("CENTER"), F.col("f.scale").alias("SCALE"), F.col("f.c").alias("COORDINATE"))
