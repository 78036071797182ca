"""Table, report and record writers."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, DataFrameWriter, Observation, SparkSession
from pyspark.sql import functions as F

from tierloom.sources.snapshots import SnapshotTable

EXPLANATION_COLUMNS = (
    "SEGMENT STRING, CLUSTER INT, CLUSTER_SHAP MAP<STRING, DOUBLE>, RUNID STRING, RUNTIMESTAMP STRING")


def safe_run_id(run_id: str) -> str:
    """Run id usable in names and paths."""
    return re.sub(r"[^A-Za-z0-9_]+", "_", run_id).strip("_")


# How run chunks of table names read.
_RUN_CHUNK, _RUN_STAMP = r"(?:CONN_EXTRACT_|PREPROCESS_|EXTRACT_)?(?:RUN_)?", r"\d{8}_\d{6}"
_TWO_CHUNKS = re.compile(rf"({_RUN_CHUNK})({_RUN_STAMP})_\1{_RUN_STAMP}$", re.IGNORECASE)
_LONGEST_SUFFIX = 48


def run_table_name(base: str, run_id: str) -> str:
    """base with the run id appended once: a name that ends in it stays, and of two run chunks of one kind at the end the
    first stays."""
    suffix = re.sub(r"[^A-Za-z0-9_]+", "_", run_id)[:_LONGEST_SUFFIX].rstrip("_")
    if suffix and not suffix.startswith("_"):
        suffix = f"_{suffix}"
    return _TWO_CHUNKS.sub(r"\1\2", base if base.endswith(suffix) else base + suffix)


def counted(df: DataFrame) -> tuple[DataFrame, Observation]:
    """df with a row count observed while it is written; read it as observation.get['rows']."""
    seen = Observation()
    return df.observe(seen, F.count(F.lit(1)).alias("rows")), seen


def write_run(df: DataFrame, path: str, run_id: str) -> int:
    """Adds the rows of a run to a table partitioned by RUN_ID; a repeated run replaces its own rows only."""
    df, seen = counted(df.withColumn("RUN_ID", F.lit(safe_run_id(run_id))))
    writer: DataFrameWriter = df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy("RUN_ID").parquet(path)
    return seen.get["rows"]


def append_rows(df: DataFrame, path: str) -> int:
    """Plain append; a repeated call adds the rows again."""
    df, seen = counted(df)
    df.write.mode("append").parquet(path)
    return seen.get["rows"]


def overwrite_table(df: DataFrame, table: str) -> int:
    """Replaces a catalog table."""
    df, seen = counted(df)
    df.write.mode("overwrite").saveAsTable(table)
    return seen.get["rows"]


def overwrite_path(df: DataFrame, path: str) -> int:
    """Replaces the table at path as a whole: readers (read_path) see the old rows until the new ones are there,
    and a job that dies leaves the old ones."""
    df, seen = counted(df)
    SnapshotTable(df.sparkSession, path).replace(df)
    return seen.get["rows"]


def read_path(spark: SparkSession, path: str) -> DataFrame:
    """The rows that overwrite_path wrote last."""
    return SnapshotTable(spark, path).read()


def ensure_explanation_table(spark: SparkSession, table: str) -> None:
    spark.sql(f"CREATE TABLE IF NOT EXISTS {table} ({EXPLANATION_COLUMNS}) USING parquet")


def append_explanations(spark: SparkSession, df: DataFrame, table: str) -> int:
    """Adds explanation rows to a catalog table, which is made if it is not there."""
    ensure_explanation_table(spark, table)
    df, seen = counted(df.select(*spark.table(table).columns))
    df.write.mode("append").insertInto(table)
    return seen.get["rows"]


def write_report(df: DataFrame, root: str, name: str, run_id: str) -> str:
    """JSON lines under root/<run_id>/<name>; reports have one row per feature, label, segment or run."""
    path = f"{root.rstrip('/')}/{safe_run_id(run_id)}/{name}"
    df.write.mode("overwrite").json(path)
    return path


def write_explanations(df: DataFrame, root: str) -> None:
    """JSON records per segment folder, without the plot column if there is one."""
    df.drop("CLUSTER_SHAP_PLOT").write.mode("overwrite").partitionBy("SEGMENT").json(root)


def append_accepted(records: DataFrame, path: str) -> None:
    """Registry of accepted models, one partition per run, so accepting a run twice leaves one record."""
    (records.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("run_id").parquet(path))
