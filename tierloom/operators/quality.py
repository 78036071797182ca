"""Feature statistics, data quality and the comparison with a stored baseline."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierloom.functions.columns import (
    band, bound_check, finite, severity, status_of_rank, status_rank, step_status, to_number)
from tierloom.functions.sampling import hash_order
from tierloom.operators.topn import top_n_per_group


def dq_check(df: DataFrame, required: Sequence[str], min_rows: int = 100) -> DataFrame:
    """One row per required column: presence, row count, null rate, ok / fail."""
    present = [c for c in required if c in df.columns]
    stats = df.agg(
        F.count(F.lit(1)).alias("n"), *[F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in present])

    def entry(c: str):
        here = c in present
        rate = F.try_divide(F.col(f"null_{c}"), F.col("n")) if here else F.lit(None).cast("double")
        ok = F.lit(here) & (F.col("n") >= min_rows)
        return F.struct(
            F.lit(c).alias("COLUMN_NAME"), F.lit(here).alias("PRESENT"), F.col("n").alias("TOTAL_ROWS"),
            rate.alias("NULL_RATE"), F.when(ok, "ok").otherwise("fail").alias("STATUS"))

    return stats.select(F.inline(F.array(*[entry(c) for c in required])))


def feature_stats(df: DataFrame, features: Sequence[str], accuracy: int = 10_000) -> DataFrame:
    """FEATURE, TOTAL_ROWS, P1, P99, MEAN, NULL_PCT from a single scan: one wide aggregate, whatever the number of
    features. An empty table gives a row for each feature."""
    aggs = [F.count(F.lit(1)).alias("n")]
    for f in features:
        x = to_number(F.col(f))
        aggs.append(F.struct(
            F.percentile_approx(x, [0.01, 0.99], accuracy).alias("q"), F.avg(x).alias("mean"),
            F.count_if(x.isNull()).alias("nulls")).alias(f"s_{f}"))

    def entry(f: str):
        s = F.col(f"s_{f}")
        return F.struct(
            F.lit(f).alias("FEATURE"), F.col("n").alias("TOTAL_ROWS"), s["q"][0].alias("P1"),
            s["q"][1].alias("P99"), s["mean"].alias("MEAN"),
            F.try_divide(s["nulls"], F.col("n")).alias("NULL_PCT"))

    return df.agg(*aggs).select(F.inline(F.array(*[entry(f) for f in features])))


def baseline_coverage(baseline: DataFrame, df: DataFrame) -> DataFrame:
    """FEATURE, PRESENT for every baseline feature."""
    names = df.sparkSession.createDataFrame([(c,) for c in df.columns], "FEATURE string")
    found = baseline.join(names, "FEATURE", "inner").select("FEATURE", F.lit(True).alias("PRESENT"))
    absent = baseline.join(names, "FEATURE", "left_anti").select("FEATURE", F.lit(False).alias("PRESENT"))
    return found.unionByName(absent)


def feature_check(
    stats: DataFrame, baseline: DataFrame, overrides: DataFrame | None = None, flex_pct: float = 0.5,
    null_warn_delta: float = 0.10, null_fail_delta: float = 0.30,
) -> DataFrame:
    """One row per baseline feature with its band results, null delta, p99 severity and STATUS.

    A feature the table does not have fails. All inputs have one row per feature.
    """
    df = baseline.join(stats, "FEATURE", "left")
    if overrides is not None:
        df = df.join(overrides.withColumnRenamed("FLEX_PCT", "__flex"), "FEATURE", "left")
        df = df.withColumn("FLEX_PCT", F.coalesce("__flex", F.lit(flex_pct))).drop("__flex")
    else:
        df = df.withColumn("FLEX_PCT", F.lit(flex_pct))
    flex = F.col("FLEX_PCT")
    df = df.withColumns({
        "PRESENT": F.col("TOTAL_ROWS").isNotNull(),
        "P1_RESULT": bound_check(F.col("BASE_P1"), F.col("P1"), flex),
        "P99_RESULT": bound_check(F.col("BASE_P99"), F.col("P99"), flex),
        "MEAN_RESULT": bound_check(F.col("BASE_MEAN"), F.col("MEAN"), flex),
        "NULL_DELTA": F.col("NULL_PCT") - F.coalesce("BASE_NULL_PCT", F.lit(0.0)),
    })
    df = df.withColumns({
        "NULL_RESULT": step_status(F.col("NULL_DELTA"), null_warn_delta, null_fail_delta),
        "P99_SEVERITY": F.when(
            F.col("P99_RESULT") == "out", severity(F.col("BASE_P99"), F.col("P99"))).otherwise(0.0),
    })
    any_out = (F.col("P1_RESULT") == "out") | (F.col("P99_RESULT") == "out") | (F.col("MEAN_RESULT") == "out")
    status = (
        F.when(~F.col("PRESENT") | (F.col("NULL_RESULT") == "fail") | (F.col("P99_SEVERITY") > 1.0), "fail")
        .when(any_out | (F.col("NULL_RESULT") == "warn"), "warn")
        .otherwise("ok")
    )
    return df.withColumn("STATUS", status)


def roll_up(checks: DataFrame, status_col: str = "STATUS") -> DataFrame:
    """One row: the worst status (no rows read ok) and how many rows have which status."""
    status = F.col(status_col)
    return checks.agg(
        status_of_rank(F.coalesce(F.max(status_rank(status)), F.lit(0))).alias("STATUS"),
        F.count(F.lit(1)).alias("CHECKED"),
        F.count_if(status == "warn").alias("WARNED"),
        F.count_if(status == "fail").alias("FAILED"),
    )


def feature_gate(checks: DataFrame) -> DataFrame:
    """roll_up plus the rule that a table with none of the baseline features fails."""
    gate = checks.agg(F.count_if("PRESENT").alias("PRESENT_FEATURES"), *_rollup_columns())
    return gate.withColumn(
        "STATUS", F.when(F.col("PRESENT_FEATURES") == 0, "fail").otherwise(F.col("STATUS")))


def _rollup_columns():
    status = F.col("STATUS")
    return [
        status_of_rank(F.coalesce(F.max(status_rank(status)), F.lit(0))).alias("STATUS"),
        F.count_if(status == "fail").alias("FAILED"),
        F.count_if(status == "warn").alias("WARNED"),
    ]


def failing_rows(df: DataFrame, checks: DataFrame, features: Sequence[str], key: str, max_rows: int = 10) -> DataFrame:
    """Up to max_rows extreme rows of each failing feature: value above p99 or below p1, widened by the flex.

    Adds FEATURE and FEATURE_VALUE to the whole row. The bounds are one row per feature, so they are attached
    as a broadcast: their number is the number of columns of the table.
    """
    bounds = checks.where((F.col("STATUS") == "fail") & F.col("PRESENT")).select(
        "FEATURE",
        band(F.col("BASE_P99"), F.col("FLEX_PCT"))[1].alias("__upper"),
        band(F.col("BASE_P1"), F.col("FLEX_PCT"))[0].alias("__lower"),
    )
    entries = F.array(*[F.struct(
        F.lit(f).alias("FEATURE"), finite(F.col(f).cast("double")).alias("FEATURE_VALUE")) for f in features])
    extreme = (F.col("FEATURE_VALUE") > F.col("__upper")) | (F.col("FEATURE_VALUE") < F.col("__lower"))
    rows = (
        df.select("*", F.inline(entries))
        .join(F.broadcast(bounds), "FEATURE")
        .where(extreme)
        .drop("__upper", "__lower")
    )
    return top_n_per_group(rows, ["FEATURE"], [hash_order(key), F.col(key)], max_rows)
