from datetime import datetime

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierloom.operators import segments, spend
from tierloom.schemas import ORDERS_INPUT


def order(customer, year, gsar, industry="A", company="CHAIN", region="R", msa="M", tam=None, tier=None):
    return (customer, datetime(year, 3, 1), gsar, industry, company, region, msa, tam, tier)


def orders(spark, *rows):
    return spark.createDataFrame(list(rows), ORDERS_INPUT)


def one(df, column):
    return {r["CUSTOMER_ID"]: r[column] for r in df.collect()}


def test_average_ignores_years_without_value(spark):
    df = orders(spark, order(1, 2000, 10.0), order(1, 2000, 5.0), order(1, 2001, 7.0), order(1, 2002, None))
    assert one(spend.avg_annual_spend(df), "AVG_ANNUAL_SPEND") == {1: 11.0}
    assert one(spend.customer_profiles(df), "AVG_ANNUAL_SPEND") == {1: 11.0}


def test_average_spans_all_profiles_of_a_customer(spark):
    df = orders(spark, order(1, 2000, 10.0, msa="M"), order(1, 2001, 20.0, msa=None))
    profiles = spend.customer_profiles(df).collect()
    assert len(profiles) == 2 and {r["AVG_ANNUAL_SPEND"] for r in profiles} == {15.0}


def test_value_fallback_and_source(spark):
    df = orders(
        spark, order(1, 2000, 9.0, tam=0.0, tier="Tier 1"), order(2, 2000, 9.0, tier="Tier 2"),
        order(3, 2000, 9.0, tier="Other"), order(4, 2000, 9.0, tier="Tier 9"), order(5, 2000, None))
    rows = {r["CUSTOMER_ID"]: r for r in spend.customer_profiles(df).collect()}
    assert [rows[i]["TAM_TIER_SOURCE"] for i in range(1, 6)] == ["TAM", "TIER", "TIER", "AVG_ANNUAL_SPEND", "UNKNOWN"]
    assert [rows[i]["TAM_TIER_OR_AVGSPEND"] for i in range(1, 6)] == [0.0, 2.0, 4.0, 9.0, None]
    assert rows[4]["TIER_NUMERIC"] is None


def test_null_percentage(spark):
    df = orders(spark, order(1, 2000, 9.0), order(2, 2000, None), order(3, 2000, 1.0), order(4, 2000, 1.0, industry=None))
    rows = spend.null_pct_by_industry(spend.customer_profiles(df)).collect()
    assert [(r["INDUSTRY_CODE_DESC"], r["CUSTOMER_COUNT"], r["NULL_PCT"]) for r in rows] == [("A", 3, 33.33)]


def test_bins_and_quartile_edges(spark):
    df = orders(
        spark, *[order(i, 2000, 1.0, tam=float(v)) for i, v in enumerate([10, 20, 30, 40])],
        order(10, 2000, 1.0, tier="Tier 3"), order(11, 2000, None), order(12, 2000, 1.0, industry=None, tam=10.0))
    profiles = spend.customer_profiles(df)
    bins = one(spend.tier_bins(profiles, spend.spend_thresholds(profiles)), "TAM_TIER_BIN")
    assert [bins[i] for i in range(4)] == ["Low", "Medium-Low", "Medium-High", "High"]
    assert bins[10] == "Tier 3" and bins[11] == "NA"
    assert bins[12] == "High"  # the NULL industry finds no thresholds


def test_segment_keys_keep_null_parts(spark):
    df = orders(spark, order(1, 2000, 1.0, company=None, region=None, msa=None, tier="Tier 0"))
    profiles = spend.customer_profiles(df)
    row = segments.segment_keys(spend.tier_bins(profiles, spend.spend_thresholds(profiles))).first()
    assert row["RULE_BASED_SEGMENT"] == "A_NA_NA_NA_TIER_Tier 0"
    assert row["RULE_BASED_SEGMENT_NO_MSA"] == "A_NA_NA_TIER_Tier 0"
    assert row["RULE_BASED_SEGMENT_NO_MSA_NO_MSA_REGION"] == "A_NA_TIER_Tier 0"


@pytest.mark.parametrize("size, msa, level", [(2, True, 1), (3, True, 2), (4, True, 2), (5, True, 3), (2, False, 2)])
def test_backoff_needs_more_than_the_minimum(spark, size, msa, level):
    """3 customers share the full key, 5 the key without MSA, 6 the shortest one."""
    rows = [order(i, 2000, 1.0, tier="Tier 1") for i in range(3)]
    rows += [order(i, 2000, 1.0, msa="other", tier="Tier 1") for i in range(3, 5)]
    rows += [order(5, 2000, 1.0, region="far", tier="Tier 1")]
    result = one(segments.segment_profiles(orders(spark, *rows), size, msa), "SEGMENT_LEVEL")
    assert result[0] == level


def test_every_order_row_is_kept_once(spark):
    rows = [order(1, 2000 + i, 5.0, msa=None if i % 2 else "M", tam=float("nan") if i == 3 else None) for i in range(4)]
    df = orders(spark, *rows, order(2, 2001, None, industry=None, tier="Tier 9"))
    df = df.withColumn("TAM", F.when(~F.isnan("TAM"), F.col("TAM")))
    prepared = segments.prepare_orders(df, segments.segment_profiles(df, 1))
    assert prepared.count() == 5
    assert prepared.where("SEGMENT IS NULL").count() == 0
    assert {r["AVG_ANNUAL_SPEND"] for r in prepared.where("CUSTOMER_ID = 1").collect()} == {5.0}


def test_profiles_scan_orders_once_and_combine_before_shuffle(spark, tmp_path):
    path = str(tmp_path / "orders")
    orders(spark, order(1, 2000, 1.0)).write.parquet(path)
    plan = spend.customer_profiles(spark.read.parquet(path))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1
    assert plan.count("Exchange") == 2


def test_orders_without_a_customer_use_their_own_attributes(spark):
    rows = [order(None, 2000, 10.0, tam=5.0), order(None, 2000, 30.0), order(None, 2001, 50.0, tier="Tier 1"),
            order(1, 2000, 8.0)]
    df = spark.createDataFrame(rows, T.StructType([T.StructField(f.name, f.dataType) for f in ORDERS_INPUT]))
    profiles = segments.segment_profiles(df, min_segment_size=0)
    got = [(r["GSAR"], r["TAM_TIER_SOURCE"], r["AVG_ANNUAL_SPEND"], r["SEGMENT"] is not None)
           for r in segments.prepare_orders(df, profiles).orderBy("GSAR").collect()]
    assert got == [(8.0, "AVG_ANNUAL_SPEND", 8.0, True), (10.0, "TAM", None, True), (30.0, "UNKNOWN", None, True),
                   (50.0, "TIER", None, True)]


def test_small_and_huge_amounts(spark):
    df = orders(spark, *[order(1, 2000, 0.00004)] * 1000, order(2, 2000, 1e15), order(2, 2000, 1e15), order(3, 2000, 1e40))
    got = one(spend.avg_annual_spend(df), "AVG_ANNUAL_SPEND")
    assert got == {1: pytest.approx(0.04), 2: 2e15, 3: None}


def test_quartiles_are_exact_in_groups_beyond_the_sketch(spark):
    """A group far larger than the sketch's accuracy, and a NULL industry as a group of its own."""
    profiles = spark.range(20_000).selectExpr(
        "id as CUSTOMER_ID", "if(id % 4 = 0, null, 'A') as INDUSTRY_CODE_DESC", "'TAM' as TAM_TIER_SOURCE",
        "cast(pmod(xxhash64(id), 1000003) as double) as TAM_TIER_OR_AVGSPEND").repartition(7)
    got = {r[0]: tuple(r)[2:] for r in spend.spend_thresholds(profiles, accuracy=100).collect()}
    groups = {}
    for r in profiles.collect():
        groups.setdefault(r["INDUSTRY_CODE_DESC"], []).append(r["TAM_TIER_OR_AVGSPEND"])
    assert got == {k: tuple(sorted(v)[-(-len(v) * i // 4) - 1] for i in (1, 2, 3)) for k, v in groups.items()}
