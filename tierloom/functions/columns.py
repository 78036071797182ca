"""Column expressions of the segmentation rules. All of them run JVM-side."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Tier texts and their codes; any other text has no code.
TIER_CODES = {"Tier 0": 0, "Tier 1": 1, "Tier 2": 2, "Tier 3": 3, "Other": 4}

# Money is summed as decimals, which makes the sums independent of row order. Twelve places keep any amount that
# matters; amounts of 10^26 and more do not fit and count as no number.
MONEY_TYPE = "decimal(38,12)"

STATUS_LEVELS = ["ok", "warn", "fail"]


def finite(c: Column) -> Column:
    """NaN and infinities become NULL (NaN sorts above every number in Spark)."""
    return F.when(F.abs(c) < F.lit(float("inf")), c)


def to_number(c: Column) -> Column:
    """Numeric coercion: values that are no finite number become NULL."""
    return finite(c.try_cast("double"))


def money_units(c: Column) -> Column:
    return to_number(c).try_cast(MONEY_TYPE)


def units_to_money(units: Column) -> Column:
    return units.cast("double")


def tier_code(tier: Column) -> Column:
    pairs = [F.lit(x) for pair in TIER_CODES.items() for x in pair]
    return F.try_element_at(F.create_map(*pairs), tier)


def spend_value(tam: Column, tier_numeric: Column, avg_spend: Column) -> Column:
    return F.coalesce(tam.cast("double"), tier_numeric.cast("double"), avg_spend.cast("double"))


def spend_source(tam: Column, tier_numeric: Column, avg_spend: Column) -> Column:
    return (
        F.when(tam.isNotNull(), "TAM")
        .when(tier_numeric.isNotNull(), "TIER")
        .when(avg_spend.isNotNull(), "AVG_ANNUAL_SPEND")
        .otherwise("UNKNOWN")
    )


def spend_bin(source: Column, tier: Column, value: Column, q1: Column, q2: Column, q3: Column) -> Column:
    """Quartile label. A row without thresholds compares to NULL everywhere and lands in 'High'."""
    return (
        F.when(source == "TIER", tier)
        .when(value.isNull(), "NA")
        .when(value <= q1, "Low")
        .when((value > q1) & (value <= q2), "Medium-Low")
        .when((value > q2) & (value <= q3), "Medium-High")
        .otherwise("High")
    )


def segment_name(*parts: str) -> Column:
    """Key parts joined by '_'. NULL parts read 'NA' first, because concat_ws would skip them."""
    return F.concat_ws("_", *[F.coalesce(F.col(p), F.lit("NA")) for p in parts])


def model_key(industry: Column, segment: Column) -> Column:
    """INDUSTRY::SEGMENT, the one key under which models are stored and looked up."""
    return F.concat(
        F.upper(F.coalesce(industry, F.lit("NA"))), F.lit("::"),
        F.coalesce(segment.cast("string"), F.lit("NA")))


def band(baseline: Column, flex: Column) -> tuple[Column, Column]:
    """Lower and upper end of a multiplicative tolerance band; near zero it is additive.

    A negative baseline swaps the two ends, so they are ordered here.
    """
    slack = F.when(F.abs(baseline) < 1e-6, F.greatest(F.lit(1.0), F.abs(baseline) * flex)).otherwise(
        F.abs(baseline * flex))
    return baseline - slack, baseline + slack


def bound_check(baseline: Column, current: Column, flex: Column) -> Column:
    """in / out / missing for the tolerance band around the baseline."""
    lower, upper = band(baseline, flex)
    return (
        F.when(baseline.isNull() | current.isNull(), "missing")
        .when((current < lower) | (current > upper), "out")
        .otherwise("in")
    )


def severity(baseline: Column, current: Column) -> Column:
    moved = F.abs(current - baseline)
    return (
        F.when(baseline.isNull() | current.isNull(), 0.0)
        .when(F.abs(baseline) < 1e-6, moved)
        .otherwise(moved / (F.abs(baseline) + 1e-9))
    )


def step_status(value: Column, warn: float, fail: float, inclusive: bool = False) -> Column:
    """ok / warn / fail by two thresholds; NULL reads ok."""
    over = (lambda t: value >= t) if inclusive else (lambda t: value > t)
    return F.when(over(F.lit(fail)), "fail").when(over(F.lit(warn)), "warn").otherwise("ok")


def status_rank(status: Column) -> Column:
    return F.when(status == "fail", 2).when(status == "warn", 1).otherwise(0)


def status_of_rank(rank: Column) -> Column:
    return F.when(rank == 2, "fail").when(rank == 1, "warn").otherwise("ok")


def clipped_share(share: Column, eps: float = 1e-8) -> Column:
    return F.least(F.greatest(share, F.lit(eps)), F.lit(1.0))


def psi_term(expected: Column, actual: Column) -> Column:
    e, a = clipped_share(expected), clipped_share(actual)
    return (a - e) * F.log(a / e)


def kl_term(p: Column, q: Column) -> Column:
    p, q = clipped_share(p), clipped_share(q)
    return p * F.log(p / q)
