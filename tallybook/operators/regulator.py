"""Regulator filings: deduction cap, dense skeletons, identifiers."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime, timedelta
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallybook.functions.money import EXACT
from tallybook.functions.periods import NTZ, moment

# --- fixed values -----------------------------------------------------------------------------
OPERATOR_ID = "OP100001"
SITE_ID = "S100001A"
FILE_VERSION = "1"
DEDUCTION_RATE = Decimal("0.10")
# ----------------------------------------------------------------------------------------------


def deduction_cap(df: DataFrame, rate: Decimal = DEDUCTION_RATE) -> DataFrame:
    """Add the cap shown (``ed_cap``) and the deduction allowed.

    Allowed are the promotional winnings, at most ``rate`` of wagers less winnings. The cap
    shown is 0 where there were no promotional winnings; unknown winnings give an unknown
    deduction, and a negative margin a negative one.
    """
    margin = ((F.col("wagers") - F.col("winnings")).cast("decimal(28,9)") * F.lit(rate)).cast(EXACT)
    promo = F.col("free_bet_winnings")
    return df.withColumns(
        {
            "ed_cap": F.when(promo == 0, F.lit(0).cast(EXACT)).otherwise(margin),
            "eligible_deductions": F.when(promo >= margin, margin).otherwise(promo.cast(EXACT)),
        }
    )


def period_skeleton(
    spark: SparkSession,
    products: Sequence[str],
    first_day: datetime,
    *,
    days: int = 1,
    length: timedelta = timedelta(0),
) -> DataFrame:
    """One row per gaming day and product; each day's period runs for ``length``.

    A filing covers a single day; several days give the filings of all of them at once.
    """
    day = F.expr("make_dt_interval(cast(id as int))")
    rows = spark.range(days).select((moment(first_day) + day).cast(NTZ).alias("gaming_day"))
    length_s = F.make_dt_interval(secs=F.lit(int(length.total_seconds())))
    return rows.select(
        "gaming_day",
        F.col("gaming_day").alias("period_start"),
        (F.col("gaming_day") + length_s).alias("period_end"),
        F.explode(F.array(*[F.lit(p) for p in products])).alias("product_code"),
    )


def densify(facts: DataFrame, skeleton: DataFrame, on: Sequence[str]) -> DataFrame:
    """Every skeleton row with its facts; facts the skeleton does not name vanish."""
    return skeleton.join(facts, list(on), "left")


def report_ids(
    skeleton: DataFrame,
    *,
    transaction_day_pattern: str = "yyMMdd",
    transaction_day_back: int = 0,
    prefix: str = "",
) -> DataFrame:
    """Transaction id, file name and record id from the parts of the period."""
    back = F.make_dt_interval(F.lit(transaction_day_back))
    stamp = F.date_format(F.col("period_end") - back, transaction_day_pattern)
    start, end = (F.date_format(c, "yyyyMMdd") for c in ("period_start", "period_end"))
    operator, site, version = F.lit(OPERATOR_ID), F.lit(SITE_ID), F.lit(FILE_VERSION)
    ids = skeleton.withColumns(
        {
            "igo_operator_id": operator,
            "gaming_site_id": site,
            "file_version": version,
            "transaction_date": F.col("period_end") + F.make_dt_interval(F.lit(1)),
            "transaction_id": F.concat(operator, stamp),
        }
    )
    gap = F.lit("_")
    plain = F.col("transaction_id")
    return ids.withColumns(
        {
            "ggr_file_name": F.concat(F.lit("GGR_"), operator, gap, plain, gap, start, gap, end, gap, version),
            "record_id": F.concat(
                plain, gap, version, gap, operator, gap, site, gap, start, gap, F.col("product_code")
            ),
            "transaction_id": F.concat(F.lit(prefix), plain),
        }
    )
