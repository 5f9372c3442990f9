"""Bet-table operators: free bets wagered, voids, open exposure, activity."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallybook.functions.money import total
from tallybook.functions.periods import ReportWindow, bucket, in_window, moment, to_local


def is_free() -> Column:
    return F.col("free_bet_id").isNotNull()


def _staked(bets: DataFrame, by: Sequence[str | Column], summed: bool) -> DataFrame:
    """Stakes by keys, or one row per bet for a stack that adds them up itself."""
    if not summed:
        return bets.select(*by, F.col("bet_amount_cents").alias("cents"))
    return bets.groupBy(*by).agg(F.sum("bet_amount_cents").alias("cents"))


def free_bets_wagered(bets: DataFrame, window: ReportWindow | None, *, tz: str, summed: bool = True) -> DataFrame:
    """Stakes of free bets by placement time; None leaves the period open."""
    placed = in_window(bets.where(is_free()), "placed_at", window)
    return _staked(placed, [to_local("placed_at", tz).alias("ts"), "patron_id", F.col("id").alias("bet_id")], summed)


def voided(
    bets: DataFrame, window: ReportWindow | None, *, tz: str, promo: bool | None = False, summed: bool = True
) -> DataFrame:
    """Voided stakes by closing time; ``promo`` picks cash, free or (None) both, flagged."""
    rows = in_window(bets.where(F.col("status") == "voided"), "closed_at", window)
    if promo is not None:
        rows = rows.where(is_free() if promo else ~is_free())
    by = [to_local("closed_at", tz).alias("ts"), "patron_id", F.col("id").alias("bet_id"), is_free().alias("is_promo")]
    return _staked(rows, by, summed)


def voided_by_day(bets: DataFrame, window: ReportWindow | None, *, tz: str) -> DataFrame:
    """Voided cash stakes per gaming day (B12, daily form)."""
    rows = in_window(bets.where((F.col("status") == "voided") & ~is_free()), "closed_at", window)
    return rows.groupBy(bucket(to_local("closed_at", tz), "day").alias("gaming_day")).agg(
        total("bet_amount_cents").alias("cents")
    )


def open_exposure(bets: DataFrame, window: ReportWindow, *, promo: bool | None = False) -> DataFrame:
    """Stakes still open at the end of the period, stamped with its start."""
    rows = bets.where((F.col("status") == "open") & window.ended_utc("placed_at"))
    if promo is not None:
        rows = rows.where(is_free() if promo else ~is_free())
    return rows.groupBy("patron_id", F.col("id").alias("bet_id"), is_free().alias("is_promo")).agg(
        F.sum("bet_amount_cents").alias("cents")
    ).withColumn("ts", moment(window.start))


def bet_activity(
    bets: DataFrame,
    by: Sequence[str | Column],
    *,
    cash_excludes_free: bool,
    prefix: str = "",
    free_default: int | None = None,
) -> DataFrame:
    """Settled bets per key: how many, how many free, cents staked in cash and for free.

    ``cash_excludes_free`` settles what "cash" covers: only paid bets, or every bet.
    ``free_default`` replaces a missing free amount where a report wants 0 instead of NULL.
    """
    stake = F.col("bet_amount_cents")
    cash = F.when(~is_free(), stake) if cash_excludes_free else stake
    free = F.when(is_free(), stake)
    if free_default is not None:
        free = free.otherwise(free_default)
    # one row per bet first: plain counts then replace the two distinct counts
    per_bet = bets.where(F.col("status") == "settled").groupBy(*by, "id").agg(
        F.max(is_free()).alias("_free"), F.sum(cash).alias("_cash"), F.sum(free).alias("_promo")
    )
    return per_bet.groupBy(*per_bet.columns[: len(by)]).agg(
        F.count("id").alias(f"{prefix}bets"),
        F.count(F.when(F.col("_free"), F.col("id"))).alias(f"{prefix}free_bets"),
        F.sum("_cash").alias(f"{prefix}settled_cash"),
        F.sum("_promo").alias(f"{prefix}settled_free"),
    )
