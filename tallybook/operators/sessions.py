"""Session summaries and wager counts."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallybook.functions.periods import ReportWindow, moment, seconds_between

# --- fixed values -----------------------------------------------------------------------------
BETTING = "betting"
CATEGORY_BUCKETS = {
    "slots": ("slots",),
    "tables": ("table", "roulette"),
    "livedealer": ("live",),
    "betting": ("betting",),
}
# ----------------------------------------------------------------------------------------------


def game_transactions(
    wager_info: DataFrame, patron_transactions: DataFrame, window: ReportWindow
) -> DataFrame:
    """Casino transactions other than rollbacks, from a day before the period to its end."""
    rows = wager_info.where(F.col("type") != "rollback")
    clocks = patron_transactions.where(window.holds_utc("_changed_at", days_back=1))
    return rows.join(clocks.select(F.col("id").alias("patron_transaction_id")), "patron_transaction_id")


def session_summary(
    tx: DataFrame,
    entity: str,
    session: str,
    window: ReportWindow,
    *,
    ts: str = "transaction_timestamp_utc",
) -> DataFrame:
    """Sessions and minutes played per entity.

    A session runs from its first to its last transaction. It counts when it lies inside the
    period, or began before and went on into it; only the part after the start is timed. The
    minutes of an entity are summed, at least 1, and rounded half up.
    """
    bounds = tx.groupBy(entity, session).agg(F.min(ts).alias("opened"), F.max(ts).alias("closed"))
    start, end = moment(window.start_utc), moment(window.end_utc)
    inside = (F.col("opened") >= start) & (F.col("closed") < end)
    straddles = (F.col("opened") < start) & (F.col("closed") > start)
    kept = bounds.where(inside | straddles)
    seconds = seconds_between(F.greatest("opened", start), F.col("closed"))
    minutes = (F.sum(seconds) / F.lit(60).cast("decimal(2,0)")).cast("decimal(38,6)")
    return kept.groupBy(entity).agg(
        # a session is one row per entity here, so counting rows counts distinct sessions
        F.count(session).alias("num_game_sessions"),
        F.round(F.greatest(minutes, F.lit(1).cast("decimal(38,6)"))).cast("bigint").alias("total_gameplay_duration"),
    )


def wager_counts(sources: Sequence[tuple[DataFrame, str, str | Column, int]]) -> DataFrame:
    """Signed count and amount of wagers per (ts, patron, category) and source.

    Each source is (frame, id column, category, sign). All of them go through one shuffle: the
    ids are made unique first, then counted.
    """
    shaped = []
    for index, (frame, ref, category, sign) in enumerate(sources):
        kind = F.col(category) if isinstance(category, str) else category
        shaped.append(
            frame.select(
                F.lit(index).alias("_source"),
                "ts",
                "patron_id",
                kind.alias("category"),
                F.col(ref).alias("_ref"),
                F.lit(sign).alias("_sign"),
                F.col("cents"),
            )
        )
    rows = reduce(DataFrame.unionByName, shaped)
    unique = rows.groupBy("_source", "ts", "patron_id", "category", "_ref", "_sign").agg(F.sum("cents").alias("cents"))
    return unique.groupBy("_source", "ts", "patron_id", "category").agg(
        F.sum(F.when(F.col("_ref").isNotNull(), F.col("_sign")).otherwise(0)).cast("bigint").alias("num_wagers"),
        F.sum(F.col("_sign") * F.col("cents")).alias("cents"),
    ).drop("_source")


def signed_wagers(ref: str, sign: int, category: Column | None = None) -> dict[str, Column]:
    """Count and bucketed amount of a source whose ids are already unique, for a measure stack.

    Counting the rows then equals counting distinct ids, so the source needs no pass of its own.
    Without a category the source is betting.
    """
    counted = F.when(F.col(ref).isNotNull(), F.lit(sign))
    amount = F.lit(sign) * F.col("cents")
    if category is None:
        return {"num_wagers": counted, "wagers_betting": amount}
    return {"num_wagers": counted, **bucketed(category, amount)}


def bucketed(category: Column | None = None, amount: Column | None = None) -> dict[str, Column]:
    """Amounts split over the five category buckets; a missing category lands in none."""
    category = F.col("category") if category is None else category
    amount = F.col("cents") if amount is None else amount
    named = [c for group in CATEGORY_BUCKETS.values() for c in group]
    split = {f"wagers_{k}": F.when(category.isin(*v), amount) for k, v in CATEGORY_BUCKETS.items()}
    split["wagers_other"] = F.when(~category.isin(*named), amount)
    return split
