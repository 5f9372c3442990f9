"""Free bets and free rounds from award to settlement."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallybook.functions.labels import GAME_SEGMENTS, capitalised
from tallybook.functions.money import EXACT, dollars, exact_dollars
from tallybook.functions.periods import ReportWindow, bucket, in_window, moment, to_local
from tallybook.operators.snapshots import latest_attrs

# --- fixed values -----------------------------------------------------------------------------
SPORTS = "Sports"
CASINO = "Casino"
MANUAL_AWARD = "Manual Award"
# ----------------------------------------------------------------------------------------------


def settled_free_bets(bets: DataFrame) -> DataFrame:
    """Settled free bets other than pushes."""
    kept = bets.where(
        F.col("free_bet_id").isNotNull() & (F.col("status") == "settled") & (F.col("outcome") != "push")
    )
    return kept.select(
        "patron_id",
        F.col("id").alias("wager_id"),
        F.col("free_bet_id").alias("promo_free_wager_id"),
        "outcome",
        F.lit(False).alias("is_jackpot"),
        dollars("bet_amount_cents").alias("wager_amount"),
        exact_dollars("payout_amount_cents").alias("payout_amount"),
        F.lit(0).cast(EXACT).alias("jackpot_payout_amount"),
        "placed_at",
        "closed_at",
        "regraded",
        "gaming_state",
        F.lit(SPORTS).alias("product"),
        F.lit(SPORTS).alias("game_category"),
    ).distinct()


def free_round_lifecycle(
    wager_info: DataFrame,
    patron_transactions: DataFrame,
    wagers: DataFrame,
    payouts: DataFrame,
    rollbacks: DataFrame,
    jackpots: DataFrame,
    window: ReportWindow,
) -> DataFrame:
    """Free rounds of the period with the payout or rollback that ended them.

    The jackpot part is taken out of the payout; a round closes at the latest of its times.
    """
    clocks = in_window(patron_transactions, "_changed_at", window).select(
        F.col("id").alias("patron_transaction_id")
    )
    opened = wager_info.where(
        (F.col("type") == "wager") & F.col("promo_engine_free_round_award_id").isNotNull()
    ).join(clocks, "patron_transaction_id")
    opened = opened.select(
        "patron_id", "patron_transaction_id", "promo_engine_free_round_award_id", "amount_cents", "game_category"
    )
    ended = wager_info.where(F.col("type").isin("payout", "rollback")).select(
        F.col("parent_id").alias("_parent"),
        F.col("patron_transaction_id").alias("_end_tx"),
        F.col("type").alias("_end"),
        F.col("amount_cents").alias("_end_cents"),
    )
    won = jackpots.select(F.col("remote_wallet_transaction_id").alias("_jackpot_tx"), "amount_precision")
    rounds = opened.join(ended, F.col("patron_transaction_id") == F.col("_parent")).join(
        won, F.col("_end_tx") == F.col("_jackpot_tx"), "left"
    )
    paid, undone = F.col("_end") == "payout", F.col("_end") == "rollback"
    rounds = rounds.select(
        "patron_id",
        "patron_transaction_id",
        "promo_engine_free_round_award_id",
        "amount_cents",
        "game_category",
        "_end_tx",
        "_end",
        "_end_cents",
        F.coalesce("amount_precision", F.lit(0)).cast(EXACT).alias("jackpot"),
        F.col("amount_precision").isNotNull().alias("is_jackpot"),
        undone.alias("regraded"),
        F.when(paid & (F.col("_end_cents") > 0), "win")
        .when(paid & (F.col("_end_cents") == 0), "loss")
        .when(undone, "rollback")
        .alias("outcome"),
    )

    def ends(frame: DataFrame, kind: str) -> DataFrame:
        return frame.select(
            F.col("patron_transaction_id").alias("_end_tx"),
            F.lit(kind).alias("_end"),
            F.col("_changed_at").alias("_ended_at"),
        )

    placed = wagers.select(
        "patron_transaction_id", "gaming_state", F.col("_changed_at").alias("placed_at")
    )
    # one join finds either end; joining each table on its own would pile up missing keys
    ended_at = ends(payouts, "payout").unionByName(ends(rollbacks, "rollback"))
    timed = rounds.join(placed, "patron_transaction_id").join(ended_at, ["_end_tx", "_end"], "left")
    return timed.select(
        "patron_id",
        F.col("patron_transaction_id").alias("wager_id"),
        F.col("promo_engine_free_round_award_id").alias("promo_free_wager_id"),
        "outcome",
        "is_jackpot",
        dollars("amount_cents").alias("wager_amount"),
        (exact_dollars(F.coalesce("_end_cents", F.lit(0))) - F.col("jackpot")).cast(EXACT).alias("payout_amount"),
        F.col("jackpot").alias("jackpot_payout_amount"),
        "placed_at",
        F.greatest("placed_at", "_ended_at").alias("closed_at"),
        "regraded",
        "gaming_state",
        F.lit(CASINO).alias("product"),
        "game_category",
    ).distinct()


def free_wager_awards(
    user_free_bets: DataFrame,
    free_bets: DataFrame,
    user_free_wagers: DataFrame,
    free_wagers: DataFrame,
    *,
    tz: str,
) -> DataFrame:
    """Latest award behind every free bet and free wager."""

    def latest(kind: str, given: DataFrame, programmes: DataFrame, link: str) -> DataFrame:
        terms = programmes.select(F.col("id").alias("award_program_id"), "amount_cents")
        rows = given.select(
            F.col("id").alias("free_wager_id"),
            F.col("user_id").alias("customer_id"),
            F.col(link).alias("award_program_id"),
            to_local("awarded_at", tz).alias("awarded_date"),
            "updated_at",
        ).join(terms, "award_program_id")
        rows = rows.withColumn("coupon_amount", dollars("amount_cents"))
        attrs = ["customer_id", "award_program_id", "awarded_date", "coupon_amount"]
        return latest_attrs(rows, "free_wager_id", "updated_at", attrs).withColumn("type", F.lit(kind))

    return latest("free bet", user_free_bets, free_bets, "award_free_bet_id").unionByName(
        latest("free wager", user_free_wagers, free_wagers, "award_free_wager_id")
    )


def award_programmes(promotions: DataFrame, free_bets: DataFrame, free_wagers: DataFrame) -> DataFrame:
    """Latest promotion behind every award programme."""
    offered = promotions.select(
        F.col("id").alias("program_code"),
        F.col("name").alias("program_name"),
        F.col("promotion_type").alias("award_type"),
        "updated_at",
    )

    def latest(kind: str, programmes: DataFrame) -> DataFrame:
        links = programmes.select(F.col("id").alias("award_program_id"), F.col("promotion_id").alias("program_code"))
        rows = offered.join(links, "program_code")
        attrs = ["program_code", "program_name", "award_type"]
        return latest_attrs(rows, "award_program_id", "updated_at", attrs).withColumn("type", F.lit(kind))

    return latest("free bet award", free_bets).unionByName(latest("free wager award", free_wagers))


def used_free_wagers(
    settled: DataFrame,
    users: DataFrame,
    awards: DataFrame,
    programmes: DataFrame,
    window: ReportWindow,
    *,
    run_at: datetime,
) -> DataFrame:
    """Free bets and rounds settled in the period, both ends included, with award names."""
    tz = window.tz
    kept = settled.where(window.holds_local(to_local("closed_at", tz), closed=True))
    kept = kept.join(users.select("patron_id"), "patron_id")
    awarded = awards.select(F.col("free_wager_id").alias("promo_free_wager_id"), "award_program_id")
    named = programmes.select("award_program_id", "program_name")
    rows = kept.join(awarded, "promo_free_wager_id", "left").join(named, "award_program_id", "left")
    category = F.col("game_category")
    segment = F.when(category == SPORTS, category)
    for key, label in GAME_SEGMENTS.items():
        segment = segment.when(category == key, label)
    return rows.select(
        bucket(to_local("closed_at", tz), "second").alias("Settled Timestamp Toronto"),
        F.col("patron_id").alias("Patron ID"),
        F.col("product").alias("Product"),
        segment.otherwise(capitalised(category)).alias("Game Type"),
        F.col("award_program_id").alias("Award Program ID"),
        F.coalesce("program_name", F.lit(MANUAL_AWARD)).alias("Program Name"),
        F.col("wager_id").alias("Wager ID"),
        F.col("promo_free_wager_id").alias("Promo Free Wager ID"),
        bucket(to_local("placed_at", tz), "second").alias("Placed At Timestamp Toronto"),
        F.col("outcome").alias("Outcome"),
        F.col("wager_amount").alias("Wager Amount"),
        F.col("payout_amount").alias("Payout Amount"),
        F.col("jackpot_payout_amount").alias("Jackpot Win Amount"),
        F.col("gaming_state").alias("Gaming State"),
        F.col("regraded").cast("boolean").alias("Regrade"),
        F.col("is_jackpot").alias("Jackpot Win"),
        to_local(moment(run_at), tz).alias("report_run_timestamp_toronto"),
    ).distinct()
