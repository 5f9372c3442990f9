"""Cash and bonus balances, deposits and withdrawals per player."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallybook.functions.money import total
from tallybook.functions.periods import ReportWindow, in_window, moment, to_local
from tallybook.operators.ledger import (
    CANCELLED_WITHDRAWALS,
    CUSTOMER_LIABILITY,
    WITHDRAWALS,
    bonus_release,
    cash_adjustment,
    deposit_flows,
    in_state,
    ledger_flows,
    matched,
    withdrawal_flows,
    Flow,
)

# --- fixed values -----------------------------------------------------------------------------
PLAYTHROUGH_TYPES = ("Bonus Playthrough", "bonus playthrough cancellation")
UNLOCK = "unlock"
# ----------------------------------------------------------------------------------------------


def _credit_less_debit() -> Column:
    return F.col("credit_cents") - F.col("debit_cents")


def cash_balance(
    ledger: DataFrame, users: DataFrame, before: ReportWindow | None, *, state: str | None = None
) -> DataFrame:
    """Net of all customer postings, before the period or of all time, for every user."""
    rows = in_state(ledger, state).where(F.col("a_type") == CUSTOMER_LIABILITY)
    if before is not None:
        rows = rows.where(before.started_utc("t_changed_at"))
    net = rows.groupBy(F.col("a_patron_id").alias("patron_id")).agg(F.sum(_credit_less_debit()).alias("cents"))
    return for_every(users, net)


def opening_and_closing(
    ledger: DataFrame,
    users_at_start: DataFrame,
    users_at_end: DataFrame,
    window: ReportWindow,
    *,
    state: str | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Both balances from a single aggregate over the ledger."""
    rows = in_state(ledger, state).where(F.col("a_type") == CUSTOMER_LIABILITY)
    net = _credit_less_debit()
    both = rows.groupBy(F.col("a_patron_id").alias("patron_id")).agg(
        F.sum(F.when(window.started_utc("t_changed_at"), net)).alias("opening"), F.sum(net).alias("closing")
    )
    return (
        for_every(users_at_start, both.select("patron_id", F.col("opening").alias("cents"))),
        for_every(users_at_end, both.select("patron_id", F.col("closing").alias("cents"))),
    )


def for_every(users: DataFrame, amounts: DataFrame) -> DataFrame:
    """Amounts of all users, 0 where there is none."""
    known = users.select("patron_id")
    return known.join(amounts, "patron_id", "left").select(
        "patron_id", F.coalesce("cents", F.lit(0)).cast("bigint").alias("cents")
    )


def deposits(ledger: DataFrame, window: ReportWindow, *, tz: str, state: str | None = None) -> DataFrame:
    """Deposits, wire deposits and region transfers in, one row per kind, time and player."""
    rows = in_state(in_window(ledger, "t_changed_at", window), state)
    return ledger_flows(rows, deposit_flows(), tz).drop("ref_id")


def withdrawals(ledger: DataFrame, window: ReportWindow, *, tz: str, state: str | None = None) -> DataFrame:
    """Initiated withdrawals, wires and region transfers out."""
    rows = in_state(in_window(ledger, "t_changed_at", window), state)
    matched = _matched_by_player(rows, WITHDRAWALS, tz).withColumn("flow", F.lit("withdrawal"))
    return matched.unionByName(ledger_flows(rows, withdrawal_flows(), tz).drop("ref_id"))


def cancelled_withdrawals(ledger: DataFrame, window: ReportWindow, *, tz: str, state: str | None = None) -> DataFrame:
    """Cancelled and declined withdrawals as matched legs."""
    rows = in_state(in_window(ledger, "t_changed_at", window), state)
    return _matched_by_player(rows, CANCELLED_WITHDRAWALS, tz)


def _matched_by_player(rows: DataFrame, pair, tz: str) -> DataFrame:
    return matched(rows, pair, [to_local("posted_at", tz).alias("ts"), "patron_id"])


def cash_adjustments(ledger: DataFrame, window: ReportWindow, *, tz: str, state: str | None = None) -> DataFrame:
    """Amendments that are not wires, per time and player."""
    rows = in_state(in_window(ledger, "t_changed_at", window), state)
    return ledger_flows(rows, [Flow("adjustment", cash_adjustment())], tz).drop("ref_id", "flow")


def bonus_released(ledger: DataFrame, *, tz: str) -> DataFrame:
    """Bonus money turned into cash or revoked, all time, per time and player."""
    return ledger_flows(ledger, [Flow("released", bonus_release())], tz).drop("ref_id", "flow")


def _bonus_sum(transactions: DataFrame, bound: Column) -> DataFrame:
    counted = transactions.where(bound & ~F.col("transaction_type").isin(*PLAYTHROUGH_TYPES))
    return counted.groupBy(F.col("user_id").alias("patron_id")).agg(F.sum("transaction_amount").alias("cents"))


def _signed_release(released: DataFrame, users: DataFrame, bound: Column) -> DataFrame:
    known = users.select("patron_id").distinct()
    rows = released.where(bound).join(known, "patron_id", "left_semi")
    return rows.groupBy("patron_id").agg((-F.sum("cents")).alias("cents"))


def late_unlocks(programs: DataFrame, unlocks: DataFrame, window: ReportWindow) -> DataFrame:
    """Bonus unlocks posted in the period for programmes that had expired before it."""
    expired = programs.where(window.started_utc("expires_at")).select(
        "user_id", F.col("id").alias("user_award_bonus_cash_id"), "expires_at"
    )
    posted = in_window(unlocks.where(F.col("transaction_type") == UNLOCK), "t_changed_at", window)
    late = posted.join(expired, "user_award_bonus_cash_id").where(F.col("t_changed_at") >= F.col("expires_at"))
    return late.groupBy("user_id", "user_award_bonus_cash_id", "t_changed_at").agg(
        total("amount_cents").alias("cents")
    )


def opening_bonus(
    users_at_start: DataFrame,
    transactions: DataFrame,
    released: DataFrame,
    programs: DataFrame,
    unlocks: DataFrame,
    window: ReportWindow,
) -> DataFrame:
    """Bonus balance at the start: transactions less releases plus late unlocks.

    One row per player and part; a report sums them.
    """
    users = users_at_start.select("patron_id").distinct()
    booked = _bonus_sum(transactions, window.started_utc("transaction_timestamp_utc"))
    gone = _signed_release(released, users, F.col("ts") < moment(window.start))
    late = late_unlocks(programs, unlocks, window).withColumnRenamed("user_id", "patron_id")
    late = late.join(users, "patron_id", "left_semi").groupBy("patron_id").agg(F.sum("cents").alias("cents"))
    return for_every(users, booked).unionByName(gone).unionByName(late)


def closing_bonus(
    users_at_end: DataFrame, transactions: DataFrame, released: DataFrame, window: ReportWindow
) -> DataFrame:
    """Bonus balance at the end, one row per player and part."""
    users = users_at_end.select("patron_id").distinct()
    booked = _bonus_sum(transactions, window.ended_utc("transaction_timestamp_utc"))
    gone = _signed_release(released, users, F.col("ts") < moment(window.end))
    return for_every(users, booked).unionByName(gone)


def bonus_adjustments(
    users_at_start: DataFrame,
    users_at_end: DataFrame,
    transactions: DataFrame,
    released: DataFrame,
    closing: DataFrame,
    window: ReportWindow,
) -> DataFrame:
    """Bonus movements of known users; a user new in the period brings the whole end balance."""
    known = users_at_start.select("patron_id").distinct()
    moved = _bonus_sum(transactions, window.holds_utc("transaction_timestamp_utc")).join(known, "patron_id", "left_semi")
    gone = _signed_release(released, known, window.holds_local("ts"))
    new = users_at_end.where(window.holds_utc("inserted_at")).select("patron_id").distinct()
    brought = closing.join(new, "patron_id", "left_semi").groupBy("patron_id").agg(F.sum("cents").alias("cents"))
    return moved.unionByName(gone).unionByName(brought)


def last_activity(ledger: DataFrame, window: ReportWindow, *, state: str | None = None) -> DataFrame:
    """Time of each player's last posting before the end of the period."""
    rows = in_state(ledger, state).where(window.ended_utc("t_changed_at"))
    return rows.groupBy(F.col("p_patron_id").alias("patron_id")).agg(
        F.max("t_changed_at").alias("last_active_at")
    )
