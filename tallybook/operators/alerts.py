"""Anti-money-laundering detections (B29 per transaction, B47, B48, B50, B51)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallybook.functions.periods import ReportWindow, bucket, in_window, to_local
from tallybook.operators.ledger import (
    AML_WIRE_REASONS,
    WIRE_DEPOSIT,
    WIRE_WITHDRAWAL,
    WITHDRAWALS,
    matched,
    on_customer,
    wire,
)

# --- fixed values: thresholds in cents --------------------------------------------------------
SINGLE_DEPOSIT = 50_000_00
AGGREGATE_DEPOSIT = 75_000_00
LIFETIME_FLOOR = 50_000_00
MONTHLY_DEPOSIT = 25_000_00
SIX_MONTH_DEPOSIT = 50_000_00
TWELVE_MONTH_DEPOSIT = 100_000_00
# ----------------------------------------------------------------------------------------------


def is_deposit() -> Column:
    """Customer-side postings that count as deposits for monitoring."""
    return on_customer("deposit") | wire(WIRE_DEPOSIT, AML_WIRE_REASONS)


def deposit_postings(ledger: DataFrame) -> DataFrame:
    return ledger.where(is_deposit())


def per_transaction(postings: DataFrame, by: Sequence[str | Column]) -> DataFrame:
    """Net cents per key and patron transaction, so that later counts need no distinct."""
    net = F.sum(F.col("credit_cents") - F.col("debit_cents"))
    return postings.groupBy(*by, "patron_transaction_id").agg(net.alias("cents"))


def deposit_transactions(ledger: DataFrame, users: DataFrame, *, tz: str) -> DataFrame:
    """Deposits per transaction with their local month and the player's name."""
    names = users.select(F.col("patron_id").alias("a_patron_id"), "username")
    local = to_local("t_changed_at", tz)
    rows = deposit_postings(ledger).join(names, "a_patron_id")
    return per_transaction(
        rows,
        [
            bucket(local, "month").alias("transaction_period"),
            local.alias("ts"),
            "username",
            F.col("a_patron_id").alias("patron_id"),
        ],
    ).withColumnRenamed("patron_transaction_id", "transaction_id")


def threshold_alerts(
    deposits: DataFrame,
    by: Sequence[str],
    *,
    single: int = SINGLE_DEPOSIT,
    aggregate: int = AGGREGATE_DEPOSIT,
) -> DataFrame:
    """One large deposit in the month, or several smaller ones that add up.

    Both kinds come from one pass: a deposit is large or small, and each side is judged on its
    own count of transactions and total.
    """
    sized = deposits.withColumn("_large", F.col("cents") >= single)
    once = sized.groupBy(*by, "_large", "transaction_id").agg(F.sum("cents").alias("cents"))
    judged = once.groupBy(*by, "_large").agg(
        F.sum("cents").alias("deposit_cents"), F.count("transaction_id").alias("deposits")
    )
    lone = F.col("_large") & (F.col("deposits") == 1)
    many = ~F.col("_large") & (F.col("deposits") > 1) & (F.col("deposit_cents") >= aggregate)
    kind = F.when(F.col("_large"), "Single").otherwise("Aggregate")
    return judged.where(lone | many).select(kind.alias("transaction_type"), *by, "deposit_cents", "deposits")


def monthly_depositors(
    ledger: DataFrame,
    users: DataFrame,
    window: ReportWindow,
    attrs: Sequence[str],
    *,
    floor: int = MONTHLY_DEPOSIT,
) -> DataFrame:
    """Players, testers aside, whose deposits of a month reach the floor (B48 driver)."""
    known = users.where(F.col("is_tester") == F.lit(False)).select(F.col("patron_id").alias("a_patron_id"), *attrs)
    rows = deposit_postings(in_window(ledger, "t_changed_at", window)).join(known, "a_patron_id")
    keys = [
        bucket(to_local("t_changed_at", window.tz), "month").alias("transaction_period"),
        F.col("a_patron_id").alias("patron_id"),
        *attrs,
        "gaming_state",
    ]
    return _deposit_totals(rows, keys, "").where(F.col("deposit_cents") >= floor)


def _deposit_totals(rows: DataFrame, keys: Sequence[str | Column], prefix: str) -> DataFrame:
    once = per_transaction(rows, keys)
    names = once.columns[: len(keys)]
    return once.groupBy(*names).agg(
        F.sum("cents").alias(f"{prefix}deposit_cents"),
        F.count("patron_transaction_id").alias(f"{prefix}deposits"),
    )


def rolling_alerts(
    ledger: DataFrame,
    players: DataFrame,
    window: ReportWindow,
    *,
    six: int = SIX_MONTH_DEPOSIT,
    twelve: int = TWELVE_MONTH_DEPOSIT,
) -> DataFrame:
    """Players over the six- or the twelve-month look-back threshold.

    Both look-backs come from the twelve-month scan: the shorter one is a conditional sum over
    it. A side below its threshold is reported as unknown.
    """
    rows = deposit_postings(in_window(ledger, "t_changed_at", window, months_back=12))
    rows = rows.withColumnRenamed("a_patron_id", "patron_id").join(players, "patron_id", "left_semi")
    recent = window.holds_utc("t_changed_at", months_back=6)
    net = F.col("credit_cents") - F.col("debit_cents")
    once = rows.groupBy("patron_id", "patron_transaction_id").agg(
        F.sum(net).alias("_all"), F.sum(F.when(recent, net)).alias("_six"), F.max(recent).alias("_recent")
    )
    sums = once.groupBy("patron_id").agg(
        F.sum("_six").alias("_six"),
        F.count(F.when(F.col("_recent"), F.col("patron_transaction_id"))).alias("_six_n"),
        F.sum("_all").alias("_all"),
        F.count("patron_transaction_id").alias("_all_n"),
    )
    over_six, over_twelve = F.col("_six") >= six, F.col("_all") >= twelve
    return sums.where(over_six | over_twelve).select(
        "patron_id",
        F.when(over_six, F.col("_six")).alias("r6_deposit_cents"),
        F.when(over_six, F.col("_six_n")).alias("r6_deposits"),
        F.when(over_twelve, F.col("_all")).alias("r12_deposit_cents"),
        F.when(over_twelve, F.col("_all_n")).alias("r12_deposits"),
    )


def driver_counts(driver: DataFrame) -> DataFrame:
    """How many rows the driver holds per player, as (patron_id, times).

    Joining a frame to the driver row by row repeats every row ``times`` times. Joining it to
    these counts and weighting the sums gives the same totals without the repeated rows.
    """
    return driver.groupBy("patron_id").agg(F.count(F.lit(1)).alias("times"))


def driven(rows: DataFrame, players: DataFrame | None) -> DataFrame:
    """Cut rows to the driver's players and add ``times``; without a driver it is 1."""
    if players is None:
        return rows.withColumn("times", F.lit(1).cast("bigint"))
    return rows.join(players.select("patron_id", "times"), "patron_id")


def lifetime_deposits(
    ledger: DataFrame, players: DataFrame | None = None, *, floor: int = LIFETIME_FLOOR
) -> DataFrame:
    """All-time deposits per player from a floor up, first rank kept.

    With a driver, sums count once per driver row. A player has one row here, so the rank is
    always 1; it is kept because the reports name it.
    """
    rows = driven(deposit_postings(ledger).withColumnRenamed("a_patron_id", "patron_id"), players)
    rows = rows.withColumns(
        {c: F.col(c) * F.col("times") for c in ("credit_cents", "debit_cents")}
    )
    sums = _deposit_totals(rows, ["patron_id"], "lt_").where(F.col("lt_deposit_cents") >= floor)
    best = Window.partitionBy("patron_id").orderBy(F.col("lt_deposit_cents").desc())
    return sums.withColumn("ranks", F.rank().over(best)).where(F.col("ranks") == 1)


def withdrawal_refs(
    ledger: DataFrame,
    *,
    tz: str,
    players: DataFrame | None = None,
    cut_credits: bool = False,
    wire_ledger: DataFrame | None = None,
    credit_ledger: DataFrame | None = None,
    within: ReportWindow | None = None,
) -> DataFrame:
    """Cents per withdrawal and local month: matched legs and wires.

    The driver (patron_id, times) cuts the debit legs; the house's credit legs, which may name no player, only
    with ``cut_credits``. ``wire_ledger`` is given where wires are read over a wider period than matched
    withdrawals, ``credit_ledger`` where the credit legs are in a frame of their own. Returns
    (transaction_period, inside, patron_id, ref_id, is_wire, times, cents); ``inside`` says whether the posting
    lies in the window ``within``, true without one.
    """

    def cut(rows: DataFrame) -> DataFrame:
        return rows if players is None else rows.join(players.select(F.col("patron_id").alias("a_patron_id")), "a_patron_id", "left_semi")

    def keys(ts: str) -> list[Column]:
        inside = F.lit(True) if within is None else within.holds_utc(ts)
        return [bucket(to_local(ts, tz), "month").alias("transaction_period"), inside.alias("inside"), F.col("patron_id")]

    if credit_ledger is None and (players is None or cut_credits):
        house = None
    else:
        house = credit_ledger if credit_ledger is not None else ledger
        house = cut(house) if cut_credits else house
    taken = matched(cut(ledger), WITHDRAWALS, [*keys("posted_at"), F.col("ref_id")], credits=house)
    wires = cut(wire_ledger if wire_ledger is not None else ledger).where(wire(WIRE_WITHDRAWAL, AML_WIRE_REASONS))
    wires = wires.withColumnRenamed("a_patron_id", "patron_id")
    wired = wires.groupBy(*keys("t_changed_at"), F.col("patron_transaction_id").alias("ref_id")).agg(
        F.sum(F.col("debit_cents") - F.col("credit_cents")).alias("cents")
    )
    both = taken.withColumn("is_wire", F.lit(False)).unionByName(wired.withColumn("is_wire", F.lit(True)))
    return driven(both, players)


def withdrawal_totals(
    refs: DataFrame, *, by_month: bool, weigh_matched: bool = False, prefix: str = "", collapse: bool = False
) -> DataFrame:
    """Withdrawals per player, by month of the window or of all that was read.

    A player with both kinds has two rows, which doubles what is joined to them later; ``collapse`` adds them
    up instead. Wires count once per driver row, matched withdrawals only if ``weigh_matched``.
    """
    weight = F.col("times") if weigh_matched else F.when(F.col("is_wire"), F.col("times")).otherwise(1)
    rows = (refs.where("inside") if by_month else refs).withColumn("cents", F.col("cents") * weight)
    by = [*(["transaction_period"] if by_month else []), "patron_id", *([] if collapse else ["is_wire"])]
    if collapse or not by_month:
        rows = rows.groupBy(*by, "ref_id").agg(F.sum("cents").alias("cents"))
    return rows.groupBy(*by).agg(
        F.count("ref_id").alias(f"{prefix}withdrawals"), F.sum("cents").alias(f"{prefix}withdrawal_cents")
    ).drop("is_wire")


def withdrawal_activity(
    ledger: DataFrame,
    *,
    tz: str,
    by_month: bool,
    players: DataFrame | None = None,
    weigh_matched: bool = False,
    cut_credits: bool = False,
    prefix: str = "",
    wire_ledger: DataFrame | None = None,
    collapse: bool = False,
) -> DataFrame:
    """One of the totals of ``withdrawal_totals`` straight from the ledger."""
    refs = withdrawal_refs(ledger, tz=tz, players=players, cut_credits=cut_credits, wire_ledger=wire_ledger)
    return withdrawal_totals(refs, by_month=by_month, weigh_matched=weigh_matched, prefix=prefix, collapse=collapse)
