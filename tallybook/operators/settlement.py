"""Resettlement and settlement accounting."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallybook.functions.periods import ReportWindow, in_window, to_local
from tallybook.operators.ledger import (
    CUSTOMER_LIABILITY,
    SPORTS_HOUSE_WINS,
    UNSETTLED_BETS,
    bet_id,
    in_state,
)

# --- fixed values -----------------------------------------------------------------------------
RESETTLEMENT_TYPES = ("sportsbook_bet_resettlement", "sportsbook_bet_ungrade", "sportsbook_bet_void")
HOUSE = (UNSETTLED_BETS, SPORTS_HOUSE_WINS)
WINS = (SPORTS_HOUSE_WINS,)
CUSTOMER = (CUSTOMER_LIABILITY,)


@dataclass(frozen=True)
class Rule:
    """One line of the decision table; None means any. The first line that fits decides.

    amount is what the line books: nothing, credits, debits, or debits minus credits ("net"),
    with a minus sign where it books the opposite.
    """

    amount: str
    state: Sequence[str] | None = None
    not_state: Sequence[str] | None = None
    previous: Sequence[str] | None = None
    not_previous: Sequence[str] | None = None
    promo: bool | None = None
    accounts: Sequence[str] | None = None
    same_day: bool | None = None


RULES = (
    # voids
    Rule("nothing", state=("voided",), previous=("open",)),
    Rule("nothing", state=("voided",), previous=("loss",)),
    Rule("credits", state=("voided",), previous=("win",), promo=False, accounts=HOUSE),
    Rule("credits", state=("voided",), previous=("push",), promo=False, accounts=HOUSE),
    # refunds
    Rule("nothing", state=("refund",), previous=("open",)),
    Rule("-credits", state=("refund",), previous=("loss",), promo=False, accounts=CUSTOMER),
    Rule("credits", state=("refund",), previous=("win",), promo=False, accounts=WINS),
    Rule("credits", state=("refund",), previous=("push",), promo=False, accounts=WINS),
    # out of a refund on the day of the refund
    Rule("debits", state=("loss",), previous=("refund",), promo=False, accounts=CUSTOMER, same_day=True),
    Rule("-net", state=("win",), previous=("refund",), promo=False, accounts=HOUSE, same_day=True),
    Rule("-debits", state=("push",), previous=("refund",), promo=False, accounts=HOUSE, same_day=True),
    # out of a refund on another day
    Rule("net", not_state=("refund", "voided"), previous=("refund",), accounts=CUSTOMER, same_day=False),
    # back to open
    Rule("nothing", state=("open",), previous=("voided",)),
    Rule("debits", state=("open",), previous=("refund",), promo=False, accounts=CUSTOMER),
    # cash moves already booked through the house accounts
    Rule("nothing", state=("voided",), previous=("win",), promo=False),
    Rule("nothing", state=("voided",), previous=("push",), promo=False),
    Rule("nothing", state=("refund",), previous=("win",), promo=False),
    Rule("nothing", state=("refund",), previous=("push",), promo=False),
    Rule("nothing", state=("win",), previous=("refund",), promo=False),
    Rule("nothing", state=("push",), previous=("refund",), promo=False),
    # free bets
    Rule("net", state=("refund", "voided"), promo=True, accounts=CUSTOMER),
    Rule("net", state=("win", "loss"), not_previous=("open",), promo=True, accounts=CUSTOMER),
    Rule("net", state=("win",), previous=("open",), promo=True, accounts=CUSTOMER),
    Rule("net", state=("open",), previous=("win",), promo=True, accounts=CUSTOMER),
    # any other cash bet
    Rule("net", not_state=("refund", "voided"), promo=False, accounts=CUSTOMER),
)
# ----------------------------------------------------------------------------------------------


def promo_id() -> Column:
    return F.coalesce(F.col("promo_engine_free_bet_id"), F.col("free_bet_id"))


def _fits(rule: Rule) -> str:
    """The rule's tests as a SQL condition."""
    tests: list[str] = []
    for column, wanted, negated in (
        ("state", rule.state, ""),
        ("state", rule.not_state, "NOT "),
        ("previous_state", rule.previous, ""),
        ("previous_state", rule.not_previous, "NOT "),
        ("account", rule.accounts, ""),
    ):
        if wanted:
            listed = ", ".join(f"'{w}'" for w in wanted)
            tests.append(f"{column} {negated}IN ({listed})")
    if rule.promo is not None:
        tests.append(f"promo_id IS {'NOT ' if rule.promo else ''}NULL")
    if rule.same_day is not None:
        sign = "=" if rule.same_day else "<>"
        tests.append(f"CAST(new_timestamp AS DATE) {sign} CAST(new_previous_timestamp AS DATE)")
    return " AND ".join(tests)


def resettlement_amount(rules: Sequence[Rule] = RULES) -> Column:
    """Cents booked for a group holding ``debits`` and ``credits`` sums; 0 where nothing fits."""
    amounts = {"nothing": "0", "credits": "credits", "debits": "debits", "net": "(debits - credits)"}
    branches = []
    for rule in rules:
        sign = "-" if rule.amount.startswith("-") else ""
        branches.append(f"WHEN {_fits(rule)} THEN {sign}{amounts[rule.amount.lstrip('-')]}")
    return F.expr(f"CAST(coalesce(CASE {' '.join(branches)} END, 0) AS BIGINT)")


def resettlement(
    ledger: DataFrame,
    states: DataFrame,
    window: ReportWindow | None,
    *,
    tz: str,
    state: str | None = None,
) -> DataFrame:
    """Resettled, ungraded and voided bets with the amount the decision table books."""
    postings = in_state(in_window(ledger, "t_changed_at", window), state).where(
        F.col("p_type").isin(*RESETTLEMENT_TYPES)
    )
    postings = postings.select(
        "bet_history_id",
        to_local("t_changed_at", tz).alias("ts"),
        F.col("a_patron_id").alias("patron_id"),
        bet_id().alias("bet_id"),
        F.col("a_type").alias("account"),
        "debit_cents",
        "credit_cents",
    )
    bet_states = states.select(
        "bet_history_id",
        promo_id().alias("promo_id"),
        "state",
        "previous_state",
        "new_timestamp",
        "new_previous_timestamp",
    )
    groups = postings.join(bet_states, "bet_history_id").groupBy(
        "ts",
        "patron_id",
        "bet_id",
        "promo_id",
        "state",
        "previous_state",
        "account",
        "new_timestamp",
        "new_previous_timestamp",
    )
    sums = groups.agg(F.sum("debit_cents").alias("debits"), F.sum("credit_cents").alias("credits"))
    return sums.withColumn("cents", resettlement_amount())


def resettlement_rollup(df: DataFrame, promo: bool | None = None) -> DataFrame:
    """Resettlements per (ts, patron, bet): cash bets, free bets or both."""
    if promo is not None:
        df = df.where(F.col("promo_id").isNotNull() if promo else F.col("promo_id").isNull())
    return df.groupBy("ts", "patron_id", "bet_id").agg(F.sum("cents").alias("cents"))


def first_settlement(
    ledger: DataFrame,
    states: DataFrame,
    window: ReportWindow | None,
    *,
    tz: str,
    state: str | None = None,
    later_states: DataFrame | None = None,
    summed: bool = True,
) -> DataFrame:
    """Credits of bets settled straight out of the open state.

    The first settlement books cash refunds and free-bet wins, a later one only cash refunds;
    anything else of a first settlement is carried as 0. ``later_states`` is given where the
    later settlements are read from another snapshot of the states. With ``summed`` off every posting
    is a row, for a stack that adds them up itself.
    """
    postings = in_state(in_window(ledger, "t_changed_at", window), state).where(
        (F.col("p_type") == "sportsbook_bet_resettlement") & (F.col("a_type") == CUSTOMER_LIABILITY)
    )
    postings = postings.select(
        "bet_history_id",
        to_local("t_changed_at", tz).alias("ts"),
        F.col("a_patron_id").alias("patron_id"),
        bet_id().alias("bet_id"),
        (F.col("credit_cents") - F.col("debit_cents")).alias("net"),
    )
    first = (F.col("previous_ordinal") == 1) & F.col("state").isin("refund", "win")
    later = (F.col("previous_ordinal") > 1) & (F.col("state") == "refund") & F.col("promo_id").isNull()

    def settled(source: DataFrame, kept: Column) -> DataFrame:
        opened = source.where(F.col("previous_state") == "open").select(
            "bet_history_id", promo_id().alias("promo_id"), "state", "previous_ordinal"
        )
        return opened.where(kept)

    if later_states is None:
        chosen = settled(states, first | later)
    else:
        chosen = settled(states, first).unionByName(settled(later_states, later))
    rows = postings.join(chosen, "bet_history_id").withColumn("is_first", F.col("previous_ordinal") == 1)
    books = ((F.col("state") == "refund") & F.col("promo_id").isNull()) | (
        (F.col("state") == "win") & F.col("promo_id").isNotNull()
    )
    sums = rows
    if summed:
        groups = rows.groupBy("is_first", "ts", "patron_id", "bet_id", "promo_id", "state")
        sums = groups.agg(F.sum("net").alias("net"))
    booked = F.when(books, F.coalesce("net", F.lit(0))).otherwise(0).cast("bigint")
    return sums.select("ts", "patron_id", "bet_id", "promo_id", "state", "is_first", booked.alias("cents"))


def union_transfers(*parts: DataFrame) -> DataFrame:
    """Transfers of several origins on (ts, patron, bet): B17 and B18."""
    shaped = [p.select("ts", "patron_id", "bet_id", "cents") for p in parts]
    return reduce(DataFrame.unionByName, shaped)
