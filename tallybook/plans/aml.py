"""Anti-money-laundering reports: high-value deposits (R10), non-earning occupation."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallybook.functions.labels import is_non_earning
from tallybook.functions.money import dollars
from tallybook.functions.periods import ReportWindow, bucket, in_window, to_local
from tallybook.lineage import compute_once
from tallybook.operators import alerts, revenue
from tallybook.operators import bets as bet_ops
from tallybook.operators.cuts import player_postings, reached_postings
from tallybook.operators.ledger import (
    AML_WIRE_REASONS,
    SPORTS_AND_CASINO_BETS,
    SPORTS_PAYOUT_TYPES,
    WIRE_WITHDRAWAL,
    WITHDRAWALS,
    free_bet_ids,
    free_bet_ids_posted,
    on_customer,
    wire,
)
from tallybook.operators.markets import bet_and_market_info
from tallybook.operators.profiles import enrich, payment_profile, ratio
from tallybook.operators.settlement import (
    RESETTLEMENT_TYPES,
    first_settlement,
    resettlement,
    union_transfers,
)
from tallybook.plans.finance import cash_bets, sports_payouts
from tallybook.sources.catalog import Catalog

PAYOUT_TYPES = (*SPORTS_PAYOUT_TYPES, "casino_payout")
PERIOD = "transaction_period"


def _monitored() -> dict[str, Column]:
    """Postings that any flow of these reports reads, by the id it reads them by."""
    legs = [pair.is_leg(side) for pair in (WITHDRAWALS, SPORTS_AND_CASINO_BETS) for side in ("debit", "credit")]
    taken = F.col(WITHDRAWALS.type_column).isin(*WITHDRAWALS.types)
    return {
        "patron_transaction_id": alerts.is_deposit() | wire(WIRE_WITHDRAWAL, AML_WIRE_REASONS) | taken,
        "ledger_transaction_id": reduce(Column.__or__, legs),
        "bet_history_id": F.col("p_type").isin(*RESETTLEMENT_TYPES),
        "p_vegas_bet_id": on_customer(*PAYOUT_TYPES) | F.col("p_type").isin(*RESETTLEMENT_TYPES, *SPORTS_AND_CASINO_BETS.types),
    }


def _weighted(rows: DataFrame, players: DataFrame, on: bool = True) -> DataFrame:
    """Rows of the driver's players; cents count once per driver row if ``on``."""
    mine = alerts.driven(rows, players)
    return mine.withColumn("cents", F.col("cents") * F.col("times")) if on else mine


def _per_second(rows: DataFrame) -> DataFrame:
    return rows.select(bucket("ts", "second").alias("ts"), "patron_id", "bet_id", "cents")


def _profile(tables: Catalog, tz: str, players: DataFrame) -> DataFrame:
    profile = payment_profile(
        tables.payment_deposits,
        tables.payment_providers,
        tables.payment_merchants,
        tables.payment_customers,
        tables.payment_users,
        tables.users,
        tz=tz,
        players=players,
    )
    return profile.select("patron_id", "merchants", "providers", "payment_cards", "kyc_date", "last_login_at")


def _ordered(rows: DataFrame) -> DataFrame:
    """The finished rows, newest and largest first; stored before, as the sort runs what is below it once more for its bounds."""
    return compute_once(rows).orderBy(F.col("deposit_period").desc(), F.col("deposit_amount").desc())


def high_value_deposits(
    tables: Catalog,
    window: ReportWindow,
    *,
    single: int = alerts.SINGLE_DEPOSIT,
    aggregate: int = alerts.AGGREGATE_DEPOSIT,
    lifetime_floor: int = alerts.LIFETIME_FLOOR,
    free_bets: DataFrame | None = None,
    collapse: bool = False,
) -> DataFrame:
    """Players with one large or several adding-up deposits in a month of the window.

    The ledger is read three times: for the driver, for the postings of its players, and for the house's legs
    of their transactions with the ids of free bets, unless ``free_bets`` (bet_id) are given.

    ``collapse`` gives one row per alert where the reference repeats it for a player with both
    matched and wire withdrawals.
    """
    tz = window.tz
    report = compute_once(
        alerts.threshold_alerts(
            alerts.deposit_transactions(tables.accounting, tables.users, tz=tz),
            [PERIOD, "username", "patron_id"],
            single=single,
            aggregate=aggregate,
        )
    )
    # the driver cuts every later frame, so it is found once; alerts of any month repeat the amounts joined to them, so the counts come before the cut
    players = alerts.driver_counts(report)
    report = report.where(window.holds_local(PERIOD))
    mine = player_postings(tables.accounting, players, _monitored())
    house = reached_postings(tables.accounting, mine, (SPORTS_AND_CASINO_BETS, WITHDRAWALS), free_bets=free_bets is None)
    free = free_bets if free_bets is not None else free_bet_ids(house)

    settled = bet_ops.bet_activity(
        alerts.driven(tables.bets, players),
        [bucket("closed_at", "month").alias(PERIOD), F.col("patron_id")],
        cash_excludes_free=True,
    )
    lifetime = bet_ops.bet_activity(
        alerts.driven(tables.bets, players), [F.col("patron_id")], cash_excludes_free=True, prefix="lt_"
    )
    # who is on the report matters, not how often
    once = players.withColumn("times", F.lit(1).cast("bigint"))
    refs = compute_once(alerts.withdrawal_refs(mine, tz=tz, players=once, credit_ledger=house))
    taken = alerts.withdrawal_totals(refs, by_month=True, collapse=collapse)
    lt_taken = alerts.withdrawal_totals(refs, by_month=False, prefix="lt_", collapse=collapse)
    lt_given = alerts.lifetime_deposits(mine, once, floor=lifetime_floor).drop("ranks")

    stack = revenue.sports_stack(
        union_transfers(
            _per_second(cash_bets(mine, free, tz, SPORTS_AND_CASINO_BETS, credits=house, summed=False)),
            _per_second(_weighted(bet_ops.free_bets_wagered(tables.bets, None, tz=tz, summed=False), players, False)),
        ),
        _per_second(_weighted(bet_ops.voided(tables.bets, None, tz=tz, summed=False), players, False)),
        _per_second(_weighted(resettlement(mine, tables.bet_states, None, tz=tz), players)),
        union_transfers(
            _per_second(_weighted(sports_payouts(mine, tz, PAYOUT_TYPES, summed=False), players)),
            _per_second(first_settlement(mine, tables.bet_states, None, tz=tz, summed=False)),
        ),
    )
    stack = stack.join(tables.users.select("patron_id"), "patron_id", "left_semi")
    ggr = revenue.player_ggr(stack, bet_and_market_info(tables.bets, tables.legs), None)

    people = tables.users.where(F.col("is_tester") == F.lit(False)).select(
        "patron_id", "first_name", "last_name", "employment_status", "job_title", "employer_name"
    )
    wide = enrich(
        report.join(people, "patron_id"),
        [
            (settled, ["patron_id", PERIOD]),
            (lifetime, ["patron_id"]),
            (taken, ["patron_id", PERIOD]),
            (lt_taken, ["patron_id"]),
            (lt_given, ["patron_id"]),
            (_profile(tables, tz, once), ["patron_id"]),
            (ggr, ["patron_id"]),
        ],
    )
    def count(name: str) -> Column:
        return F.coalesce(name, F.lit(0)).cast("bigint").alias(name)

    def money(cents: str, name: str) -> Column:
        return dollars(F.coalesce(cents, F.lit(0))).alias(name)

    def share(top: str, bottom: str) -> Column:
        return F.coalesce(ratio(top, bottom), F.lit(0)).cast("decimal(38,6)")

    out = wide.select(
        F.col(PERIOD).alias("deposit_period"),
        F.col("transaction_type").alias("deposit_detection"),
        "patron_id",
        "username",
        "first_name",
        "last_name",
        "employment_status",
        F.col("job_title").alias("occupation"),
        "employer_name",
        count("bets"),
        count("free_bets"),
        money("settled_cash", "settled_cash"),
        money("settled_free", "settled_free"),
        "deposits",
        dollars("deposit_cents").alias("deposit_amount"),
        count("withdrawals"),
        money("withdrawal_cents", "withdrawal_amount"),
        share("settled_cash", "deposit_cents").alias("Settled:Deposit"),
        count("lt_bets"),
        count("lt_free_bets"),
        money("lt_settled_cash", "lt_settled_cash"),
        money("lt_settled_free", "lt_settled_free"),
        count("lt_deposits"),
        money("lt_deposit_cents", "lt_deposit_amount"),
        count("lt_withdrawals"),
        money("lt_withdrawal_cents", "lt_withdrawal_amount"),
        share("lt_settled_cash", "lt_deposit_cents").alias("LT Settled:Deposit"),
        dollars("ggr_cents").alias("lt_ggr_cash"),
        "merchants",
        "providers",
        "payment_cards",
        "kyc_date",
        "last_login_at",
    )
    return _ordered(out)


DRIVER_ATTRS = ("username", "first_name", "last_name", "employment_status", "job_title", "employer_name")


def non_earning_occupation(
    tables: Catalog,
    window: ReportWindow,
    *,
    rolling: bool = False,
    floor: int = alerts.MONTHLY_DEPOSIT,
    six: int = alerts.SIX_MONTH_DEPOSIT,
    twelve: int = alerts.TWELVE_MONTH_DEPOSIT,
    collapse: bool = False,
) -> DataFrame:
    """Players whose deposits of a month reach the floor, with their activity.

    ``rolling`` adds the six- and twelve-month look-backs and keeps players over either (R12).
    Frames joined to the driver row by row in the reference count once per driver row here too. The ledger
    is read three times: for the driver, for the postings of its players, and for the bets posted in the window.
    """
    tz = window.tz
    ledger = tables.accounting
    # the driver cuts every later frame, so it is found once
    report = compute_once(alerts.monthly_depositors(ledger, tables.users, window, DRIVER_ATTRS, floor=floor))
    players = alerts.driver_counts(report)
    mine = player_postings(ledger, players, _monitored())
    period = in_window(mine, "t_changed_at", window)

    bets = alerts.driven(tables.bets, players)
    repeated = bets.withColumn("bet_amount_cents", F.col("bet_amount_cents") * F.col("times"))
    settled = bet_ops.bet_activity(
        in_window(repeated, "closed_at", window),
        [bucket(to_local("closed_at", tz), "month").alias(PERIOD), F.col("patron_id")],
        cash_excludes_free=False,
    )
    lifetime = bet_ops.bet_activity(
        repeated, [F.col("patron_id")], cash_excludes_free=False, prefix="lt_", free_default=0
    )
    refs = compute_once(
        alerts.withdrawal_refs(period, tz=tz, players=players, cut_credits=True, wire_ledger=mine, within=window)
    )
    taken = alerts.withdrawal_totals(refs, by_month=True, collapse=collapse)
    lt_taken = alerts.withdrawal_totals(refs, by_month=False, weigh_matched=True, prefix="lt_", collapse=collapse)
    lt_given = alerts.lifetime_deposits(mine, players, floor=floor).drop("ranks")

    own_bets = tables.bets.join(players, "patron_id", "left_semi")
    free = compute_once(free_bet_ids_posted(own_bets, ledger, window))
    first = first_settlement(mine, tables.bet_states, window, tz=tz, summed=False)
    stack = revenue.sports_stack(
        union_transfers(
            _per_second(cash_bets(period, free, tz, SPORTS_AND_CASINO_BETS, summed=False)),
            _per_second(bet_ops.free_bets_wagered(own_bets, window, tz=tz, summed=False)),
        ),
        _per_second(_weighted(bet_ops.voided(own_bets, window, tz=tz, summed=False), players)),
        _per_second(_weighted(resettlement(mine, tables.bet_states, window, tz=tz), players)),
        union_transfers(
            _per_second(_weighted(sports_payouts(period, tz, PAYOUT_TYPES, summed=False), players)),
            _per_second(_weighted(first, players, False)),
        ),
    )
    ggr = revenue.player_ggr(stack, bet_and_market_info(tables.bets, tables.legs), players, window)

    frames = [
        (settled, ["patron_id", PERIOD]),
        (lifetime, ["patron_id"]),
        (taken, ["patron_id", PERIOD]),
        (lt_taken, ["patron_id"]),
        (lt_given, ["patron_id"]),
        (_profile(tables, tz, players), ["patron_id"]),
        (ggr, ["patron_id"]),
    ]
    if rolling:
        over = alerts.rolling_alerts(mine, players, window, six=six, twelve=twelve)
        report = report.join(over, "patron_id")
    wide = enrich(report.where(window.holds_local(PERIOD)) if not rolling else report, frames)
    look_back = (
        [
            F.col("r6_deposits"),
            dollars("r6_deposit_cents").alias("r6_deposit_amount"),
            F.col("r12_deposits"),
            dollars("r12_deposit_cents").alias("r12_deposit_amount"),
        ]
        if rolling
        else []
    )
    zero = F.lit(0)
    out = wide.select(
        F.col(PERIOD).alias("deposit_period"),
        "patron_id",
        "username",
        is_non_earning("employment_status").alias("is_non_earning"),
        "first_name",
        "last_name",
        F.col("job_title").alias("occupation"),
        F.col("employment_status").alias("occupation_type"),
        "employer_name",
        "bets",
        "free_bets",
        dollars("settled_cash").alias("settled_cash"),
        dollars("settled_free").alias("settled_free"),
        "deposits",
        dollars("deposit_cents").alias("deposit_amount"),
        *look_back,
        F.coalesce("withdrawals", zero).cast("bigint").alias("withdrawals"),
        dollars(F.coalesce("withdrawal_cents", zero)).alias("withdrawal_amount"),
        ratio("settled_cash", "deposit_cents").alias("Settled:Deposit"),
        "lt_bets",
        "lt_free_bets",
        dollars("lt_settled_cash").alias("lt_settled_cash"),
        dollars("lt_settled_free").alias("lt_settled_free"),
        "lt_deposits",
        dollars("lt_deposit_cents").alias("lt_deposit_amount"),
        F.coalesce("lt_withdrawals", zero).cast("bigint").alias("lt_withdrawals"),
        dollars(F.coalesce("lt_withdrawal_cents", zero)).alias("lt_withdrawal_amount"),
        ratio("lt_settled_cash", "lt_deposit_cents").alias("LT Settled:Deposit"),
        dollars("ggr_cents").alias("lt_ggr_cash"),
        "merchants",
        "providers",
        "payment_cards",
        "kyc_date",
        "last_login_at",
    )
    return _ordered(out)
