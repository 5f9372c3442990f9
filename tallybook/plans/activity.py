"""Daily activity reports: per player (R03) and per game."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallybook.functions.labels import age_years, gender_code, postal_prefix
from tallybook.functions.money import DOLLARS, EXACT, dollars, exact_dollars
from tallybook.functions.periods import ReportWindow, bucket, in_window, moment, to_local
from tallybook.lineage import compute_once, drop
from tallybook.operators import balances, carry, casino, jackpots, sessions
from tallybook.operators import bets as bet_ops
from tallybook.operators.cuts import flow_postings
from tallybook.operators.ledger import (
    CANCELLED_WITHDRAWALS,
    CASINO_WAGERS,
    CUSTOMER_LIABILITY,
    ONTARIO,
    SPORTS_BETS,
    SPORTS_PAYOUT_TYPES,
    WITHDRAWALS,
    LegPair,
    as_moves,
    bet_id,
    cash_adjustment,
    deposit_flows,
    flag_promo,
    in_state,
    is_any,
    matched_transfers,
    on_customer,
    real_players,
    withdrawal_flows,
)
from tallybook.operators.measures import flow_is, stack_in_parts, union_measures
from tallybook.operators.profiles import status_flags
from tallybook.operators.regulator import SITE_ID
from tallybook.operators.revenue import GAME_KEYS, GAME_MEASURES, game_activity
from tallybook.operators.settlement import RESETTLEMENT_TYPES, first_settlement, resettlement
from tallybook.plans.finance import cash_bets
from tallybook.plans.models import stored_jackpots
from tallybook.operators.markets import bet_and_market_info
from tallybook.sources.catalog import Catalog


@dataclass
class _Flows:
    """The frames both reports start from, on (ts, patron_id, bet_id or ref_id, cents)."""

    cash_bets: DataFrame
    free_bets: DataFrame
    sports_net: DataFrame  # postings, is_promo
    settled: DataFrame  # postings
    resettled: DataFrame  # is_promo
    voided: DataFrame  # is_promo
    pending: DataFrame  # is_promo
    rollbacks: DataFrame  # is_promo, category
    free_rounds: DataFrame
    casino_won: DataFrame
    free_round_payouts: DataFrame
    model: DataFrame


#: Columns that the flows choose and add up postings by.
_POSTING = (
    "a_patron_id",
    "a_type",
    "p_type",
    "t_type",
    "adjustment_reason",
    "adjustment_type",
    "debit_cents",
    "credit_cents",
    "t_changed_at",
)


def _read_postings(
    ledger: DataFrame, window: ReportWindow, pairs: Mapping[str, LegPair], moved: Column | None = None
) -> DataFrame:
    """What the flows of ``_flows``, the report's own transfers and the ``moved`` postings read of the window; stored."""

    def legs(*some: LegPair) -> Column:
        sides = [(pair, side) for pair in some for side in ("debit", "credit")]
        return reduce(Column.__or__, [pair.is_leg(side) & (F.col(f"{side}_cents") > 0) for pair, side in sides])

    sports = on_customer(*SPORTS_PAYOUT_TYPES)
    resettled = F.col("p_type").isin(*RESETTLEMENT_TYPES)
    paid = (F.col("p_type") == "casino_payout") & (F.col("a_type") == CUSTOMER_LIABILITY)
    of_bet = sports | resettled | legs(SPORTS_BETS)
    by_ref = {ref: [p for p in pairs.values() if p.ref == ref] for ref in ("patron_transaction_id", "p_id")}
    ids = {
        "ledger_transaction_id": sports | legs(SPORTS_BETS, *pairs.values()),
        "patron_transaction_id": paid,
        "p_id": paid,
        "bet_history_id": resettled,
        "p_bet_id": of_bet,
        "p_vegas_bet_id": of_bet,
    }
    ids |= {ref: ids[ref] | legs(*some) for ref, some in by_ref.items() if some}
    rows = in_state(in_window(ledger, "t_changed_at", window), ONTARIO)
    return flow_postings(rows, ids, F.lit(False) if moved is None else moved, _POSTING)


def _flows(tables: Catalog, window: ReportWindow, ledger: DataFrame, *, with_category: bool) -> _Flows:
    tz = window.tz
    # a posting inside the window makes its free bet one "with a posting in the window", so the
    # free bets themselves are the id set
    free = tables.bets.where(bet_ops.is_free()).select(F.col("id").alias("bet_id"))
    sports = flag_promo(ledger.where(on_customer(*SPORTS_PAYOUT_TYPES)), free)
    resettled = resettlement(ledger, tables.bet_states, window, tz=tz)
    resettled = resettled.withColumn("is_promo", F.col("promo_id").isNotNull())
    return _Flows(
        cash_bets=cash_bets(ledger, free, tz),
        free_bets=bet_ops.free_bets_wagered(tables.bets, window, tz=tz),
        sports_net=as_moves(sports, bet_id().alias("bet_id"), "is_promo", tz=tz),
        settled=first_settlement(ledger, tables.bet_states, window, tz=tz, summed=False),
        resettled=resettled,
        voided=bet_ops.voided(tables.bets, window, tz=tz, promo=None),
        pending=bet_ops.open_exposure(tables.bets, window, promo=None),
        rollbacks=casino.casino_rollbacks(
            tables.casino_wager_rollbacks,
            tables.wager_and_game_info,
            window,
            tz=tz,
            patron_transactions=tables.patron_transactions,
        ),
        free_rounds=casino.free_rounds_wagered(
            tables.casino_wagers,
            tables.patron_transactions,
            window,
            tz=tz,
            wager_info=tables.wager_and_game_info if with_category else None,
        ),
        casino_won=casino.casino_payouts(ledger, tables.casino_payouts, window, tz=tz),
        free_round_payouts=casino.free_round_payouts(
            tables.casino_payouts, tables.patron_transactions, window, tz=tz
        ),
        model=stored_jackpots(tables, window.end_utc),
    )


# --- fixed values -----------------------------------------------------------------------------
NEVER_ACTIVE = "00000000"
# ----------------------------------------------------------------------------------------------

CENTS = "bigint"
PLAYER_MEASURES = {
    "start_balance": CENTS,
    "deposits": CENTS,
    "withdrawals": CENTS,
    "adjustments": CENTS,
    "player_win": CENTS,
    "player_win_jackpot": EXACT,
    "unsettled_wagers": CENTS,
    "withdrawable_win": CENTS,
    "withdrawable_jackpot": EXACT,
    "end_balance": CENTS,
    "promo_start_balance": CENTS,
    "promo_adjustments": CENTS,
    "promo_player_wagers": CENTS,
    "promo_unsettled_wagers": CENTS,
    "promo_end_balance": CENTS,
    "num_game_sessions": CENTS,
    "num_wagers": CENTS,
    "total_gameplay_duration": CENTS,
    "wagers_slots": CENTS,
    "wagers_tables": CENTS,
    "wagers_livedealer": CENTS,
    "wagers_betting": CENTS,
    "wagers_other": CENTS,
}


def player_measures(
    tables: Catalog,
    window: ReportWindow,
    users_at_start: DataFrame,
    bonus_at_start: DataFrame,
    carried: carry.Carried | None = None,
) -> DataFrame:
    """Every measure of the player report per (gaming day, player)."""
    tz = window.tz
    given, taken, changed = is_any(deposit_flows()), is_any(withdrawal_flows()), cash_adjustment()
    pairs = {"withdrawn": WITHDRAWALS, "cancelled": CANCELLED_WITHDRAWALS, "casino": CASINO_WAGERS}
    ledger = _read_postings(tables.accounting, window, pairs, given | taken | changed)
    f = _flows(tables, window, ledger, with_category=True)

    moved = as_moves(
        ledger.where(given | taken | changed), given.alias("given"), taken.alias("taken"), changed.alias("changed"), tz=tz
    )
    won = as_moves(casino.label_payouts(ledger, tables.casino_payouts).where(F.col("award_id").isNull()), tz=tz)
    matched = matched_transfers(ledger, pairs, tz)
    casino_wagers = casino.with_game(
        matched.where(flow_is("casino")), tables.wager_and_game_info, ["game_category"]
    ).withColumnRenamed("game_category", "category")
    programs, unlocks = tables.user_award_bonus_cash, tables.user_bonus_cash_transactions
    if carried is None:
        released = compute_once(balances.bonus_released(tables.accounting, tz=tz))
        opening, closing = balances.opening_and_closing(
            tables.accounting, users_at_start, tables.users, window, state=ONTARIO
        )
        bonus_open = balances.opening_bonus(users_at_start, bonus_at_start, released, programs, unlocks, window)
        bonus_close = balances.closing_bonus(tables.users, tables.bonus_transactions, released, window)
    else:
        released = compute_once(balances.bonus_released(in_window(tables.accounting, "t_changed_at", window), tz=tz))
        moves = player_moves(tables)
        ended = carry.carry(moves, window.end, before=carried, tz=tz)
        opening, _ = carry.carried_cash(carried, moves, users_at_start, tables.users)
        _, closing = carry.carried_cash(ended, moves, users_at_start, tables.users)
        bonus_open = carry.carried_opening_bonus(carried, users_at_start, programs, unlocks, window)
        bonus_close = carry.carried_closing_bonus(ended, tables.users, window)
    bonus_moves = balances.bonus_adjustments(
        users_at_start, tables.users, tables.bonus_transactions, released, bonus_close, window
    )
    free_jackpots = jackpots.jackpot_payouts(
        f.free_round_payouts, f.model, ["ts", "patron_id", "ref_id"], free=True
    )
    played = sessions.session_summary(
        sessions.game_transactions(tables.wager_and_game_info, tables.patron_transactions, window),
        "patron_id",
        "casino_session_id",
        window,
    )
    promo, cash = F.col("is_promo"), ~F.col("is_promo")
    category = F.col("category")

    def dated(frame: DataFrame) -> DataFrame:
        return frame.where(window.holds_local("ts")).withColumn("gaming_day", bucket("ts", "day"))

    def at_start(frame: DataFrame) -> DataFrame:
        return frame.withColumn("gaming_day", bucket(moment(window.start), "day"))

    cents = F.col("cents")
    # flows that share a shuffle are in one part
    parts = [
        [
            (at_start(opening), {"start_balance": cents}),
            (at_start(closing), {"end_balance": cents}),
        ],
        [
            (at_start(bonus_open), {"promo_start_balance": cents}),
            (at_start(bonus_moves), {"promo_adjustments": cents}),
            (at_start(bonus_close), {"promo_end_balance": cents}),
            (dated(released), {"adjustments": cents}),
        ],
        [
            (
                dated(moved),
                {
                    "deposits": F.when(F.col("given"), cents),
                    "withdrawals": F.when(F.col("taken"), -cents),
                    "adjustments": F.when(F.col("changed"), cents),
                },
            ),
            (
                dated(matched.where(flow_is("withdrawn", "cancelled"))),
                {"withdrawals": F.when(flow_is("withdrawn"), cents).otherwise(-cents)},
            ),
            (dated(casino_wagers), sessions.signed_wagers("ref_id", 1, category)),
            (dated(won), {"player_win": cents}),
        ],
        [
            (
                dated(f.sports_net),
                {"player_win": F.when(cash, cents), "withdrawable_win": F.when(promo, cents)},
            ),
            (dated(f.settled), {"player_win": cents}),
            (
                dated(f.resettled),
                {"player_win": F.when(cash, -cents), "withdrawable_win": F.when(promo, -cents)},
            ),
            (
                dated(f.pending),
                {"unsettled_wagers": F.when(cash, cents), "promo_unsettled_wagers": F.when(promo, cents)},
            ),
            (dated(f.cash_bets), sessions.signed_wagers("bet_id", 1)),
            (dated(f.free_bets), {"promo_player_wagers": cents, **sessions.signed_wagers("bet_id", 1)}),
            (
                dated(f.voided),
                {"promo_player_wagers": F.when(promo, -cents), **sessions.signed_wagers("bet_id", -1)},
            ),
        ],
        [
            (dated(f.free_round_payouts), {"withdrawable_win": cents}),
            (
                dated(free_jackpots),
                {"player_win_jackpot": F.col("amount"), "withdrawable_jackpot": -F.col("amount")},
            ),
            (
                dated(f.free_rounds),
                {"promo_player_wagers": cents, **sessions.signed_wagers("ref_id", 1, category)},
            ),
            (
                dated(f.rollbacks),
                {
                    "promo_player_wagers": F.when(promo, -cents),
                    **sessions.signed_wagers("ref_id", -1, category),
                },
            ),
            (
                at_start(played),
                {"num_game_sessions": "num_game_sessions", "total_gameplay_duration": "total_gameplay_duration"},
            ),
        ],
    ]
    stack = stack_in_parts(parts, ["gaming_day", "patron_id"], PLAYER_MEASURES)
    drop(ledger, released)
    return stack


def player_moves(tables: Catalog) -> DataFrame:
    """What the balances of the player report add up from, to be carried from period to period."""
    return carry.ledger_moves(tables.accounting, state=ONTARIO).unionByName(carry.bonus_moves(tables.bonus_transactions))


def player_activity(
    tables: Catalog,
    window: ReportWindow,
    *,
    users_at_start: DataFrame,
    bonus_at_start: DataFrame,
    run_at: datetime,
    carried: carry.Carried | None = None,
) -> DataFrame:
    """Player activity per gaming day.

    ``tables.users`` and ``tables.bonus_transactions`` are the snapshots at the end of the
    period; the two arguments are those at its start. With ``carried``, the state of ``player_moves``
    at the window's start, balances are carried on instead of added up from all history.
    """
    tz = window.tz
    if carried is not None and carried.upto != window.start:
        raise ValueError("the carried state is not that of the window's start")
    measures = player_measures(tables, window, users_at_start, bonus_at_start, carried)
    stamp = "yyyyMMdd"
    # labels are worked out once per player, before they meet the daily rows
    people = tables.users.where(F.col("is_tester") == F.lit(False)).select(
        "patron_id",
        age_years("birthdate", F.lit(run_at.date())).alias("Age"),
        gender_code("gender").alias("Gender"),
        F.date_format(to_local("registration_completed_at", tz), stamp).alias("RegistrationDate"),
    )
    homes = tables.addresses.select(F.col("user_id").alias("patron_id"), postal_prefix("postal_code").alias("FSA"))
    active = balances.last_activity(tables.accounting, window, state=ONTARIO).select(
        "patron_id", F.date_format(to_local("last_active_at", tz), stamp).alias("LastActiveDate")
    )
    rows = measures.join(people, "patron_id").join(homes, "patron_id", "left").join(active, "patron_id", "left")
    rows = status_flags(rows, tables.break_status, "BreakStart", "BreakEnd", "BreakStatus")
    rows = status_flags(rows, tables.self_exclusion_status, "SEStart", "SEEnd", "SEStatus")

    labels = ["Age", "Gender", "FSA", "RegistrationDate", "LastActiveDate"]
    status = ["BreakStatus", "BreakStart", "BreakEnd", "SEStatus", "SEStart", "SEEnd"]
    mixed = ("player_win", "player_win_jackpot", "withdrawable_win", "withdrawable_jackpot")
    plain = [m for m in PLAYER_MEASURES if m not in mixed]
    # equal rows are merged while amounts are still whole cents, which hash and compare cheaply
    merged = rows.select(
        "patron_id",
        *labels,
        *status,
        *plain,
        (exact_dollars("player_win") + F.col("player_win_jackpot")).cast(DOLLARS).alias("won"),
        (exact_dollars("withdrawable_win") + F.col("withdrawable_jackpot")).cast(DOLLARS).alias("withdrawable"),
    ).distinct()

    all_wagers = sum(
        (F.col(c) for c in ("wagers_tables", "wagers_livedealer", "wagers_betting", "wagers_other")),
        F.col("wagers_slots"),
    )
    cash_wagers = all_wagers - F.col("promo_player_wagers")
    won = F.col("won")
    zero = F.lit(0)
    return merged.select(
        F.lit(window.start.date()).alias("GamingDay"),
        F.lit(SITE_ID).alias("GamingSiteID"),
        F.col("patron_id").alias("PlayerID"),
        "Age",
        "Gender",
        "FSA",
        "RegistrationDate",
        F.coalesce("LastActiveDate", F.lit(NEVER_ACTIVE)).alias("LastActiveDate"),
        dollars("start_balance").alias("StartBalance"),
        dollars("deposits").alias("Deposits"),
        dollars("withdrawals").alias("Withdrawals"),
        dollars("adjustments").alias("Adjustments"),
        dollars(cash_wagers).alias("PlayerWagers"),
        won.alias("PlayerWin"),
        dollars("unsettled_wagers").alias("UnsettledWagers"),
        (won - dollars(cash_wagers)).cast(DOLLARS).alias("Win/Loss"),
        F.col("withdrawable").alias("WithdrawableWin"),
        dollars("end_balance").alias("EndBalance"),
        dollars("promo_start_balance").alias("PromoStartBalance"),
        dollars("promo_adjustments").alias("PromoAdjustments"),
        dollars("promo_player_wagers").alias("PromoPlayerWagers"),
        dollars("promo_unsettled_wagers").alias("PromoUnsettledWagers"),
        zero.alias("PromoPlayerWin"),
        dollars("promo_end_balance").alias("PromoEndBalance"),
        F.col("num_game_sessions").alias("#ofGameSessions"),
        F.col("num_wagers").alias("#ofWagers"),
        F.col("total_gameplay_duration").alias("TotalGameplayDuration"),
        dollars("wagers_slots").alias("WagersSlots"),
        dollars("wagers_tables").alias("WagersTables"),
        dollars("wagers_livedealer").alias("WagersLiveDealer"),
        dollars("wagers_betting").alias("WagersBetting"),
        zero.alias("WagersP2PPoker"),
        dollars("wagers_other").alias("WagersOther"),
        dollars(all_wagers).alias("WagersMobile"),
        zero.alias("WagersPC"),
        *status,
        F.lit("0").alias("HighRisk"),
    )


def game_report(tables: Catalog, window: ReportWindow, *, ordered: bool = False) -> DataFrame:
    """Game activity of the period (R04); ``ordered`` sorts by the seven key columns, missing values last."""
    tz = window.tz
    ledger = _read_postings(tables.accounting, window, {"casino": CASINO_WAGERS})
    f = _flows(tables, window, ledger, with_category=False)
    players = real_players(tables.users)
    wagers = casino.transfer_to_casino(ledger, tables.wager_and_game_info, window, tz=tz, game=())
    contributed = jackpots.jackpot_contributions(wagers, f.model, ["ts", "patron_id", "ref_id"])
    keys = ["ts", "patron_id", "ref_id"]
    won_cash = jackpots.jackpot_payouts(f.casino_won, f.model, keys, free=False)
    won_free = jackpots.jackpot_payouts(f.free_round_payouts, f.model, keys, free=True)

    cents, amount = F.col("cents"), F.col("amount")
    promo, cash = F.col("is_promo"), ~F.col("is_promo")

    def on_grain(frame: DataFrame) -> DataFrame:
        for name in ("bet_id", "ref_id"):
            if name not in frame.columns:
                frame = frame.withColumn(name, F.lit(None).cast("string"))
        return frame

    one = F.lit(1)
    sources = [
        (f.cash_bets, {"num_wagers": one, "wagers_game": cents}),
        (wagers, {"num_wagers": one, "wagers_game": cents}),
        (
            f.rollbacks,
            {
                "num_wagers": -one,
                "wagers_game": F.when(cash, -cents),
                "promo_wagers_game": F.when(promo, -cents),
            },
        ),
        (contributed, {"win_jackpot": amount}),
        (
            f.voided,
            {
                "num_wagers": -one,
                "wagers_game": F.when(cash, -cents),
                "promo_wagers_game": F.when(promo, -cents),
            },
        ),
        (
            f.pending,
            {"unsettled_wagers": F.when(cash, cents), "promo_unsettled_wagers": F.when(promo, cents)},
        ),
        (f.sports_net, {"win_game": F.when(cash, cents), "withdrawable_win": F.when(promo, cents)}),
        (f.settled, {"win_game": cents}),
        (f.casino_won, {"win_game": cents}),
        (won_cash, {"win_jackpot": -amount}),
        (f.resettled, {"win_game": F.when(cash, -cents), "withdrawable_win": F.when(promo, -cents)}),
        (f.free_bets, {"num_wagers": one, "promo_wagers_game": cents}),
        (f.free_rounds, {"num_wagers": one, "promo_wagers_game": cents}),
        (f.free_round_payouts, {"withdrawable_win": cents}),
        (won_free, {"withdrawable_jackpot": -amount}),
    ]
    stack = union_measures(
        [(on_grain(frame), given) for frame, given in sources],
        ["ts", "patron_id", "bet_id", "ref_id"],
        GAME_MEASURES,
    )
    by_game = sessions.game_transactions(
        tables.wager_and_game_info.join(players, "patron_id", "left_semi"), tables.patron_transactions, window
    )
    played = sessions.session_summary(by_game, "game_id", "casino_session_id", window)
    out = game_activity(
        stack,
        tables.wager_and_game_info,
        bet_and_market_info(tables.bets, tables.legs),
        played,
        tables.games,
        players,
        window,
        SITE_ID,
    )
    return out.orderBy(*[F.col(c).asc_nulls_last() for c in out.columns[:2] + GAME_KEYS]) if ordered else out
