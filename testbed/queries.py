"""One entry per operator and report, run over the derived domain tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import datetime, timedelta
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tallybook.functions import labels
from tallybook.functions.money import dollars, exact_dollars
from tallybook.functions.periods import TORONTO, ReportWindow, bucket, in_window, moment, to_local
from tallybook.lineage import shared_folder
from tallybook.operators import alerts, balances, carry, casino, free_bets, jackpots, profiles, promos, regulator, revenue, sessions
from tallybook.operators import bets as bet_ops
from tallybook.operators.ledger import (
    ONTARIO,
    SPORTS_BETS,
    bet_id,
    exclude,
    free_bet_ids,
    free_bet_ids_posted,
    in_state,
    ledger_legs,
    matched,
    net_movement,
    on_customer,
    only,
    real_players,
)
from tallybook.operators.markets import bet_and_market_info
from tallybook.operators.measures import stack_measures, total_measures
from tallybook.operators.settlement import first_settlement, resettlement, resettlement_rollup, union_transfers
from tallybook.operators.snapshots import advance_snapshot, latest_asof, latest_attrs, latest_settlement, take_snapshot
from tallybook.plans import activity, aml, finance, models
from tallybook.plans.finance import cash_bets, sports_payouts
from tallybook.sources.catalog import Catalog, DayLayout
from testbed.tables import catalog

# all but the first and last year of the test tables, so that both bounds cut something
PERIOD = ReportWindow(datetime(1996, 1, 1), datetime(2001, 1, 1))
DAYS = (PERIOD.end - PERIOD.start).days
EVENTS = ReportWindow(datetime(2024, 1, 5), datetime(2024, 1, 26))
CUTOFFS = (datetime(1997, 3, 1), datetime(1997, 3, 2, 1), datetime(1999, 6, 30))
RUN_AT = datetime(2002, 3, 4, 5, 6, 7)
TZ = TORONTO

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(build: Callable[[Catalog], DataFrame]) -> Callable[[Catalog], DataFrame]:
    """Register a query under its function name."""
    QUERIES[build.__name__] = lambda spark, sf_dir: build(catalog(spark, sf_dir))
    return build


def _start_users(t: Catalog) -> DataFrame:
    return t.users.where(PERIOD.started_utc("inserted_at"))


def _in_period(t: Catalog) -> DataFrame:
    return in_window(t.accounting, "t_changed_at", PERIOD)


def _in_ontario(t: Catalog) -> DataFrame:
    return in_state(_in_period(t), ONTARIO)


def _listed(t: Catalog) -> DataFrame:
    """The patron list of the sheets: every customer in a household segment."""
    return t.customer.where(F.col("c_mktsegment") == "HOUSEHOLD").select(
        F.col("c_custkey").cast("string").alias("patron_id"), F.col("c_custkey").cast("string").alias("id")
    )


def _model(t: Catalog) -> DataFrame:
    return models.jackpots_from_history(t, PERIOD.end_utc)


# --- snapshots and time -----------------------------------------------------------------------


@query
def b01_latest_version(t):
    newest = latest_asof(
        t.events, ["user_id", "event_type"], ["ts", "event_id"], datetime(2024, 1, 20), timedelta(minutes=2)
    )
    return newest.select("user_id", "event_type", "event_id", "ts", "value")


@query
def b01_bets_asof(t):
    newest = latest_asof(t.bets_history, ["id"], cutoff=PERIOD.end_utc)
    return newest.select("id", "status", "payout_amount_cents", "_changed_at", "updated_at")


@query
def b01_snapshot_carried(t):
    """The snapshot of three cutoffs, each from the one before and the versions since."""
    kept = take_snapshot(t.bets_history, ["id"], cutoff=CUTOFFS[0], grace=timedelta(minutes=2))
    shown = []
    for cutoff in CUTOFFS:
        if cutoff != CUTOFFS[0]:
            kept = advance_snapshot(kept, t.bets_history, cutoff=cutoff, grace=timedelta(minutes=2))
        rows = kept.visible().select("id", "status", "payout_amount_cents", "_changed_at", "updated_at")
        shown.append(rows.withColumn("cutoff", moment(cutoff)))
    return reduce(DataFrame.unionByName, shown)


@query
def b02_latest_single_clock(t):
    newest = latest_asof(
        t.wallet_transaction_jackpots,
        ["wallet_transaction_id", "jackpot_id"],
        ["updated_at"],
        PERIOD.end_utc,
        timedelta(minutes=2),
    )
    return newest.select("wallet_transaction_id", "jackpot_id", "type", "updated_at")


@query
def b03_report_window(t):
    rows = in_window(t.events, "ts", EVENTS, days_back=1)
    local = to_local("ts", TZ)
    return rows.select("event_id", "ts", EVENTS.holds_utc("ts").alias("in_utc"), EVENTS.holds_local(local).alias("in_local"))


@query
def b03_declared_layout(t):
    """A window over a table that is kept by local day, as its catalog declares."""
    spark, place = t.events.sparkSession, f"{shared_folder(t.events.sparkSession)}/by-day-{uuid.uuid4().hex}"
    by_day = t.events.withColumn("event_day", to_local("ts", TZ).cast("date"))
    by_day.repartition("event_day").write.partitionBy("event_day").parquet(f"{place}/events")
    schema = StructType(by_day.schema.fields)
    layout = DayLayout("ts", "event_day", TZ)
    laid_out = layout.mark(spark.read.schema(schema).parquet(f"{place}/events"))
    return in_window(laid_out, "ts", EVENTS, days_back=1).groupBy("event_day").agg(F.count(F.lit(1)).alias("events"))


@query
def b03_months_back(t):
    window = ReportWindow.month(1998, 8)
    return in_window(t.bets, "placed_at", window, months_back=6).select("id", "placed_at")


@query
def b04_local_time(t):
    bets = t.bets.select(F.col("id"), to_local("placed_at", TZ).alias("local"))
    events = t.events.select(F.concat(F.lit("e"), F.col("event_id").cast("string")).alias("id"), to_local("ts", TZ).alias("local"))
    return bets.unionByName(events)


@query
def b05_buckets(t):
    local = to_local("ts", TZ)
    rows = t.events.select(
        bucket(local, "month").alias("month"), bucket(local, "day").alias("day"), bucket(local, "second").alias("second")
    )
    return rows.groupBy("month", "day", "second").agg(F.count(F.lit(1)).alias("events"))


# --- ledger -----------------------------------------------------------------------------------


@query
def b06_ledger_legs(t):
    return ledger_legs(_in_period(t), SPORTS_BETS, "debit")


@query
def b07_match_legs(t):
    return matched(_in_period(t), SPORTS_BETS, [to_local("posted_at", TZ).alias("ts"), "patron_id", "ref_id"])


@query
def b08_net_movement(t):
    rows = _in_period(t).where(on_customer("sportsbook_cash_out_bet", "sportsbook_payout", "sportsbook_bet_lost"))
    return net_movement(
        rows, [to_local("t_changed_at", TZ).alias("ts"), F.col("a_patron_id").alias("patron_id"), bet_id().alias("bet_id")]
    )


@query
def b08_net_movement_flipped(t):
    rows = _in_ontario(t).where(on_customer("region_transfer_out"))
    return net_movement(
        rows, [to_local("t_changed_at", TZ).alias("ts"), F.col("a_patron_id").alias("patron_id")], flip=True
    )


@query
def b09_promo_split(t):
    free = free_bet_ids(t.accounting)
    rows = _in_period(t).withColumn("bet_id", bet_id()).where(F.col("p_type") == "sportsbook_bet")
    parts = [
        part.groupBy("a_patron_id", F.lit(kind).alias("kind")).agg(
            F.count(F.lit(1)).alias("postings"), F.sum("debit_cents").alias("debits")
        )
        for kind, part in (
            ("cash", exclude(rows, free, "bet_id", "bet_id")),
            ("free", only(rows, free, "bet_id", "bet_id")),
        )
    ]
    return parts[0].unionByName(parts[1])


@query
def b10_free_bets_posted(t):
    return free_bet_ids(t.accounting)


def _free_index(t):
    """The index as three refreshes leave it, each of which reads only its own time."""
    index = None
    for upto in (datetime(1995, 6, 1), datetime(1997, 1, 1), datetime(2000, 1, 1)):
        index, _ = free_bets.refresh(t.accounting, upto, index)
    return index


@query
def b10_free_bet_index(t):
    index = _free_index(t)
    kept = index.bets().withColumn("of", F.lit("index"))
    ours = index.bets(t.accounting, state=ONTARIO, players=real_players(t.users)).withColumn("of", F.lit("report"))
    return kept.unionByName(index.bets(t.accounting).withColumn("of", F.lit("ledger"))).unionByName(ours)


@query
def b10_free_bets_in_window(t):
    return free_bet_ids_posted(t.bets, t.accounting, PERIOD, ONTARIO)


@query
def b11_free_bets_wagered(t):
    return bet_ops.free_bets_wagered(t.bets, PERIOD, tz=TZ)


@query
def b12_voided(t):
    return bet_ops.voided(t.bets, PERIOD, tz=TZ, promo=None)


@query
def b12_voided_by_day(t):
    return bet_ops.voided_by_day(t.bets, None, tz=TZ)


@query
def b13_open_exposure(t):
    return bet_ops.open_exposure(t.bets, PERIOD, promo=None)


# --- settlement -------------------------------------------------------------------------------


@query
def b14_resettlement(t):
    return resettlement(t.accounting, t.bet_states, PERIOD, tz=TZ).select(
        "ts", "patron_id", "bet_id", "promo_id", "state", "previous_state", "account", "cents"
    )


@query
def b15_resettlement_rollup(t):
    detail = resettlement(t.accounting, t.bet_states, PERIOD, tz=TZ)
    kinds = {"cash": False, "free": True, "both": None}
    parts = [resettlement_rollup(detail, promo).withColumn("kind", F.lit(k)) for k, promo in kinds.items()]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query
def b16_first_settlement(t):
    return first_settlement(t.accounting, t.bet_states, PERIOD, tz=TZ, state=ONTARIO)


@query
def b17_transfer_from_sports(t):
    return union_transfers(
        sports_payouts(_in_period(t), TZ),
        first_settlement(t.accounting, t.bet_states, PERIOD, tz=TZ, state=ONTARIO),
    )


@query
def b18_transfer_to_sports(t):
    return union_transfers(
        cash_bets(_in_period(t), free_bet_ids(t.accounting), TZ), bet_ops.free_bets_wagered(t.bets, PERIOD, tz=TZ)
    )


# --- casino -----------------------------------------------------------------------------------


@query
def b19_transfer_to_casino(t):
    return casino.transfer_to_casino(t.accounting, t.wager_and_game_info, PERIOD, tz=TZ, extra=["gaming_state"])


@query
def b20_casino_rollbacks(t):
    return casino.casino_rollbacks(
        t.casino_wager_rollbacks, t.wager_and_game_info, PERIOD, tz=TZ, patron_transactions=t.patron_transactions
    )


@query
def b20_matched_rollbacks(t):
    return casino.matched_rollbacks(_in_ontario(t), by=[to_local("posted_at", TZ).alias("ts"), "patron_id"])


@query
def b21_free_rounds_wagered(t):
    return casino.free_rounds_wagered(
        t.casino_wagers, t.patron_transactions, PERIOD, tz=TZ, wager_info=t.wager_and_game_info
    )


@query
def b22_jackpot_model(t):
    return _model(t)


@query
def b23_jackpot_contributions(t):
    wagers = casino.transfer_to_casino(t.accounting, t.wager_and_game_info, PERIOD, tz=TZ, game=["game_category"])
    return jackpots.jackpot_contributions(wagers, _model(t), ["patron_id", "game_category"])


@query
def b24_jackpot_adjustments(t):
    model = _model(t)
    paid = casino.casino_payouts(t.accounting, t.casino_payouts, PERIOD, tz=TZ)
    wagers = casino.transfer_to_casino(t.accounting, t.wager_and_game_info, PERIOD, tz=TZ, game=())
    won = jackpots.jackpot_payouts(paid, model, ["ts", "patron_id", "ref_id"], free=False)
    made = jackpots.jackpot_contributions(wagers, model, ["ts", "patron_id", "ref_id"])
    return jackpots.net_adjustments(made, won, ["patron_id"])


@query
def b25_bet_and_market(t):
    return bet_and_market_info(t.bets, t.legs)


# --- stacks and balances ----------------------------------------------------------------------


def _small_stack(t):
    return stack_measures(
        [
            (bet_ops.free_bets_wagered(t.bets, PERIOD, tz=TZ), {"free": "cents"}),
            (bet_ops.voided(t.bets, PERIOD, tz=TZ), {"voided": -F.col("cents")}),
            (sports_payouts(_in_period(t), TZ), {"paid": "cents"}),
        ],
        ["ts", "patron_id"],
        {"free": "bigint", "voided": "bigint", "paid": "bigint"},
    )


@query
def b26_measure_stack(t):
    return _small_stack(t)


@query
def b27_measure_totals(t):
    rows = _small_stack(t).select(
        "patron_id", *[dollars(c).cast("decimal(28,2)").alias(c) for c in ("free", "voided", "paid")]
    )
    scale = {"free": "decimal(38,2)", "voided": "decimal(38,2)", "paid": "decimal(38,1)"}
    return total_measures(rows, ["patron_id"], scale)


@query
def b28_cash_balance(t):
    start, end = balances.opening_and_closing(t.accounting, _start_users(t), t.users, PERIOD, state=ONTARIO)
    return start.withColumn("at", F.lit("start")).unionByName(end.withColumn("at", F.lit("end")))


@query
def b28_carried_balances(t):
    """Every flow's balance at three moments, each carried on from the one before."""
    moves, kept, found = activity.player_moves(t), None, []
    for at in (datetime(1996, 1, 1), datetime(1998, 7, 1), PERIOD.end):
        kept = carry.carry(moves, at, before=kept, tz=TZ)
        for flow in (carry.CASH, carry.RELEASED, carry.BONUS):
            rows = kept.balance(flow).select("patron_id", "cents")
            found.append(rows.select(moment(at).alias("at"), F.lit(flow).alias("flow"), "patron_id", "cents"))
    return reduce(DataFrame.unionByName, found)


@query
def b28_carried_cash(t):
    """Opening and closing balance with a state of the period's start."""
    moves = activity.player_moves(t)
    start, end = carry.carried_cash(carry.carry(moves, PERIOD.start, tz=TZ), moves, _start_users(t), t.users)
    return start.withColumn("at", F.lit("start")).unionByName(end.withColumn("at", F.lit("end")))


@query
def b29_deposits(t):
    return balances.deposits(t.accounting, PERIOD, tz=TZ, state=ONTARIO)


@query
def b29_deposit_transactions(t):
    return alerts.deposit_transactions(t.accounting, t.users, tz=TZ)


@query
def b30_withdrawals(t):
    return balances.withdrawals(t.accounting, PERIOD, tz=TZ, state=ONTARIO)


@query
def b30_cancelled_withdrawals(t):
    return balances.cancelled_withdrawals(t.accounting, PERIOD, tz=TZ, state=ONTARIO)


@query
def b31_cash_adjustments(t):
    return balances.cash_adjustments(t.accounting, PERIOD, tz=TZ, state=ONTARIO)


@query
def b32_bonus_released(t):
    return balances.bonus_released(t.accounting, tz=TZ)


def _opening_bonus(t):
    return balances.opening_bonus(
        _start_users(t),
        t.bonus_transactions,
        balances.bonus_released(t.accounting, tz=TZ),
        t.user_award_bonus_cash,
        t.user_bonus_cash_transactions,
        PERIOD,
    )


def _closing_bonus(t):
    return balances.closing_bonus(
        t.users, t.bonus_transactions, balances.bonus_released(t.accounting, tz=TZ), PERIOD
    )


@query
def b33_opening_bonus(t):
    return _opening_bonus(t).groupBy("patron_id").agg(F.sum("cents").alias("cents"))


def _carried(t):
    return carry.carry(activity.player_moves(t), PERIOD.start, tz=TZ)


@query
def b33_carried_bonus(t):
    opening = carry.carried_opening_bonus(
        _carried(t), _start_users(t), t.user_award_bonus_cash, t.user_bonus_cash_transactions, PERIOD
    )
    return opening.groupBy("patron_id").agg(F.sum("cents").alias("cents"))


@query
def b34_carried_bonus(t):
    ended = carry.carry(activity.player_moves(t), PERIOD.end, before=_carried(t), tz=TZ)
    return carry.carried_closing_bonus(ended, t.users, PERIOD).groupBy("patron_id").agg(F.sum("cents").alias("cents"))


@query
def b33_late_unlocks(t):
    return balances.late_unlocks(t.user_award_bonus_cash, t.user_bonus_cash_transactions, PERIOD)


@query
def b34_closing_bonus(t):
    return _closing_bonus(t).groupBy("patron_id").agg(F.sum("cents").alias("cents"))


@query
def b35_bonus_adjustments(t):
    return balances.bonus_adjustments(
        _start_users(t),
        t.users,
        t.bonus_transactions,
        balances.bonus_released(t.accounting, tz=TZ),
        _closing_bonus(t),
        PERIOD,
    )


# --- sessions and activity --------------------------------------------------------------------


@query
def b36_player_sessions(t):
    tx = sessions.game_transactions(t.wager_and_game_info, t.patron_transactions, PERIOD)
    return sessions.session_summary(tx, "patron_id", "casino_session_id", PERIOD)


@query
def b36_event_sessions(t):
    tx = t.events.withColumn("session", F.col("ts").cast("date").cast("string"))
    return sessions.session_summary(tx, "user_id", "session", EVENTS, ts="ts")


@query
def b37_wager_counts(t):
    counts = sessions.wager_counts(
        [
            (bet_ops.free_bets_wagered(t.bets, PERIOD, tz=TZ), "bet_id", F.lit("betting"), 1),
            (bet_ops.voided(t.bets, PERIOD, tz=TZ), "bet_id", F.lit("betting"), -1),
            (casino.transfer_to_casino(t.accounting, t.wager_and_game_info, PERIOD, tz=TZ, game=["game_category"])
             .withColumnRenamed("game_category", "category"), "ref_id", "category", 1),
            (casino.casino_rollbacks(t.casino_wager_rollbacks, t.wager_and_game_info, PERIOD, tz=TZ,
                                     patron_transactions=t.patron_transactions), "ref_id", "category", -1),
        ]
    )
    split = sessions.bucketed()
    return counts.groupBy("patron_id").agg(
        F.sum("num_wagers").alias("num_wagers"),
        F.sum("cents").alias("wagered"),
        *[F.coalesce(F.sum(c), F.lit(0)).cast("bigint").alias(name) for name, c in split.items()],
    )


@query
def b38_last_activity(t):
    return balances.last_activity(t.accounting, PERIOD, state=ONTARIO)


@query
def b39_latest_attrs(t):
    return promos.free_wager_awards(
        t.user_award_free_bets, t.award_free_bets, t.user_award_free_wagers, t.award_free_wagers, tz=TZ
    )


@query
def b39_award_programmes(t):
    return promos.award_programmes(t.promotions, t.award_free_bets, t.award_free_wagers)


@query
def b39_latest_event_attrs(t):
    return latest_attrs(t.events, "user_id", "ts", ["event_type", "value"])


@query
def b40_free_round_lifecycle(t):
    return promos.free_round_lifecycle(
        t.wager_and_game_info,
        t.patron_transactions,
        t.casino_wagers,
        t.casino_payouts,
        t.casino_wager_rollbacks,
        _model(t),
        PERIOD,
    )


@query
def b41_settled_free_bets(t):
    return promos.settled_free_bets(t.bets)


@query
def b42_latest_settlement(t):
    used = t.lineitem.select("l_partkey", "l_suppkey", "l_shipdate", "l_returnflag", "l_quantity")
    return latest_settlement(used, ["l_partkey", "l_suppkey"], "l_shipdate").where(F.col("l_returnflag") != "R")


@query
def b43_game_metadata(t):
    return casino.game_metadata(t.casino_wagers).select(
        "patron_transaction_id", "game_name", "game_category", "game_provider"
    )


# --- filings ----------------------------------------------------------------------------------


def _product_sums(t):
    """Wagers, winnings and promotional winnings per brand, on the money scale of the filing."""
    rows = t.lineitem.join(t.part, F.col("l_partkey") == F.col("p_partkey"))
    cents = F.round(F.col("l_extendedprice") * 100).cast("bigint")
    sums = rows.groupBy("p_brand").agg(
        F.sum(F.when(F.col("l_linestatus") == "F", cents)).alias("_w"),
        F.sum(F.when((F.col("l_linestatus") == "O") & (F.col("l_returnflag") == "A"), cents)).alias("_p"),
        F.sum(F.when((F.col("l_linestatus") == "F") & (F.col("p_size") > 25), cents)).alias("_f"),
    )
    return sums.select(
        "p_brand",
        dollars("_w").alias("wagers"),
        dollars("_p").alias("winnings"),
        exact_dollars((F.col("_f") / 8).cast("bigint")).alias("free_bet_winnings"),
    )


@query
def b44_deduction_cap(t):
    return regulator.deduction_cap(_product_sums(t))


def _skeleton(t):
    """Every day and segment of the orders, and a product without any."""
    products = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY", "Poker"]
    return regulator.period_skeleton(
        t.orders.sparkSession, products, datetime(1995, 1, 1), days=2405, length=timedelta(days=1)
    )


@query
def b45_densify(t):
    rows = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
    facts = rows.groupBy(
        bucket("o_orderdate", "day").alias("gaming_day"), F.col("c_mktsegment").alias("product_code")
    ).agg(F.count(F.lit(1)).alias("orders"))
    return regulator.densify(facts, _skeleton(t), ["gaming_day", "product_code"]).select(
        "gaming_day", "product_code", "period_end", F.coalesce("orders", F.lit(0)).alias("orders")
    )


@query
def b46_report_ids(t):
    days = t.orders.select(bucket("o_orderdate", "day").alias("gaming_day")).distinct()
    skeleton = days.select(
        "gaming_day",
        F.col("gaming_day").alias("period_start"),
        (F.col("gaming_day") + F.make_dt_interval(F.lit(1))).alias("period_end"),
        F.lit("Casino").alias("product_code"),
    )
    ids = regulator.report_ids(skeleton, transaction_day_pattern="yyyyMMdd", transaction_day_back=1, prefix="E")
    return ids.select("gaming_day", "transaction_id", "ggr_file_name", "record_id", "transaction_date")


# --- monitoring -------------------------------------------------------------------------------

_ALERT_KEYS = ["transaction_period", "username", "patron_id"]


@query
def b47_threshold_alerts(t):
    return alerts.threshold_alerts(alerts.deposit_transactions(t.accounting, t.users, tz=TZ), _ALERT_KEYS)


@query
def b48_rolling_alerts(t):
    players = alerts.driver_counts(
        alerts.monthly_depositors(t.accounting, t.users, PERIOD, aml.DRIVER_ATTRS)
    )
    return alerts.rolling_alerts(t.accounting, players, PERIOD)


@query
def b49_bet_activity(t):
    return bet_ops.bet_activity(
        t.bets,
        [bucket(to_local("closed_at", TZ), "month").alias("transaction_period"), F.col("patron_id")],
        cash_excludes_free=True,
    )


@query
def b49_lifetime_activity(t):
    return bet_ops.bet_activity(
        t.bets, [F.col("patron_id")], cash_excludes_free=False, prefix="lt_", free_default=0
    )


@query
def b50_lifetime_withdrawals(t):
    return alerts.withdrawal_activity(t.accounting, tz=TZ, by_month=False, prefix="lt_")


@query
def b51_lifetime_deposits(t):
    return alerts.lifetime_deposits(t.accounting)


@query
def b52_payment_profile(t):
    return profiles.payment_profile(
        t.payment_deposits,
        t.payment_providers,
        t.payment_merchants,
        t.payment_customers,
        t.payment_users,
        t.users,
        tz=TZ,
    )


@query
def b53_player_ggr(t):
    ledger = t.accounting
    second = bucket("ts", "second").alias("ts")

    def per_second(rows):
        return rows.select(second, "patron_id", "bet_id", "cents")

    stack = revenue.sports_stack(
        per_second(cash_bets(_in_period(t), free_bet_ids(ledger), TZ)),
        per_second(bet_ops.voided(t.bets, PERIOD, tz=TZ)),
        per_second(resettlement_rollup(resettlement(ledger, t.bet_states, PERIOD, tz=TZ))),
        per_second(sports_payouts(_in_period(t), TZ)),
    )
    return revenue.player_ggr(stack, bet_and_market_info(t.bets, t.legs), None)


@query
def b54_enrich(t):
    driver = t.users.select("patron_id", "username")
    staked = bet_ops.bet_activity(t.bets, [F.col("patron_id")], cash_excludes_free=True)
    given = alerts.lifetime_deposits(t.accounting).drop("ranks")
    wide = profiles.enrich(
        driver, [(staked, ["patron_id"]), (given, ["patron_id"])], {"bets": 0, "free_bets": 0, "lt_deposits": 0}
    )
    return wide.select(
        "patron_id",
        "username",
        F.col("bets").cast("bigint").alias("bets"),
        F.col("free_bets").cast("bigint").alias("free_bets"),
        F.col("lt_deposits").cast("bigint").alias("lt_deposits"),
        profiles.ratio("settled_cash", "lt_deposit_cents").alias("settled_per_deposit"),
    )


@query
def b55_labels(t):
    as_of = F.lit(RUN_AT.date())
    people = t.users.join(t.addresses, F.col("patron_id") == F.col("user_id"), "left")
    return people.select(
        "patron_id",
        labels.account_designation("is_tester").alias("designation"),
        labels.gender_code("gender").alias("gender"),
        labels.age_years("birthdate", as_of).alias("age"),
        labels.postal_prefix("postal_code").alias("fsa"),
        labels.is_non_earning("employment_status").alias("non_earning"),
    )


@query
def b55_game_labels(t):
    games = t.games.select(
        labels.game_segment("category").alias("segment"),
        labels.provider_segment("game_provider_game_category").alias("provider_segment"),
    )
    legs = t.legs.select(
        labels.bet_type_a("num_legs").alias("segment"), labels.bet_type_b("num_live_legs", "num_legs").alias("provider_segment")
    )
    return games.unionByName(legs).groupBy("segment", "provider_segment").agg(F.count(F.lit(1)).alias("rows"))


@query
def b56_status_flags(t):
    players = t.users.select("patron_id")
    flagged = profiles.status_flags(players, t.break_status, "BreakStart", "BreakEnd", "BreakStatus")
    return profiles.status_flags(flagged, t.self_exclusion_status, "SEStart", "SEEnd", "SEStatus")


@query
def b57_account_sheet(t):
    ids = t.users.select(F.col("patron_id").alias("id"))
    return models.account_sheet(t, ids)


@query
def b58_bet_history(t):
    ids = t.users.select("patron_id")
    return models.bet_history(t, ids, PERIOD.end_utc)


@query
def b59_sports_detail(t):
    """Stack of the results detail before dimensions are joined."""
    return revenue.sports_stack(
        cash_bets(_in_period(t), free_bet_ids(t.accounting), TZ),
        bet_ops.voided(t.bets, PERIOD, tz=TZ),
        resettlement_rollup(resettlement(t.accounting, t.bet_states, PERIOD, tz=TZ)),
        sports_payouts(_in_period(t), TZ),
    )


@query
def b60_game_players(t):
    """Game rollup of the plain wager measures."""
    from tallybook.operators.measures import union_measures

    wagers = casino.transfer_to_casino(t.accounting, t.wager_and_game_info, PERIOD, tz=TZ, game=())
    cash = cash_bets(_in_period(t), free_bet_ids(t.accounting), TZ)
    nothing = F.lit(None).cast("string")
    stack = union_measures(
        [
            (wagers.withColumn("bet_id", nothing), {"num_wagers": F.lit(1), "wagers_game": "cents"}),
            (cash.withColumn("ref_id", nothing), {"num_wagers": F.lit(1), "wagers_game": "cents"}),
        ],
        ["ts", "patron_id", "bet_id", "ref_id"],
        revenue.GAME_MEASURES,
    )
    tx = sessions.game_transactions(t.wager_and_game_info, t.patron_transactions, PERIOD)
    return revenue.game_activity(
        stack,
        t.wager_and_game_info,
        bet_and_market_info(t.bets, t.legs),
        sessions.session_summary(tx, "game_id", "casino_session_id", PERIOD),
        t.games,
        real_players(t.users),
        PERIOD,
        regulator.SITE_ID,
    ).select(
        "ProductCode", "ProductSegment", "Game", "BetTypeA", "BetTypeB", "#ofGameSessions", "TotalGameplayDuration",
        "#ofUniquePlayers", "#ofWagers", "WagersGame",
    )


@query
def b61_casino_payouts(t):
    return casino.casino_payouts(t.accounting, t.casino_payouts, PERIOD, tz=TZ, cash_only=False, extra=["parent_id"])


@query
def b61_free_round_payouts(t):
    return casino.free_round_payouts(t.casino_payouts, t.patron_transactions, PERIOD, tz=TZ)


@query
def b61_game_payouts(t):
    return casino.game_payouts(
        t.wager_and_game_info, t.patron_transactions, t.casino_payouts, t.games, real_players(t.users), PERIOD
    )


@query
def b62_cash_rounds(t):
    rounds = casino.cash_rounds(t.casino_wagers, t.patron_transactions, real_players(t.users), PERIOD)
    return casino.by_game_day(rounds, tz=TZ)


# --- reports ----------------------------------------------------------------------------------


@query
def r01_results_detail(t):
    return finance.results_detail_with_jackpots(t, PERIOD)


@query
def r01_results_detail_indexed(t):
    return finance.results_detail_with_jackpots(t, PERIOD, free_index=_free_index(t))


@query
def r02_results_detail_plain(t):
    return finance.results_detail_without_jackpots(t, PERIOD)


@query
def r03_player_activity(t):
    before = t.bonus_transactions.where(PERIOD.started_utc("transaction_timestamp_utc"))
    return activity.player_activity(
        t, PERIOD, users_at_start=_start_users(t), bonus_at_start=before, run_at=RUN_AT
    )


@query
def r03_player_activity_carried(t):
    before = t.bonus_transactions.where(PERIOD.started_utc("transaction_timestamp_utc"))
    return activity.player_activity(
        t, PERIOD, users_at_start=_start_users(t), bonus_at_start=before, run_at=RUN_AT, carried=_carried(t)
    )


@query
def r04_game_activity(t):
    return activity.game_report(t, PERIOD)


@query
def r05_ggr_by_product(t):
    return finance.ggr_by_product(t, PERIOD, days=DAYS)


@query
def r05_ggr_by_product_indexed(t):
    return finance.ggr_by_product(t, PERIOD, days=DAYS, free_index=_free_index(t))


@query
def r06_casino_ggr(t):
    used = models.used_free_wagers(t, PERIOD, RUN_AT, model=models.stored_jackpots(t, PERIOD.end_utc))
    return finance.casino_ggr(t, PERIOD, used, days=DAYS)


@query
def r07_used_free_wagers(t):
    return models.used_free_wagers(t, PERIOD, RUN_AT)


@query
def r08_jackpots_from_history(t):
    return models.jackpots_from_history(t, PERIOD.end_utc)


@query
def r08_jackpots_from_current(t):
    return models.jackpots_from_current(t, PERIOD.end_utc)


@query
def r09_bet_and_market(t):
    return models.bet_and_market_info(t)


@query
def r10_high_value_deposits(t):
    return aml.high_value_deposits(t, PERIOD)


@query
def r11_non_earning_occupation(t):
    return aml.non_earning_occupation(t, PERIOD)


@query
def r12_non_earning_rolling(t):
    return aml.non_earning_occupation(t, PERIOD, rolling=True)


@query
def r13_account_sheet(t):
    return models.account_sheet(t, _listed(t))


@query
def r14_bet_history(t):
    return models.bet_history(t, _listed(t), PERIOD.end_utc)
