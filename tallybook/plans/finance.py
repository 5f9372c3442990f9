"""Finance reports: results detail (R01, R02), GGR by product (R05), casino GGR."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallybook.functions.money import DOLLARS, EXACT, dollars, exact_sum
from tallybook.functions.periods import ReportWindow, bucket, in_window, to_local
from tallybook.lineage import compute_once, drop
from tallybook.operators import bets as bet_ops
from tallybook.operators import casino, jackpots, regulator, revenue
from tallybook.operators.cuts import flow_postings
from tallybook.operators.free_bets import FreeBetIndex
from tallybook.operators.ledger import (
    CASINO_ROLLBACKS_BY_ID,
    CASINO_WAGERS,
    CUSTOMER_LIABILITY,
    ONTARIO,
    SPORTS_BETS,
    SPORTS_BETS_BY_TX_TYPE,
    SPORTS_PAYOUT_TYPES,
    LegPair,
    as_moves,
    bet_id,
    exclude,
    free_bet_ids,
    in_state,
    matched,
    on_customer,
    real_players,
)
from tallybook.operators.markets import bet_and_market_info
from tallybook.operators.measures import stack_in_parts, stack_measures
from tallybook.operators.settlement import (
    RESETTLEMENT_TYPES,
    first_settlement,
    resettlement,
    union_transfers,
)
from tallybook.operators.snapshots import latest_settlement
from tallybook.plans.models import stored_jackpots
from tallybook.sources.catalog import Catalog


def cash_bets(
    ledger: DataFrame, free: DataFrame, tz: str, pair=SPORTS_BETS, *, credits: DataFrame | None = None, summed: bool = True
) -> DataFrame:
    """Matched stakes of bets outside the free-bet set, per (ts, player, bet).

    ``credits`` is the ledger the credit legs come from where only the debit legs are cut, to a window
    or to players. This and the other flows with ``summed`` off give rows for a stack to add up, and have no
    shuffle of their own for it.
    """

    def staked(rows: DataFrame) -> DataFrame:
        rows = rows.where(F.col(pair.type_column).isin(*pair.types)).withColumn("_bet", bet_id())
        return exclude(rows, free, "_bet", "bet_id").drop("_bet")

    by = [to_local("posted_at", tz).alias("ts"), "patron_id", F.col("ref_id").alias("bet_id")]
    return matched(staked(ledger), pair, by, credits=None if credits is None else staked(credits), summed=summed)


def sports_payouts(ledger: DataFrame, tz: str, p_types=SPORTS_PAYOUT_TYPES, *, summed: bool = True) -> DataFrame:
    """Cash-outs, payouts and lost bets on the customer side, per (ts, player, bet)."""
    rows = as_moves(ledger.where(on_customer(*p_types)), bet_id().alias("bet_id"), tz=tz)
    return rows.groupBy("ts", "patron_id", "bet_id").agg(F.sum("cents").alias("cents")) if summed else rows


def _stated(rows: DataFrame, *, state: str | None = ONTARIO, wager: str = "ref_id") -> DataFrame:
    if state is not None:
        rows = rows.withColumn("gaming_state", F.lit(state))
    return rows.withColumn("wager_id", F.col(wager))


def _free_in(rows: DataFrame, ledger: DataFrame, index: FreeBetIndex | None) -> DataFrame:
    """Ids of free bets that matter for some stored postings."""
    if index is None:
        return free_bet_ids(ledger)
    return index.among(rows.where(F.col("p_type").isin(*SPORTS_BETS.types)).select(bet_id().alias("_bet")), "_bet", ledger=ledger)


#: Columns that the flows choose and add up postings by.
_POSTING = ("a_patron_id", "a_type", "p_type", "t_type", "gaming_state", "debit_cents", "credit_cents", "t_changed_at")


def stored_window(
    ledger: DataFrame, window: ReportWindow, bets: LegPair, casino_pairs: Sequence[LegPair], state: str | None = None,
    also: Sequence[str] = (), of_payouts: Sequence[str] = (),
) -> DataFrame:
    """What the flows read of the window's postings, read from the ledger once and stored; every flow branches from there.

    The flows are the matched legs of ``bets`` and of the ``casino_pairs``, what sports bets and casino rounds pay,
    and resettlements. ``also`` are further columns, ``of_payouts`` ids read of casino payouts.
    """

    def legs(*pairs: LegPair) -> Column:
        sides = [(pair, side) for pair in pairs for side in ("debit", "credit")]
        return reduce(Column.__or__, [pair.is_leg(side) & (F.col(f"{side}_cents") > 0) for pair, side in sides])

    resettled = F.col("p_type").isin(*RESETTLEMENT_TYPES)
    paid = (F.col("p_type") == "casino_payout") & (F.col("a_type") == CUSTOMER_LIABILITY)
    of_bet = on_customer(*SPORTS_PAYOUT_TYPES) | resettled | legs(bets)
    ids = {
        "ledger_transaction_id": legs(bets, *casino_pairs),
        "patron_transaction_id": paid,
        "p_id": paid | legs(*casino_pairs),
        **{c: paid for c in of_payouts},
        "bet_history_id": resettled,
        "p_bet_id": of_bet,
        "p_vegas_bet_id": of_bet,
    }
    return flow_postings(in_state(in_window(ledger, "t_changed_at", window), state), ids, F.lit(False), [*_POSTING, *also])


def results_detail_with_jackpots(
    tables: Catalog, window: ReportWindow, *, free_index: FreeBetIndex | None = None, ordered: bool = False
) -> DataFrame:
    """Results detail with jackpot contributions and wins.

    With ``free_index`` the ids of free bets come from it and from the ledger since; otherwise from all history.
    """
    tz = window.tz
    ledger = stored_window(tables.accounting, window, SPORTS_BETS, [CASINO_WAGERS], of_payouts=["parent_id"])
    model = stored_jackpots(tables, window.end_utc)

    free = _free_in(ledger, tables.accounting, free_index)
    sports = compute_once(revenue.sports_stack(
        union_transfers(
            cash_bets(ledger, free, tz, summed=False),
            bet_ops.free_bets_wagered(tables.bets, window, tz=tz, summed=False),
        ),
        bet_ops.voided(tables.bets, window, tz=tz, summed=False),
        resettlement(ledger, tables.bet_states, window, tz=tz),
        union_transfers(
            sports_payouts(ledger, tz, summed=False),
            first_settlement(ledger, tables.bet_states, window, tz=tz, state=ONTARIO, summed=False),
        ),
    ))

    # read twice: as they are, and for their jackpots
    wagers = compute_once(
        casino.transfer_to_casino(ledger, tables.wager_and_game_info, window, tz=tz, extra=["gaming_state"], game=())
    )
    free_rounds = casino.free_rounds_wagered(tables.casino_wagers, tables.patron_transactions, window, tz=tz)
    undone = casino.casino_rollbacks(
        tables.casino_wager_rollbacks,
        tables.wager_and_game_info,
        window,
        tz=tz,
        patron_transactions=tables.patron_transactions,
    )
    paid = compute_once(
        casino.casino_payouts(
            ledger, tables.casino_payouts, window, tz=tz, cash_only=False, extra=["gaming_state", "parent_id"]
        )
    )
    drop(ledger)
    contributions = jackpots.jackpot_contributions(
        wagers, model, ["ref_id", "ts", "patron_id", "gaming_state", "jackpot_award_id"]
    )
    wins = jackpots.jackpot_payouts(
        paid, model, ["gaming_state", "ts", "patron_id", "ref_id", "award_id"], free=None
    )
    spins = compute_once(revenue.casino_stack(
        _stated(wagers),
        _stated(free_rounds),
        _stated(undone),
        _stated(paid, state=None, wager="parent_id"),
        _stated(contributions, state=None),
        _stated(wins, state=None),
    ))
    drop(wagers, paid)
    return revenue.results_detail(
        sports,
        bet_and_market_info(tables.bets, tables.legs),
        spins,
        tables.wager_and_game_info,
        tables.users,
        window,
        jackpots=True,
        ordered=ordered,
    )


def results_detail_without_jackpots(
    tables: Catalog,
    window: ReportWindow,
    *,
    free_bets: DataFrame | None = None,
    free_index: FreeBetIndex | None = None,
    free_bets_wagered: DataFrame | None = None,
    resettled: DataFrame | None = None,
    free_rounds: DataFrame | None = None,
    free_rounds_rolled_back: DataFrame | None = None,
    later_states: DataFrame | None = None,
    ordered: bool = False,
) -> DataFrame:
    """Results detail before jackpots.

    The promotion and resettlement models are inputs of this report; those not given are made
    by the same operators, the ids of free bets with ``free_index`` where that is given. Cash rollbacks take the rollback's own time.
    """
    tz = window.tz
    ledger = stored_window(tables.accounting, window, SPORTS_BETS, [CASINO_WAGERS], of_payouts=["parent_id"])
    free = free_bets if free_bets is not None else _free_in(ledger, tables.accounting, free_index)
    if free_bets_wagered is None:
        free_bets_wagered = bet_ops.free_bets_wagered(tables.bets, window, tz=tz, summed=False)
    if resettled is None:
        resettled = resettlement(ledger, tables.bet_states, window, tz=tz)
    if free_rounds is None:
        free_rounds = casino.free_rounds_wagered(tables.casino_wagers, tables.patron_transactions, window, tz=tz)
    rollback = dict(window=window, tz=tz)
    if free_rounds_rolled_back is None:
        free_rounds_rolled_back = casino.casino_rollbacks(
            tables.casino_wager_rollbacks,
            tables.wager_and_game_info,
            patron_transactions=tables.patron_transactions,
            promo=True,
            **rollback,
        )
    sports = compute_once(revenue.sports_stack(
        union_transfers(cash_bets(ledger, free, tz, summed=False), free_bets_wagered),
        bet_ops.voided(tables.bets, window, tz=tz, summed=False),
        resettled,
        union_transfers(
            sports_payouts(ledger, tz, summed=False),
            first_settlement(
                ledger, tables.bet_states, window, tz=tz, state=ONTARIO, later_states=later_states, summed=False
            ),
        ),
    ))
    undone = casino.casino_rollbacks(
        tables.casino_wager_rollbacks, tables.wager_and_game_info, promo=False, **rollback
    ).unionByName(free_rounds_rolled_back)
    paid = casino.casino_payouts(
        ledger,
        tables.casino_payouts,
        window,
        tz=tz,
        cash_only=False,
        extra=["gaming_state", "parent_id"],
    )
    wagers = casino.transfer_to_casino(ledger, tables.wager_and_game_info, window, tz=tz, game=())
    spins = compute_once(revenue.casino_stack(
        _stated(wagers), _stated(free_rounds), _stated(undone), _stated(paid, state=None, wager="parent_id")
    ))
    drop(ledger)
    return revenue.results_detail(
        sports,
        bet_and_market_info(tables.bets, tables.legs),
        spins,
        tables.wager_and_game_info,
        tables.users,
        window,
        jackpots=False,
        ordered=ordered,
    )


def _day(ts: str = "ts"):
    return bucket(ts, "day").alias("gaming_day")


def _of_players(frame: DataFrame, players: DataFrame, key: str) -> DataFrame:
    return frame.join(players, frame[key] == players["patron_id"], "left_semi")


def ggr_by_product(
    tables: Catalog, window: ReportWindow, *, days: int = 1, free_index: FreeBetIndex | None = None
) -> DataFrame:
    """Gross gaming revenue per gaming day and product.

    A filing names the first day of the window only; ``days`` gives as many daily filings. The
    period's end is stamped with its start. Facts of other days are cut at the scan, since the
    skeleton would drop them anyway.
    """
    tz = window.tz
    filed = ReportWindow(window.start, window.start + timedelta(days=days), tz)
    players = real_players(tables.users)
    ledger = stored_window(
        tables.accounting, filed, SPORTS_BETS_BY_TX_TYPE, [CASINO_WAGERS, CASINO_ROLLBACKS_BY_ID], ONTARIO, also=["p_patron_id"]
    )
    by_account = _of_players(ledger, players, "a_patron_id")
    by_player = _of_players(ledger, players, "p_patron_id")

    if free_index is None:
        free = free_bet_ids(_of_players(in_state(tables.accounting, ONTARIO), players, "a_patron_id"))
    else:
        free = free_index.bets(tables.accounting, state=ONTARIO, players=players)
    free = compute_once(free)
    free_bets = _of_players(tables.bets.where(bet_ops.is_free()), players, "patron_id").select(
        F.col("id").alias("bet_id")
    )

    resettled = resettlement(by_account, tables.bet_states, window, tz=tz).where(F.col("promo_id").isNull())
    voids = bet_ops.voided_by_day(_of_players(tables.bets, players, "patron_id"), filed, tz=tz)
    # only the debit's day counts; its credit may be posted in another one
    any_day = _of_players(in_state(tables.accounting, ONTARIO), players, "p_patron_id")
    placed = cash_bets(by_player, free, tz, SPORTS_BETS_BY_TX_TYPE, credits=any_day, summed=False)
    paid_rows = exclude(by_player.withColumn("_bet", bet_id()), free_bets, "_bet", "bet_id").drop("_bet")
    # of the two settlement branches the first checks the posting's player, the second its account
    settled_first = first_settlement(by_player, tables.bet_states, window, tz=tz, summed=False).where("is_first")
    settled_later = first_settlement(by_account, tables.bet_states, window, tz=tz, summed=False).where("not is_first")
    paid = union_transfers(sports_payouts(paid_rows, tz, summed=False), settled_first, settled_later)

    in_report = ReportWindow(window.start, min(window.end, filed.end), tz)
    wagers = casino.transfer_to_casino(ledger, tables.wager_and_game_info, in_report, tz=tz, game=())
    # read twice: as they are, and for their jackpots
    wagers = compute_once(_of_players(wagers, players, "patron_id"))
    payouts = compute_once(casino.casino_payouts(by_player, tables.casino_payouts, in_report, tz=tz))
    undone = matched(
        by_player, CASINO_ROLLBACKS_BY_ID, [to_local("posted_at", tz).alias("ts")], credits=any_day, summed=False
    )

    model = stored_jackpots(tables, window.end_utc)
    named = tables.wager_and_game_info.select(F.col("patron_transaction_id").alias("ref_id"), "game_name")
    contributed = wagers.join(jackpots.of_type(model, "contribution"), "ref_id").join(named, "ref_id", "left")
    won = payouts.join(jackpots.of_type(model, "win", free=False), "ref_id").join(named, "ref_id", "left")
    net = jackpots.net_adjustments(
        contributed.select(_day(), "game_name", F.col("amount_precision").alias("amount")),
        won.select(_day(), "game_name", F.col("amount_precision").alias("amount")),
        ["gaming_day", "game_name"],
    )

    def of(frame: DataFrame, product: str) -> DataFrame:
        frame = frame if "gaming_day" in frame.columns else frame.withColumn("gaming_day", bucket("ts", "day"))
        return frame.withColumn("product_code", F.lit(product))

    facts = stack_in_parts(
        [
            [
                (of(resettled, "Betting"), {"winnings": -F.col("cents")}),
                (of(voids, "Betting"), {"wagers": -F.col("cents")}),
            ],
            [(of(placed, "Betting"), {"wagers": "cents"})],
            [(of(paid, "Betting"), {"winnings": "cents"})],
            [
                (of(payouts, "Casino"), {"winnings": "cents"}),
                (of(wagers, "Casino"), {"wagers": "cents"}),
                (of(net, "Casino"), {"jackpot": F.col("amount").cast("decimal(28,2)")}),
            ],
            [(of(undone, "Casino"), {"wagers": -F.col("cents")})],
        ],
        ["gaming_day", "product_code"],
        {"wagers": "bigint", "winnings": "bigint", "jackpot": DOLLARS},
    )
    drop(ledger, free, wagers, payouts)
    spark = tables.accounting.sparkSession
    skeleton = regulator.report_ids(
        regulator.period_skeleton(spark, ["Betting", "Casino"], window.start, days=days)
    )
    filing = regulator.densify(facts, skeleton, ["gaming_day", "product_code"])
    zero = F.lit(0)
    placed_total = dollars(F.coalesce("wagers", zero))
    won_total = (dollars(F.coalesce("winnings", zero)) + F.coalesce("jackpot", zero)).cast(DOLLARS)
    return filing.select(
        F.col("transaction_id").alias("TransactionID"),
        F.date_format("transaction_date", "yyyyMMdd").alias("TransactionDate"),
        F.col("igo_operator_id").alias("iGOOperatorID"),
        F.col("gaming_site_id").alias("GamingSiteID"),
        F.date_format("period_start", "yyyyMMdd").alias("PeriodStart"),
        F.date_format("period_end", "yyyyMMdd").alias("PeriodEnd"),
        F.date_format("gaming_day", "yyyyMMdd").alias("GamingDay"),
        F.col("product_code").alias("ProductCode"),
        (placed_total - won_total).cast(DOLLARS).alias("GGR"),
        placed_total.alias("Wagers"),
        won_total.alias("Winnings"),
        zero.cast(DOLLARS).alias("EligibleDeductions"),
        F.col("file_version").alias("FileVersion"),
    )


def casino_ggr(tables: Catalog, window: ReportWindow, used: DataFrame, *, days: int | None = None) -> DataFrame:
    """Casino GGR per game with the capped deduction for free-round winnings.

    ``used`` is the output of the used-free-wagers report. The filing covers the window's first
    gaming day; ``days`` gives as many daily filings, each with a period of one day.
    """
    tz = window.tz
    players = real_players(tables.users)
    game = ["game_provider", "game_category", "game_name"]

    latest = latest_settlement(used, ["Patron ID", "Wager ID"], "Settled Timestamp Toronto")
    kept = latest.where(
        (F.col("Outcome") != "rollback")
        & (F.col("Product") == "Casino")
        & (F.col("Payout Amount") != 0)
        & window.holds_local("Settled Timestamp Toronto")
    )
    kept = kept.join(players, kept["Patron ID"] == players["patron_id"], "left_semi")
    described = casino.game_metadata(tables.casino_wagers).select(
        F.col("patron_transaction_id").alias("Wager ID"),
        F.col("promo_engine_free_round_award_id").alias("Promo Free Wager ID"),
        *game,
    )
    promo = kept.join(described, ["Wager ID", "Promo Free Wager ID"]).select(
        bucket("Settled Timestamp Toronto", "day").alias("gaming_day"), *game, F.col("Payout Amount").alias("amount")
    )

    rounds = casino.cash_rounds(tables.casino_wagers, tables.patron_transactions, players, window)
    paid = casino.game_payouts(
        tables.wager_and_game_info,
        tables.patron_transactions,
        tables.casino_payouts,
        tables.games,
        players,
        window,
    )
    ledger = in_state(in_window(tables.accounting, "t_changed_at", window), ONTARIO)
    undone = casino.matched_rollbacks(
        _of_players(ledger, players, "p_patron_id"),
        by=[bucket(to_local("posted_at", tz), "day").alias("gaming_day"), "ref_id"],
        credits=_of_players(in_state(tables.accounting, ONTARIO), players, "p_patron_id"),
    )
    on_game = tables.rollback_payout_info.select(F.col("patron_transaction_id").alias("ref_id"), "game_id")
    catalogue = tables.games.select(
        F.col("id").alias("game_id"), F.col("name").alias("game_name"), "game_provider", F.col("category").alias("game_category")
    )
    undone = undone.join(on_game, "ref_id").join(catalogue, "game_id")

    model = stored_jackpots(tables, window.end_utc)

    def in_local_day(frame: DataFrame) -> DataFrame:
        return frame.withColumn("gaming_day", bucket(to_local("_changed_at", tz), "day"))

    def of_wager(kind: str, free: bool | None = None) -> DataFrame:
        return jackpots.of_type(model, kind, free=free).groupBy("ref_id").agg(exact_sum("amount_precision").alias("jackpot"))

    # a wager's and a payout's jackpots are added while they are together, so neither is worked out twice
    staked = in_local_day(rounds).join(of_wager("contribution"), "ref_id", "left")
    won = in_local_day(paid).join(of_wager("win", free=False), "ref_id", "left")
    played = stack_measures(
        [(staked, {"wagers": "cents", "jackpot": "jackpot"}), (won, {"winnings": "cents", "jackpot": -F.col("jackpot")})],
        ["gaming_day", *game],
        {"wagers": "bigint", "winnings": "bigint", "jackpot": EXACT},
    )

    def of(frame: DataFrame) -> DataFrame:
        return frame.withColumn("game_name", casino.strip_game_suffix(F.col("game_name")))

    facts = stack_measures(
        [
            (of(promo), {"free_bet_winnings": "amount"}),
            (of(undone), {"wagers": -F.col("cents")}),
            (of(played), {"wagers": "wagers", "winnings": "winnings", "jackpot": F.col("jackpot").cast("decimal(28,2)")}),
        ],
        ["gaming_day", *game],
        {"wagers": "bigint", "winnings": "bigint", "jackpot": DOLLARS, "free_bet_winnings": EXACT},
    )
    facts = facts.select(
        "gaming_day",
        *game,
        dollars("wagers").alias("wagers"),
        (dollars("winnings") + F.col("jackpot")).cast(DOLLARS).alias("winnings"),
        "free_bet_winnings",
    )
    length = timedelta(days=1) if days is not None else window.end - window.start
    skeleton = regulator.report_ids(
        regulator.period_skeleton(
            tables.accounting.sparkSession, ["Casino"], window.start, days=days or 1, length=length
        ),
        transaction_day_pattern="yyyyMMdd",
        transaction_day_back=1,
        prefix="E",
    )
    filing = regulator.deduction_cap(regulator.densify(facts, skeleton, ["gaming_day"]))
    last_day = F.col("period_end") - F.make_dt_interval(F.lit(1))
    return filing.select(
        "transaction_id",
        F.date_format("transaction_date", "yyyyMMdd").alias("transaction_date"),
        "igo_operator_id",
        "gaming_site_id",
        F.date_format("period_start", "yyyyMMdd").alias("period_start"),
        F.date_format(last_day, "yyyyMMdd").alias("period_end"),
        F.date_format("gaming_day", "yyyyMMdd").alias("gaming_day"),
        "product_code",
        *game,
        "wagers",
        "winnings",
        "free_bet_winnings",
        "ed_cap",
        "eligible_deductions",
        "file_version",
    )
