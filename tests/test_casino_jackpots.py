from datetime import datetime
from decimal import Decimal

from conftest import at, collected, ledger, table
from pyspark.sql import functions as F

from tallybook.functions.periods import TORONTO, ReportWindow
from tallybook.operators import casino, jackpots
from tallybook.operators.markets import bet_and_market_info
from tallybook.plans import models
from tallybook.sources.catalog import Catalog

WINDOW = ReportWindow.month(2023, 1)
NOON = datetime(2023, 1, 10, 12)


def model(spark, links, amount=1000):
    wallet = table(
        spark, "wallet_transactions", [{"id": "w", "amount": amount, "remote_wallet_transaction_id": "t"}]
    )
    rows = [
        {"wallet_transaction_id": "w", "jackpot_id": j, "type": kind, "amount_units": units, "amount_nanos": nanos}
        for j, kind, units, nanos in links
    ]
    names = table(spark, "jackpots", [{"id": "j1", "display_name": "one"}, {"id": "j2", "display_name": "two"}])
    return jackpots.jackpot_model(wallet, table(spark, "wallet_transaction_jackpots", rows), names)


def test_contribution_carries_no_wallet_amount(spark):
    row = model(spark, [("j1", "contribution", 0, 123)]).first()
    assert row["amount_precision"] == Decimal("0.000000123") and row["wallet_amount"] == 0
    assert row["casino_payout_normal"] == 0
    assert row["casino_payout_precise"] == Decimal("-0.000000123")


def test_residual_below_a_cent_is_dropped_and_a_cent_is_kept(spark):
    small = model(spark, [("j1", "win", 9, 991_000_000)]).first()
    assert small["casino_payout_precise"] == Decimal("0.009") and small["casino_payout_normal"] == 0
    cent = model(spark, [("j1", "win", 9, 990_000_000)]).first()
    assert cent["casino_payout_normal"] == Decimal("0.01")


def test_each_jackpot_of_a_transaction_stands_alone(spark):
    rows = model(spark, [("j1", "win", 4, 0), ("j2", "win", 5, 0)])
    assert collected(rows, "jackpot_id", "casino_payout_precise") == [("j1", Decimal(6)), ("j2", Decimal(5))]


def test_link_without_a_named_jackpot_is_dropped(spark):
    assert model(spark, [("nameless", "win", 4, 0)]).count() == 0


def test_equal_wins_of_one_transaction_count_once(spark):
    rows = model(spark, [("j1", "win", 4, 0), ("j2", "win", 4, 0)])
    paid = spark.createDataFrame([("t", NOON, "p")], "ref_id string, ts timestamp_ntz, patron_id string")
    won = jackpots.jackpot_payouts(paid, rows, ["ts", "patron_id", "ref_id"], free=None)
    assert collected(won, "amount") == [(Decimal(4),)]
    made = jackpots.jackpot_contributions(paid, model(spark, [("j1", "contribution", 1, 0)]), ["patron_id"])
    net = jackpots.net_adjustments(made, won, ["patron_id"])
    assert collected(net) == [("p", Decimal(-3))]


def test_model_of_reports_has_the_rows_of_the_whole_model(spark):
    # equal clocks: all three versions stay, and only what reports don't read tells two of them apart
    versions = [
        {"game_provider": "a", "game_session_id": None},
        {"game_provider": None, "game_session_id": "a"},
        {"game_provider": None, "game_session_id": "a"},
    ]
    wallet = table(
        spark, "wallet_transactions", [{"id": "w", "amount": 100, "remote_wallet_transaction_id": "t", "_changed_at": NOON, "updated_at": NOON, **v} for v in versions]
    )
    link = {"wallet_transaction_id": "w", "jackpot_id": "j1", "type": "win", "amount_units": 1, "amount_nanos": 0, "_changed_at": NOON, "updated_at": NOON}
    tables = Catalog.of(
        wallet_transactions=wallet,
        wallet_transaction_jackpots=table(spark, "wallet_transaction_jackpots", [link]),
        jackpots=table(spark, "jackpots", [{"id": "j1", "display_name": "one", "_changed_at": NOON, "updated_at": NOON}]),
    )
    whole = models.jackpots_from_history(tables, WINDOW.end_utc)
    stored = models.stored_jackpots(tables, WINDOW.end_utc)
    assert set(whole.columns) - set(stored.columns) == set(jackpots.WALLET_ATTRS) - set(jackpots.REPORT_ATTRS)
    assert collected(stored) == collected(whole, *stored.columns) and stored.count() == 2


def test_payouts_meet_their_players_after_the_joins_that_cut_them(spark):
    wagers = info(spark, {"patron_transaction_id": "t", "patron_id": "p", "game_id": "g", "amount_cents": 7})
    clocks = table(spark, "patron_transactions", [{"id": "t", "patron_id": "p", "_changed_at": NOON}])
    payouts = table(spark, "casino_payouts", [{"patron_transaction_id": "t", "gaming_state": "CA-ON"}])
    games = table(spark, "games", [{"id": "g", "name": "n", "game_provider": "v", "category": "c"}])
    players = table(spark, "users", [{"patron_id": "p"}, {"patron_id": "p"}]).select("patron_id")
    paid = casino.game_payouts(wagers, clocks, payouts, games, players, WINDOW)
    assert collected(paid, "ref_id", "cents") == [("t", 7)]
    plan = paid._jdf.queryExecution().optimizedPlan().toString()
    assert "LeftSemi" not in plan


def info(spark, *rows):
    return table(spark, "wager_and_game_info", list(rows), patron_id="p", amount_cents=50)


def test_rollbacks_take_their_time_from_either_table(spark):
    rollbacks = table(spark, "casino_wager_rollbacks", [{"patron_transaction_id": t, "_changed_at": NOON} for t in "abc"])
    clocks = table(spark, "patron_transactions", [{"id": "a", "_changed_at": at("2023-01-11")}, {"id": "b", "_changed_at": at("2023-03-01")}])
    games = info(
        spark,
        {"patron_transaction_id": "a", "type": "rollback"},
        {"patron_transaction_id": "b", "type": "rollback", "promo_engine_free_round_award_id": "f"},
        {"patron_transaction_id": "c", "type": "payout"},
    )
    timed = casino.casino_rollbacks(rollbacks, games, WINDOW, tz=TORONTO, patron_transactions=clocks)
    assert collected(timed, "ref_id", "is_promo", "cents") == [("a", False, 50)]
    own = casino.casino_rollbacks(rollbacks, games, WINDOW, tz=TORONTO)
    assert collected(own, "ref_id", "is_promo") == [("a", False), ("b", True)]


def test_casino_wager_without_game_stays(spark):
    wager = {"p_type": "casino_wager", "p_id": "c1"}
    rows = ledger(
        spark, {**wager, "debit_cents": 40}, {**wager, "credit_cents": 40, "a_type": "casino_house_wins"}
    )
    got = casino.transfer_to_casino(rows, info(spark), WINDOW, tz=TORONTO)
    assert collected(got, "ref_id", "game_category", "cents") == [("c1", None, 40)]


def test_payouts_leave_out_or_label_free_rounds(spark):
    paid = {"p_type": "casino_payout", "credit_cents": 30}
    rows = ledger(spark, {**paid, "patron_transaction_id": "a", "p_id": "a"}, {**paid, "patron_transaction_id": "b", "p_id": "b"})
    payouts = table(spark, "casino_payouts", [{"patron_transaction_id": "b", "promo_engine_free_round_award_id": "f", "amount_cents": 30}])
    cash = casino.casino_payouts(rows, payouts, WINDOW, tz=TORONTO)
    assert collected(cash, "ref_id") == [("a",)]
    both = casino.casino_payouts(rows, payouts, WINDOW, tz=TORONTO, cash_only=False)
    assert collected(both, "ref_id", "award_id") == [("a", None), ("b", "f")]


def test_game_metadata_strips_the_suffix(spark):
    wagers = table(spark, "casino_wagers", [{"patron_transaction_id": "a", "metadata": '{"game_name": "Reels_R3", "game_category": "slots"}'}])
    assert collected(casino.game_metadata(wagers), "game_name", "game_category", "game_provider") == [("Reels", "slots", None)]


EVENT = r"""{"name": "Home \| Away", "start_time": "2023-01-05 19:30:00", "sport": "{\"name\": \"ice hockey\"}",
             "competition": "{\"name\": \"league \\\| one\"}"}"""


def test_market_dimension(spark):
    bets = table(
        spark,
        "bets",
        [{"id": "s", "type": "straight"}, {"id": "bare", "type": "straight"}, {"id": "p", "type": "parlay"}, {"id": "x", "type": "teaser"}],
    )
    leg = {"market": r'{"name": "Moneyline \| 60"}', "market_classification": "game_prop", "event": EVENT, "num_legs": 1}
    legs = table(
        spark,
        "legs",
        [
            {**leg, "vegas_bet_id": "s", "num_live_legs": 0},
            {"vegas_bet_id": "p", "num_legs": 3, "num_live_legs": 0},
            {"vegas_bet_id": "p", "num_legs": 2, "num_live_legs": 1},
        ],
    )
    rows = {r["bet_id"]: r for r in bet_and_market_info(bets, legs).collect()}
    assert set(rows) == {"s", None, "p"}
    s = rows["s"]
    assert (s["market_type"], s["bet_type"], s["event_type"]) == ("Moneyline | 60", "Future Wager", "Ice Hockey")
    assert (s["event_description"], s["event_timestamp"]) == ("Home | Away", at("2023-01-05 19:30:00"))
    assert s["league"] == "LEAGUE | ONE"
    assert (rows["p"]["league"], rows["p"]["num_legs"], rows["p"]["num_live_legs"]) == ("parlay", 3, 1)
    assert rows[None]["market_type"] is None


def test_unreadable_event_time_is_missing(spark):
    bets = table(spark, "bets", [{"id": "s", "type": "straight"}])
    legs = table(spark, "legs", [{"vegas_bet_id": "s", "event": '{"start_time": "later"}'}])
    assert bet_and_market_info(bets, legs).select(F.col("event_timestamp")).first()[0] is None
