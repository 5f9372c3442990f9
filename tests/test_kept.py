"""What is kept between reports, and counts that repeated rows must not change."""

from datetime import datetime, timedelta

import pytest
from conftest import at, collected, ledger, table
from pyspark.sql import functions as F

from tallybook.functions.periods import TORONTO
from tallybook.operators import casino, free_bets, ledger as L, profiles, sessions
from tallybook.operators.measures import stack_measures
from tallybook.sources.catalog import Catalog

JAN, FEB, MAR = datetime(2023, 1, 1), datetime(2023, 2, 1), datetime(2023, 3, 1)


def free(bet, when, **more):
    return {"p_type": "sportsbook_free_bet", "p_bet_id": bet, "t_changed_at": at(when), **more}


POSTED = [
    free("a", "2022-12-01 12:00"),
    free("a", "2022-12-02 12:00"),
    free("b", "2023-01-15 12:00", gaming_state=None),
    free("c", "2023-02-10 12:00", a_patron_id="p2", p_vegas_bet_id="v"),
    free(None, "2023-01-15 12:00"),
    {"p_bet_id": "cash", "t_changed_at": at("2023-01-15 12:00")},
]


def ids(index, *args, **kwargs):
    return collected(index.bets(*args, **kwargs))


def test_refreshed_index_is_the_set_of_the_ledger(spark):
    rows = ledger(spark, *POSTED)
    index, first = free_bets.refresh(rows, JAN)
    assert collected(first, "bet_id") == [("a",)]
    index, second = free_bets.refresh(rows, FEB, index)
    assert collected(second, "bet_id") == [("b",), (None,)]
    assert ids(index) == [("a",), ("b",), (None,)]
    assert ids(index, rows) == collected(L.free_bet_ids(rows)) == [("a",), ("b",), ("v",), (None,)]
    assert ids(index, rows, state="CA-ON") == [("a",), ("v",), (None,)]
    assert ids(index, rows, players=table(spark, "users", [{"patron_id": "p2"}])) == [("v",)]
    with pytest.raises(ValueError):
        free_bets.refresh(rows, JAN, index)


def test_refresh_reads_only_its_time_and_the_grace(spark):
    index, _ = free_bets.refresh(ledger(spark, *POSTED), FEB)
    late, closed = free("late", "2023-01-28 12:00"), free("closed", "2023-01-02 12:00")
    index, new = free_bets.refresh(ledger(spark, *POSTED, late, closed), MAR, index)
    assert collected(new, "bet_id") == [("late",), ("v",)]


def test_index_is_kept_by_what_was_added(spark, tmp_path):
    folder, rows = str(tmp_path / "index"), ledger(spark, *POSTED)
    assert free_bets.load(spark, folder) is None
    index, new = free_bets.refresh(rows, FEB, grace=timedelta(days=3))
    free_bets.save(index, new, folder)
    found = free_bets.load(spark, folder)
    assert (found.upto, found.grace) == (FEB, timedelta(days=3))
    index, new = free_bets.refresh(rows, MAR, found)
    free_bets.save(index, new, folder)
    assert ids(free_bets.load(spark, folder)) == ids(index) == [("a",), ("b",), ("v",), (None,)]


def test_free_bets_among_some_rows(spark):
    rows = ledger(spark, *POSTED)
    index, _ = free_bets.refresh(rows, JAN)
    asked = spark.createDataFrame([("a",), ("a",), ("v",), ("cash",), (None,)], "bet string")
    assert collected(index.among(asked, "bet", ledger=rows)) == [("a",), ("v",)]


def test_a_doubled_game_row_counts_a_wager_once(spark):
    game = {"patron_transaction_id": "t", "game_category": "slots"}
    games = table(spark, "wager_and_game_info", [game, game, {"patron_transaction_id": "u"}, {"patron_transaction_id": None}])
    wagers = spark.createDataFrame(
        [("t", at("2023-01-10"), "p", 500), ("u", at("2023-01-10"), "p", 7), ("none", at("2023-01-10"), "p", 1), (None, at("2023-01-10"), "p", 2)],
        "ref_id string, ts timestamp_ntz, patron_id string, cents long",
    )
    rows = casino.with_game(wagers, games, ["game_category"]).withColumnRenamed("game_category", "category")
    measures = {"num_wagers": "bigint", "wagers_slots": "bigint", "wagers_other": "bigint"}
    given = {k: v for k, v in sessions.signed_wagers("ref_id", 1, F.col("category")).items() if k in measures}
    # amounts are those of the plain join, ids are counted once
    assert collected(stack_measures([(rows, given)], ["patron_id"], measures)) == [("p", 3, 1000, 0)]


def test_a_player_with_very_many_cards_is_counted_exactly(spark):
    n = 20_000
    deposits = spark.range(n).select(
        F.col("id").cast("string").alias("deposit_id"),
        F.lit("a").alias("provider_id"),
        F.lit("c").alias("customer_id"),
        F.lit("visa").alias("type"),
        (F.col("id") % 15_000).cast("string").alias("last_digits"),
        F.lit("done").alias("state"),
        F.lit(100).cast("long").alias("amount_requested_cents"),
    )
    profile = profiles.payment_profile(
        deposits,
        table(spark, "payment_providers", [{"id": "a", "name": "A", "merchant_id": "m"}]),
        table(spark, "payment_merchants", [{"id": "m", "name": None}]),
        table(spark, "payment_customers", [{"id": "c", "user_id": "u"}]),
        table(spark, "payment_users", [{"id": "u", "patron_id": "p"}]),
        table(spark, "users", [{"patron_id": "p"}]),
        tz=TORONTO,
    )
    row = profile.first()
    assert (row.deposits, row.amount_cents, row.merchants, row.providers, row.payment_cards) == (n, 100 * n, 0, 1, 15_000)
    plan = profile._jdf.queryExecution().executedPlan().toString()
    assert "collect_set" not in plan and "Expand" not in plan


def test_a_model_is_made_once_for_all_reports_of_a_run(spark):
    made = []

    def build():
        made.append(1)
        return spark.range(3).toDF("n")

    run = Catalog.of()
    first, second = run.once(("model", JAN), build), run.once(("model", JAN), build)
    assert first is second and len(made) == 1 and collected(second) == [(0,), (1,), (2,)]
    run.once(("model", FEB), build)
    assert len(made) == 2


def test_pairs_leave_out_legs_without_a_transaction_and_weigh_equal_amounts(spark):
    leg = {"a_type": "customer_liability", "debit_cents": 5, "p_bet_id": "b"}
    house = {"a_type": "sportsbook_unsettled_bets", "credit_cents": 5, "p_bet_id": "b"}
    rows = ledger(
        spark,
        leg,
        {**leg, "a_patron_id": "p2"},
        house,
        {**house, "a_patron_id": "other"},
        {**house, "a_patron_id": "other"},
        {**leg, "ledger_transaction_id": None},
        {**house, "ledger_transaction_id": None},
        {**leg, "ledger_transaction_id": "L2"},
        {**house, "ledger_transaction_id": "L2", "credit_cents": 6},
    )
    assert collected(L.matched(rows, L.SPORTS_BETS, ["patron_id", "ref_id"])) == [("p1", "b", 10), ("p2", "b", 10)]
    apart = L.matched(rows.where("debit_cents > 0"), L.SPORTS_BETS, ["patron_id"], credits=rows.where("a_patron_id = 'other'"))
    assert collected(apart) == [("p1", 5), ("p2", 5)]


def test_stored_postings_are_those_the_player_report_reads(spark):
    from tallybook.functions.periods import ReportWindow
    from tallybook.plans import activity

    customer, house = "customer_liability", "sportsbook_house_wins"
    at_noon = {"t_changed_at": at("2023-01-10 12:00"), "p_bet_id": "b", "bet_history_id": "h"}
    rows = ledger(
        spark,
        {**at_noon, "p_type": "sportsbook_payout", "a_type": house, "debit_cents": 1},
        {**at_noon, "p_type": "casino_free_wager", "debit_cents": 2},
        {**at_noon, "p_type": "sportsbook_payout", "t_type": "sportsbook_payout", "a_type": customer, "credit_cents": 3},
        {**at_noon, "p_type": "sportsbook_bet_void", "a_type": house, "debit_cents": 4},
        {**at_noon, "p_type": "deposit", "t_type": None, "credit_cents": 5},
        # a wire by its reason and a withdrawal by its type, no adjustment
        {**at_noon, "p_type": "amendment", "t_type": "withdrawal", "adjustment_reason": "9998", "debit_cents": 6},
        {**at_noon, "p_type": "casino_payout", "credit_cents": 7, "p_id": "P"},
        {**at_noon, "p_type": "casino_wager", "debit_cents": 0, "credit_cents": 8},
        {**at_noon, "p_type": "sportsbook_payout", "gaming_state": None, "credit_cents": 9},
        {**at_noon, "p_type": "deposit", "t_changed_at": at("2023-02-10 12:00"), "credit_cents": 10},
    )
    changed = L.cash_adjustment()
    moved = L.is_any(L.deposit_flows()) | L.is_any(L.withdrawal_flows()) | changed
    pairs = {"withdrawn": L.WITHDRAWALS, "casino": L.CASINO_WAGERS}
    kept = activity._read_postings(rows, ReportWindow.month(2023, 1), pairs, moved)
    ids = ["ledger_transaction_id", "patron_transaction_id", "p_id", "bet_history_id", "p_bet_id"]
    assert collected(kept, F.col("debit_cents") + F.col("credit_cents"), *ids) == [
        (3, "L1", None, None, None, "b"),
        (4, None, None, None, "h", "b"),
        (5, None, None, None, None, None),
        (6, "L1", "T1", None, None, None),
        (7, None, "T1", "P", None, None),
    ]
    assert kept.where(changed).count() == 0
