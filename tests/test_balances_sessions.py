from datetime import datetime

from conftest import at, collected, ledger, table
from pyspark.sql import functions as F

from tallybook.functions.periods import TORONTO, ReportWindow
from tallybook.operators import balances, sessions
from tallybook.operators import bets as bet_ops
from tallybook.operators.measures import flow_amount, stack_measures, total_measures, union_measures

WINDOW = ReportWindow.month(2023, 1)


def users(spark, *ids, **more):
    return table(spark, "users", [{"patron_id": i, "is_tester": False, **more} for i in ids])


def test_balances_fill_every_user_with_zero(spark):
    rows = ledger(
        spark,
        {"credit_cents": 100, "t_changed_at": at("2022-12-31")},
        {"debit_cents": 30},
        {"credit_cents": 7, "t_changed_at": at("2023-06-01")},
        {"credit_cents": 999, "gaming_state": "US-NJ"},
    )
    start, end = balances.opening_and_closing(rows, users(spark, "p1", "p2"), users(spark, "p1", "p2", "p3"), WINDOW, state="CA-ON")
    assert collected(start) == [("p1", 100), ("p2", 0)]
    # the closing balance has no bound of its own
    assert collected(end) == [("p1", 77), ("p2", 0), ("p3", 0)]
    assert collected(balances.cash_balance(rows, users(spark, "p1"), WINDOW, state="CA-ON")) == [("p1", 100)]
    assert collected(balances.cash_balance(rows, users(spark, "p1"), None, state="CA-ON")) == [("p1", 77)]


def test_opening_plus_flows_is_closing(spark):
    kinds = [
        {"p_type": "deposit", "credit_cents": 500},
        {"p_type": "region_transfer_in", "credit_cents": 40},
        {"p_type": "amendment", "adjustment_reason": "9998", "adjustment_type": '"cash_deposit"', "credit_cents": 60},
        {"p_type": "amendment", "adjustment_reason": "9998", "adjustment_type": '"cash_withdrawal"', "debit_cents": 25},
        {"p_type": "region_transfer_out", "debit_cents": 15},
        {"p_type": "amendment", "adjustment_reason": None, "debit_cents": 5},
        {"p_type": "withdrawal", "t_type": "withdrawal", "debit_cents": 90},
        {"p_type": "withdrawal_decline", "t_type": "x", "credit_cents": 20},
    ]
    house = [
        {"p_type": "withdrawal", "t_type": "withdrawal", "a_type": "clearing_withdrawals", "credit_cents": 90},
        {"p_type": "withdrawal_decline", "t_type": "x", "a_type": "clearing_withdrawals", "debit_cents": 20},
    ]
    before = {"p_type": "deposit", "credit_cents": 1000, "t_changed_at": at("2022-11-01")}
    rows = ledger(spark, before, *kinds, *house)

    def sum_of(frame):
        return frame.agg(F.sum("cents")).first()[0]

    one = users(spark, "p1")
    start, end = balances.opening_and_closing(rows, one, one, WINDOW)
    given = dict(window=WINDOW, tz=TORONTO)
    flows = (
        sum_of(balances.deposits(rows, **given))
        - sum_of(balances.withdrawals(rows, **given))
        + sum_of(balances.cancelled_withdrawals(rows, **given))
        + sum_of(balances.cash_adjustments(rows, **given))
    )
    assert sum_of(start) + flows == sum_of(end) == 1485


def bonus(spark, *rows):
    return table(
        spark,
        "bonus_transactions",
        [dict(zip(("user_id", "transaction_type", "transaction_amount", "transaction_timestamp_utc"), r)) for r in rows],
    )


def test_bonus_balances_and_late_unlocks(spark):
    known, everyone = users(spark, "p1"), users(spark, "p1").unionByName(users(spark, "new", inserted_at=at("2023-01-15")))
    moves = bonus(
        spark,
        ("p1", "Bonus Award", 1000, at("2022-12-01")),
        ("p1", "Bonus Playthrough", 5000, at("2022-12-02")),
        ("p1", "Bonus Award", 300, at("2023-01-05")),
        ("new", "Bonus Award", 70, at("2023-01-16")),
    )
    released = spark.createDataFrame(
        [(at("2022-12-10"), "p1", 200), (at("2023-01-10"), "p1", 50), (at("2023-01-20"), "new", 10)],
        "ts timestamp_ntz, patron_id string, cents bigint",
    )
    programs = table(
        spark,
        "user_award_bonus_cash",
        [{"id": "old", "user_id": "p1", "expires_at": at("2022-12-31")}, {"id": "open", "user_id": "p1", "expires_at": at("2023-01-20")}],
    )
    unlocks = table(
        spark,
        "user_bonus_cash_transactions",
        [
            {"user_award_bonus_cash_id": "old", "transaction_type": "unlock", "amount_cents": 33, "t_changed_at": at("2023-01-02")},
            {"user_award_bonus_cash_id": "old", "transaction_type": "revoke", "amount_cents": 99, "t_changed_at": at("2023-01-02")},
            {"user_award_bonus_cash_id": "open", "transaction_type": "unlock", "amount_cents": 44, "t_changed_at": at("2023-01-25")},
        ],
    )

    def sums(frame):
        return collected(frame.groupBy("patron_id").agg(F.sum("cents")))

    opening = balances.opening_bonus(known, moves, released, programs, unlocks, WINDOW)
    assert sums(opening) == [("p1", 1000 - 200 + 33)]
    closing = balances.closing_bonus(everyone, moves, released, WINDOW)
    assert sums(closing) == [("new", 60), ("p1", 1300 - 250)]
    # a new player's adjustments are the end balance
    moved = balances.bonus_adjustments(known, everyone, moves, released, closing, WINDOW)
    assert sums(moved) == [("new", 60), ("p1", 250)]


def plays(spark, *rows):
    return spark.createDataFrame(
        [(p, s, at(t)) for p, s, t in rows], "patron_id string, casino_session_id string, transaction_timestamp_utc timestamp_ntz"
    )


def minutes(spark, *rows):
    day = ReportWindow.day(2023, 1, 10)  # 05:00 to 05:00 UTC
    return collected(sessions.session_summary(plays(spark, *rows), "patron_id", "casino_session_id", day))


def test_session_inside_and_straddling_the_start(spark):
    got = minutes(
        spark,
        ("in", "1", "2023-01-10 06:00:00"),
        ("in", "1", "2023-01-10 06:10:00"),
        ("start", "2", "2023-01-10 04:30:00"),
        ("start", "2", "2023-01-10 05:20:00"),
        ("end", "3", "2023-01-11 04:50:00"),
        ("end", "3", "2023-01-11 05:10:00"),
        ("before", "4", "2023-01-10 04:00:00"),
    )
    assert got == [("in", 1, 10), ("start", 1, 20)]


def test_minutes_are_at_least_one_and_round_half_up(spark):
    got = minutes(
        spark,
        ("short", "1", "2023-01-10 06:00:00"),
        ("half", "2", "2023-01-10 06:00:00"),
        ("half", "2", "2023-01-10 06:02:30"),
        ("two", "3", "2023-01-10 06:00:00"),
        ("two", "3", "2023-01-10 06:01:00"),
        ("two", "4", "2023-01-10 07:00:00"),
        ("two", "4", "2023-01-10 07:01:20"),
    )
    assert got == [("half", 1, 3), ("short", 1, 1), ("two", 2, 2)]


def wagers(spark, *rows):
    return spark.createDataFrame(
        [(at("2023-01-10"), *r) for r in rows], "ts timestamp_ntz, patron_id string, category string, ref_id string, cents bigint"
    )


def test_wager_counts_are_signed_and_missing_category_has_no_bucket(spark):
    placed = wagers(spark, ("p", "slots", "a", 100), ("p", None, "b", 50), ("p", "bingo", "c", 20), ("p", "roulette", "d", 7))
    undone = wagers(spark, ("p", "slots", "a", 40))
    counts = sessions.wager_counts([(placed, "ref_id", "category", 1), (undone, "ref_id", "category", -1)])
    split = sessions.bucketed()
    row = counts.agg(F.sum("num_wagers").alias("n"), *[F.coalesce(F.sum(c), F.lit(0)).alias(k) for k, c in split.items()]).first()
    assert row.asDict() == {"n": 3, "wagers_slots": 60, "wagers_tables": 7, "wagers_livedealer": 0, "wagers_betting": 0, "wagers_other": 20}


def test_counting_in_the_stack_equals_counting_apart(spark):
    placed = wagers(spark, ("p", "slots", "a", 100), ("p", "live", "b", 50), ("q", None, None, 20))
    kinds = {"num_wagers": "bigint", **{f"wagers_{k}": "bigint" for k in ("slots", "tables", "livedealer", "betting", "other")}}
    stacked = stack_measures([(placed, sessions.signed_wagers("ref_id", 1, F.col("category")))], ["patron_id"], kinds)
    assert collected(stacked, "patron_id", "num_wagers", "wagers_slots", "wagers_livedealer") == [("p", 2, 100, 50), ("q", 0, 0, 0)]
    apart = sessions.wager_counts([(placed, "ref_id", "category", 1)]).groupBy("patron_id").agg(F.sum("num_wagers"))
    assert collected(apart) == [("p", 2), ("q", 0)]


def test_stack_total_is_the_sum_of_its_parts(spark):
    a = spark.createDataFrame([("x", "in", 5), ("y", "out", 7)], "k string, flow string, cents bigint")
    b = spark.createDataFrame([("x", 1)], "k string, m bigint")
    sources = [(a, {"plus": flow_amount("in"), "minus": flow_amount("out", sign=-1)}), (b, {"other": "m"})]
    kinds = {"plus": "bigint", "minus": "bigint", "other": "bigint", "none": "bigint"}
    assert union_measures(sources, ["k"], kinds).count() == 3
    assert collected(stack_measures(sources, ["k"], kinds)) == [("x", 5, 0, 1, 0), ("y", 0, -7, 0, 0)]
    assert collected(total_measures(b, [], {"m": "decimal(38,2)"}))[0][0] == 1


def bets(spark, *rows):
    base = {"patron_id": "p", "bet_amount_cents": 100, "placed_at": at("2023-01-05"), "closed_at": at("2023-01-06"), "status": "settled"}
    return table(spark, "bets", [{**base, "id": str(i), **r} for i, r in enumerate(rows)])


def test_bet_flows(spark):
    rows = bets(
        spark,
        {"free_bet_id": "f"},
        {"status": "voided"},
        {"status": "voided", "free_bet_id": "f"},
        {"status": "open", "closed_at": None},
        {"status": "open", "placed_at": at("2023-02-01 05:00:00")},
        {"status": "open", "free_bet_id": "f", "placed_at": at("2022-06-01")},
    )
    assert collected(bet_ops.free_bets_wagered(rows, WINDOW, tz=TORONTO), "bet_id") == [("0",), ("2",)]
    assert collected(bet_ops.free_bets_wagered(rows, None, tz=TORONTO), "bet_id") == [("0",), ("2",), ("5",)]
    assert collected(bet_ops.voided(rows, WINDOW, tz=TORONTO, promo=True), "bet_id") == [("2",)]
    assert collected(bet_ops.voided_by_day(rows, None, tz=TORONTO)) == [(datetime(2023, 1, 5), 100)]
    exposed = bet_ops.open_exposure(rows, WINDOW, promo=None)
    assert collected(exposed, "bet_id", "is_promo", "ts") == [("3", False, datetime(2023, 1, 1)), ("5", True, datetime(2023, 1, 1))]


def test_bet_activity_counts_versions_of_a_bet_once(spark):
    rows = bets(spark, {"id": "a"}, {"id": "a"}, {"id": "b", "free_bet_id": "f"}, {"id": "c", "status": "open"})
    strict = bet_ops.bet_activity(rows, [F.col("patron_id")], cash_excludes_free=True)
    assert collected(strict) == [("p", 2, 1, 200, 100)]
    loose = bet_ops.bet_activity(rows, [F.col("patron_id")], cash_excludes_free=False, prefix="lt_", free_default=0)
    assert collected(loose) == [("p", 2, 1, 300, 100)]
