from datetime import datetime, timedelta
from decimal import Decimal

from conftest import at, collected, ledger, table
from pyspark.sql import functions as F

from tallybook.functions.periods import TORONTO, ReportWindow
from tallybook.operators import alerts, profiles, promos, regulator, revenue

WINDOW = ReportWindow.month(2023, 1)


def cap(spark, wagers, winnings, promo):
    df = spark.createDataFrame(
        [(Decimal(wagers), Decimal(winnings), None if promo is None else Decimal(promo))],
        "wagers decimal(38,2), winnings decimal(38,2), free_bet_winnings decimal(30,9)",
    )
    row = regulator.deduction_cap(df).first()
    return tuple(None if v is None else float(v) for v in (row["ed_cap"], row["eligible_deductions"]))


def test_deduction_cap(spark):
    assert cap(spark, 1000, 400, 0) == (0.0, 0.0)
    assert cap(spark, 1000, 400, 50) == (60.0, 50.0)
    assert cap(spark, 1000, 400, 61) == (60.0, 60.0)
    assert cap(spark, 1000, 400, None) == (60.0, None)
    assert cap(spark, 400, 1000, 5) == (-60.0, -60.0)


def test_densify_keeps_the_skeleton_and_nothing_else(spark):
    skeleton = regulator.period_skeleton(spark, ["Betting", "Casino"], datetime(2023, 1, 31))
    facts = spark.createDataFrame(
        [(at("2023-01-31"), "Betting", 5), (at("2023-02-01"), "Betting", 7)], "gaming_day timestamp_ntz, product_code string, n int"
    )
    got = regulator.densify(facts, skeleton, ["gaming_day", "product_code"])
    assert collected(got, "product_code", "n") == [("Betting", 5), ("Casino", None)]


def test_report_ids(spark):
    skeleton = regulator.period_skeleton(spark, ["Casino"], datetime(2023, 1, 31), length=timedelta(days=1))
    row = regulator.report_ids(skeleton).first()
    assert row["transaction_id"] == "OP100001230201"
    assert row["ggr_file_name"] == "GGR_OP100001_OP100001230201_20230131_20230201_1"
    assert row["record_id"] == "OP100001230201_1_OP100001_S100001A_20230131_Casino"
    assert row["transaction_date"] == at("2023-02-02")
    other = regulator.report_ids(skeleton, transaction_day_pattern="yyyyMMdd", transaction_day_back=1, prefix="E").first()
    assert other["transaction_id"] == "EOP10000120230131"


def deposits(spark, *rows):
    return spark.createDataFrame(
        [("2023-01", *r) for r in rows], "transaction_period string, patron_id string, transaction_id string, cents bigint"
    )


def test_threshold_alerts(spark):
    rows = deposits(
        spark,
        ("just below", "1", 49_999_99),
        ("single", "2", 50_000_00),
        ("two large", "3", 50_000_00),
        ("two large", "4", 60_000_00),
        ("adds up", "5", 40_000_00),
        ("adds up", "6", 35_000_00),
        ("falls short", "7", 40_000_00),
        ("falls short", "8", 34_999_99),
        ("both", "9", 70_000_00),
        ("both", "10", 40_000_00),
        ("both", "11", 40_000_00),
        ("same transaction", "12", 40_000_00),
        ("same transaction", "12", 40_000_00),
    )
    got = alerts.threshold_alerts(rows, ["transaction_period", "patron_id"])
    assert collected(got, "patron_id", "transaction_type", "deposit_cents", "deposits") == [
        ("adds up", "Aggregate", 75_000_00, 2),
        ("both", "Aggregate", 80_000_00, 2),
        ("both", "Single", 70_000_00, 1),
        ("single", "Single", 50_000_00, 1),
    ]


def deposit(patron, tx, dollars, when, **more):
    return {"a_patron_id": patron, "patron_transaction_id": tx, "p_type": "deposit", "credit_cents": dollars * 100, "t_changed_at": at(when), **more}


def test_rolling_alerts_pass_on_either_look_back(spark):
    rows = ledger(
        spark,
        deposit("six", "1", 30_000, "2023-01-10"),
        deposit("six", "2", 20_000, "2022-09-01"),
        deposit("twelve", "3", 30_000, "2023-01-10"),
        deposit("twelve", "4", 70_000, "2022-03-01"),
        deposit("neither", "5", 30_000, "2023-01-10"),
        deposit("neither", "6", 90_000, "2021-12-01"),
        deposit("other", "7", 900_000, "2023-01-10"),
    )
    players = spark.createDataFrame([("six", 1), ("twelve", 1), ("neither", 1)], "patron_id string, times bigint")
    got = collected(alerts.rolling_alerts(rows, players, WINDOW))
    assert got == [("six", 50_000_00, 2, None, None), ("twelve", None, None, 100_000_00, 2)]


def test_monthly_depositors_leave_out_testers(spark):
    rows = ledger(spark, *[deposit(p, p, 30_000, "2023-01-10") for p in ("real", "tester", "unknown")], deposit("small", "s", 1, "2023-01-10"))
    users = table(
        spark,
        "users",
        [{"patron_id": p, "username": p, "is_tester": t} for p, t in (("real", False), ("tester", True), ("unknown", None), ("small", False))],
    )
    got = alerts.monthly_depositors(rows, users, WINDOW, ["username"])
    assert collected(got, "patron_id", "deposits") == [("real", 1)]


def both_withdrawals(spark):
    leg = {"a_patron_id": "p", "t_type": "withdrawal", "p_type": "withdrawal", "patron_transaction_id": "w1"}
    wire = {"a_patron_id": "p", "p_type": "amendment", "adjustment_reason": "9990", "adjustment_type": '"cash_withdrawal"'}
    return ledger(
        spark,
        {**leg, "debit_cents": 500},
        {**leg, "credit_cents": 500, "a_type": "clearing_withdrawals"},
        {**wire, "debit_cents": 70, "patron_transaction_id": "w2", "t_type": "x"},
    )


def test_withdrawals_keep_a_row_per_kind_unless_collapsed(spark):
    rows = both_withdrawals(spark)
    apart = alerts.withdrawal_activity(rows, tz=TORONTO, by_month=False)
    assert collected(apart) == [("p", 1, 500), ("p", 1, 70)]
    one = alerts.withdrawal_activity(rows, tz=TORONTO, by_month=False, collapse=True)
    assert collected(one) == [("p", 2, 570)]


def test_weights_equal_repeating_the_driver(spark):
    rows = both_withdrawals(spark)
    players = alerts.driver_counts(spark.createDataFrame([("p",), ("p",), ("p",)], "patron_id string"))
    given = dict(tz=TORONTO, by_month=False, players=players)
    assert collected(alerts.withdrawal_activity(rows, **given)) == [("p", 1, 210), ("p", 1, 500)]
    assert collected(alerts.withdrawal_activity(rows, weigh_matched=True, **given)) == [("p", 1, 1500), ("p", 1, 210)]


def test_player_ggr_weighs_market_rows_and_drops_idle_players(spark):
    stack = spark.createDataFrame(
        [(at("2023-01-05"), "b", "p", 100, 30, 0, 5), (at("2023-01-05"), None, "p", 10, 0, 0, 0), (at("2023-01-05"), "c", "idle", 0, 0, 0, 0)],
        "ts timestamp_ntz, bet_id string, patron_id string, placed bigint, paid bigint, voided bigint, resettled bigint",
    )
    market = spark.createDataFrame([("b",), ("b",)], "bet_id string")
    assert collected(revenue.player_ggr(stack, market, None)) == [("p", 75 * 2 + 10)]
    players = spark.createDataFrame([("p", 3)], "patron_id string, times bigint")
    assert collected(revenue.player_ggr(stack, market, players)) == [("p", 3 * 160)]


def test_payment_profile(spark):
    paid = [
        {"deposit_id": "1", "provider_id": "a", "customer_id": "c", "type": '"visa"', "last_digits": '"1111"', "state": "done"},
        {"deposit_id": "2", "provider_id": "b", "customer_id": "c", "type": "visa", "last_digits": "1111", "state": "done"},
        {"deposit_id": "3", "provider_id": "b", "customer_id": "c", "type": None, "last_digits": None, "state": "done"},
        {"deposit_id": "4", "provider_id": "a", "customer_id": "c", "type": "amex", "last_digits": "2", "state": "created"},
    ]
    got = profiles.payment_profile(
        table(spark, "payment_deposits", paid, amount_requested_cents=100),
        table(spark, "payment_providers", [{"id": "a", "name": "A", "merchant_id": "m"}, {"id": "b", "name": "B", "merchant_id": "m"}]),
        table(spark, "payment_merchants", [{"id": "m", "name": "M"}]),
        table(spark, "payment_customers", [{"id": "c", "user_id": "u"}]),
        table(spark, "payment_users", [{"id": "u", "patron_id": "p"}]),
        table(spark, "users", [{"patron_id": "p", "last_login_at": at("2023-01-10 12:00:00.75")}]),
        tz=TORONTO,
    )
    row = got.first()
    assert (row["deposits"], row["amount_cents"], row["merchants"], row["providers"], row["payment_cards"]) == (3, 300, 1, 2, 2)
    assert row["last_login_at"] == at("2023-01-10 07:00:00")


def test_ratio_is_unknown_without_a_divisor(spark):
    df = spark.createDataFrame([(1, 3), (1, 0), (None, 3)], "a bigint, b bigint")
    assert [r[0] for r in df.select(profiles.ratio("a", "b")).collect()] == [Decimal("0.333333"), None, None]


def test_account_sheet_needs_verification_and_keeps_missing_contacts(spark):
    users = table(
        spark,
        "account_users",
        [{"id": i, "birthdate": at("1990-05-01").date(), "registration_completed_at": None if i == "c" else at("2023-01-01")} for i in "abcd"],
    )
    kyc = table(spark, "kyc_verifications", [{"user_id": i, "status": "rejected" if i == "b" else "approved", "document_type": "id"} for i in "abcd"])
    homes = table(spark, "addresses", [{"user_id": "a", "line_1": "1 main STREET", "city": "north bay"}])
    ids = spark.createDataFrame([("a",), ("b",), ("c",)], "id string")
    got = profiles.account_sheet(users, kyc, table(spark, "emails", []), homes, table(spark, "phone_numbers", []), ids)
    assert collected(got, "id", "line_1", "city", "email") == [("a", "1 Main Street", "North Bay", None)]


def test_bet_history_judges_the_player_at_the_cutoff(spark):
    def version(bet, patron, day):
        return {"id": bet, "patron_id": patron, "status": day, "_changed_at": at(day), "updated_at": at(day)}

    history = table(
        spark,
        "bets_history",
        [
            version("moved away", "p", "2023-01-01"),
            version("moved away", "q", "2023-01-02"),
            version("moved in", "q", "2023-01-01"),
            version("moved in", "p", "2023-01-02"),
            version("later", "p", "2023-03-01"),
        ],
    )
    names = table(spark, "users", [{"patron_id": "q", "first_name": "Q"}])
    ids = spark.createDataFrame([("p",)], "patron_id string")
    got = profiles.bet_history(history, names, ids, datetime(2023, 2, 1))
    assert collected(got, "id", "status", "first_name") == [("moved in", "2023-01-02", None)]


def test_status_flags(spark):
    status = table(spark, "break_status", [{"patron_id": "a", "BreakStart": "20230101"}, {"patron_id": "b", "BreakStart": "1", "BreakEnd": "2"}])
    players = spark.createDataFrame([("a",), ("b",), ("c",)], "patron_id string")
    got = profiles.status_flags(players, status, "BreakStart", "BreakEnd", "BreakStatus")
    assert collected(got, "patron_id", "BreakStatus", "BreakStart", "BreakEnd") == [("a", "0", "20230101", ""), ("b", "1", "1", "2"), ("c", "0", "", "")]


def test_free_round_lifecycle(spark):
    wager = {"type": "wager", "promo_engine_free_round_award_id": "f", "amount_cents": 100, "patron_id": "p"}

    def end(tx, parent, kind, cents):
        return {"patron_transaction_id": tx, "parent_id": parent, "type": kind, "amount_cents": cents}

    info = table(
        spark,
        "wager_and_game_info",
        [{**wager, "patron_transaction_id": t} for t in ("won", "lost", "undone", "pending", "early")]
        + [end("won-p", "won", "payout", 900), end("lost-p", "lost", "payout", 0), end("undone-r", "undone", "rollback", 100), end("early-p", "early", "payout", 5)],
    )
    clocks = table(spark, "patron_transactions", [{"id": t, "_changed_at": at("2023-01-05" if t != "early" else "2022-12-01")} for t in ("won", "lost", "undone", "pending", "early")])
    wagers = table(spark, "casino_wagers", [{"patron_transaction_id": t, "_changed_at": at("2023-01-05")} for t in ("won", "lost", "undone", "pending", "early")])
    payouts = table(spark, "casino_payouts", [{"patron_transaction_id": "won-p", "_changed_at": at("2023-01-06")}, {"patron_transaction_id": "lost-p", "_changed_at": at("2023-01-04")}])
    rollbacks = table(spark, "casino_wager_rollbacks", [{"patron_transaction_id": "undone-r", "_changed_at": at("2023-01-07")}])
    model = spark.createDataFrame([("won-p", Decimal("2.5"))], "remote_wallet_transaction_id string, amount_precision decimal(28,9)")
    got = promos.free_round_lifecycle(info, clocks, wagers, payouts, rollbacks, model, WINDOW)
    rows = {r["wager_id"]: r for r in got.collect()}
    assert set(rows) == {"won", "lost", "undone"}
    assert [(rows[k]["outcome"], float(rows[k]["payout_amount"]), rows[k]["closed_at"]) for k in ("won", "lost", "undone")] == [
        ("win", 6.5, at("2023-01-06")),
        ("loss", 0.0, at("2023-01-05")),
        ("rollback", 1.0, at("2023-01-07")),
    ]
    assert rows["won"]["is_jackpot"] and rows["undone"]["regraded"] and not rows["lost"]["regraded"]


def test_used_free_wagers_window_is_closed_at_both_ends(spark):
    bets = [
        {"id": i, "patron_id": "p", "free_bet_id": "f", "status": "settled", "outcome": "win", "closed_at": at(t), "bet_amount_cents": 1, "payout_amount_cents": 1}
        for i, t in (("first", "2023-01-01 05:00:00"), ("last", "2023-02-01 05:00:00"), ("after", "2023-02-01 05:00:01"))
    ]
    settled = promos.settled_free_bets(table(spark, "bets", bets))
    awards = spark.createDataFrame([], "free_wager_id string, award_program_id string")
    programmes = spark.createDataFrame([], "award_program_id string, program_name string")
    users = table(spark, "users", [{"patron_id": "p"}])
    used = promos.used_free_wagers(settled, users, awards, programmes, WINDOW, run_at=datetime(2023, 2, 2))
    assert collected(used, F.col("Wager ID"), F.col("Program Name")) == [("first", "Manual Award"), ("last", "Manual Award")]


def test_credit_legs_of_the_house_need_not_name_a_driver_player(spark):
    leg = {"t_type": "withdrawal", "p_type": "withdrawal", "patron_transaction_id": "w1"}
    players = spark.createDataFrame([("p", 1)], "patron_id string, times bigint")
    for house in (None, "house"):
        rows = ledger(
            spark,
            {**leg, "a_patron_id": "p", "debit_cents": 500},
            {**leg, "a_patron_id": house, "credit_cents": 500, "a_type": "clearing_withdrawals"},
        )
        given = {"tz": TORONTO, "by_month": False, "players": players}
        assert collected(alerts.withdrawal_activity(rows, **given)) == [("p", 1, 500)]
        assert collected(alerts.withdrawal_activity(rows, cut_credits=True, **given)) == []
