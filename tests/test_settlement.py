import pytest
from conftest import at, collected, ledger, table

from tallybook.functions.periods import TORONTO, ReportWindow
from tallybook.operators.settlement import RULES, first_settlement, resettlement, resettlement_rollup

WINDOW = ReportWindow.month(2023, 1)
DEBITS, CREDITS = 700, 200
CUSTOMER, UNSETTLED, WINS = "customer_liability", "sportsbook_unsettled_bets", "sportsbook_house_wins"

# (state, previous, free bet?, account, same day?) and what 700 debited and 200 credited must book
CASES = [
    (("voided", "open", False, CUSTOMER, True), 0),
    (("voided", "loss", True, CUSTOMER, True), 0),
    (("voided", "win", False, WINS, True), 200),
    (("voided", "push", False, UNSETTLED, True), 200),
    (("refund", "open", True, CUSTOMER, False), 0),
    (("refund", "loss", False, CUSTOMER, True), -200),
    (("refund", "win", False, WINS, True), 200),
    (("refund", "push", False, WINS, True), 200),
    (("loss", "refund", False, CUSTOMER, True), 700),
    (("win", "refund", False, UNSETTLED, True), -500),
    (("push", "refund", False, WINS, True), -700),
    (("loss", "refund", True, CUSTOMER, False), 500),
    (("open", "voided", False, CUSTOMER, True), 0),
    (("open", "refund", False, CUSTOMER, True), 700),
    (("voided", "win", False, CUSTOMER, True), 0),
    (("voided", "push", False, CUSTOMER, True), 0),
    (("refund", "win", False, CUSTOMER, True), 0),
    (("refund", "push", False, UNSETTLED, True), 0),
    (("win", "refund", False, CUSTOMER, True), 0),
    (("push", "refund", False, CUSTOMER, True), 0),
    (("refund", "win", True, CUSTOMER, True), 500),
    (("win", "loss", True, CUSTOMER, True), 500),
    (("win", "open", True, CUSTOMER, True), 500),
    (("open", "win", True, CUSTOMER, True), 500),
    (("win", "loss", False, CUSTOMER, True), 500),
    # no rule fits a house account here
    (("win", "loss", False, WINS, True), 0),
    # a missing previous state fits neither list
    (("win", None, True, CUSTOMER, True), 0),
    # two rules fit: the one for another day comes before the one that books nothing
    (("win", "refund", False, CUSTOMER, False), 500),
    # a free bet lost straight from open books nothing
    (("loss", "open", True, CUSTOMER, True), 0),
]


def test_there_is_a_case_for_every_rule():
    assert len(RULES) == 25 and len(CASES) >= 25


@pytest.fixture(scope="module")
def booked(spark):
    postings, states = [], []
    for i, ((state, previous, promo, account, same_day), _) in enumerate(CASES):
        common = {"bet_history_id": f"h{i}", "p_vegas_bet_id": f"b{i}", "a_type": account}
        common |= {"p_type": "sportsbook_bet_resettlement"}
        postings += [{**common, "debit_cents": DEBITS}, {**common, "credit_cents": CREDITS}]
        states.append(
            {
                "bet_history_id": f"h{i}",
                "state": state,
                "previous_state": previous,
                "free_bet_id": "f" if promo else None,
                "previous_ordinal": 1,
                "new_timestamp": at("2023-01-10 20:00:00"),
                "new_previous_timestamp": at("2023-01-10 01:00:00" if same_day else "2023-01-09 23:00:00"),
            }
        )
    rows = resettlement(ledger(spark, *postings), table(spark, "bet_states", states), WINDOW, tz=TORONTO)
    return {r["bet_id"]: r["cents"] for r in rows.collect()}


@pytest.mark.parametrize("index", range(len(CASES)))
def test_decision_table(booked, index):
    assert booked[f"b{index}"] == CASES[index][1], CASES[index]


def state_row(i, **more):
    return {"bet_history_id": i, "previous_state": "open", "previous_ordinal": 1, "state": "refund", **more}


def test_first_and_later_settlements(spark):
    base = {"p_type": "sportsbook_bet_resettlement", "credit_cents": 300}
    ids = ["cash refund", "cash win", "free win", "free refund", "later refund", "later free refund", "reopened"]
    rows = ledger(spark, *[{**base, "bet_history_id": i, "p_vegas_bet_id": i} for i in ids])
    states = table(
        spark,
        "bet_states",
        [
            state_row("cash refund"),
            state_row("cash win", state="win"),
            state_row("free win", state="win", promo_engine_free_bet_id="f"),
            state_row("free refund", free_bet_id="f"),
            state_row("later refund", previous_ordinal=2),
            state_row("later free refund", previous_ordinal=2, free_bet_id="f"),
            state_row("reopened", previous_state="win"),
        ],
    )
    got = collected(first_settlement(rows, states, WINDOW, tz=TORONTO), "bet_id", "cents")
    assert got == [("cash refund", 300), ("cash win", 0), ("free refund", 0), ("free win", 300), ("later refund", 300)]
    # the later ones can be read from other states
    other = table(spark, "bet_states", [state_row("cash win", previous_ordinal=3)])
    got = collected(first_settlement(rows, states, WINDOW, tz=TORONTO, later_states=other), "bet_id", "is_first", "cents")
    assert ("cash win", False, 300) in got and not any(b == "later refund" for b, *_ in got)


def test_rollup_splits_cash_and_free(spark):
    df = spark.createDataFrame(
        [(at("2023-01-01"), "p", "b", None, 10), (at("2023-01-01"), "p", "b", "f", 5)],
        "ts timestamp_ntz, patron_id string, bet_id string, promo_id string, cents bigint",
    )
    assert [collected(resettlement_rollup(df, p), "cents") for p in (False, True, None)] == [[(10,)], [(5,)], [(15,)]]
