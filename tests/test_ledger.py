from datetime import datetime

from conftest import at, collected, ledger, table
from pyspark.sql import functions as F

from tallybook.functions.periods import TORONTO, ReportWindow
from tallybook.operators import ledger as L

WINDOW = ReportWindow.month(2023, 1)


def debit(tx, cents, **more):
    return {"ledger_transaction_id": tx, "debit_cents": cents, "p_vegas_bet_id": "b1", **more}


def credit(tx, cents, **more):
    return {
        "ledger_transaction_id": tx,
        "credit_cents": cents,
        "a_type": "sportsbook_unsettled_bets",
        "p_vegas_bet_id": "b1",
        **more,
    }


def matched(rows):
    by = [L.to_local("posted_at", TORONTO).alias("ts"), "patron_id", "ref_id"]
    return L.match_legs(L.ledger_legs(rows, L.SPORTS_BETS, "debit"), L.ledger_legs(rows, L.SPORTS_BETS, "credit"), by)


def test_match_needs_transaction_and_amount(spark):
    rows = ledger(
        spark,
        debit("L1", 100),
        credit("L1", 100),
        debit("L2", 100),
        credit("L2", 99),
        debit("L3", 100),
    )
    assert collected(matched(rows)) == [(at("2023-01-10 07:00:00"), "p1", "b1", 100)]


def test_repeated_postings_count_once(spark):
    rows = ledger(spark, debit("L1", 100), debit("L1", 100), credit("L1", 100), credit("L1", 100))
    assert collected(matched(rows), "cents") == [(100,)]


def test_two_by_two_equal_legs_cross_match(spark):
    rows = ledger(
        spark,
        debit("L1", 100, p_vegas_bet_id="b1"),
        debit("L1", 100, p_vegas_bet_id="b2"),
        credit("L1", 100, p_vegas_bet_id="b1"),
        credit("L1", 100, p_vegas_bet_id="b2"),
    )
    assert collected(matched(rows), "ref_id", "cents") == [("b1", 200), ("b2", 200)]


def test_several_families_in_one_pass_equal_each_alone(spark):
    casino = {"p_type": "casino_wager", "p_vegas_bet_id": None}
    rows = ledger(
        spark,
        debit("L1", 100),
        credit("L1", 100),
        debit("L2", 70, p_id="c1", **casino),
        credit("L2", 70, **{**casino, "a_type": "casino_house_wins", "p_id": "c1"}),
        debit("L3", 30, t_type="withdrawal", p_type="withdrawal", patron_transaction_id="w1"),
        credit("L3", 30, t_type="withdrawal", p_type="withdrawal", a_type="clearing_withdrawals"),
    )
    pairs = {"sports": L.SPORTS_BETS, "casino": L.CASINO_WAGERS, "out": L.WITHDRAWALS}
    together = collected(L.matched_transfers(rows, pairs, TORONTO), "flow", "ref_id", "cents")
    assert together == [("casino", "c1", 70), ("out", "w1", 30), ("sports", "b1", 100)]


def test_net_movement_and_flip(spark):
    rows = ledger(spark, {"credit_cents": 500}, {"debit_cents": 120})
    assert collected(L.net_movement(rows, ["a_patron_id"])) == [("p1", 380)]
    assert collected(L.net_movement(rows, ["a_patron_id"], flip=True)) == [("p1", -380)]


def test_bet_id_falls_back_and_promo_is_excluded_or_kept(spark):
    rows = ledger(
        spark,
        {"p_type": "sportsbook_free_bet", "p_bet_id": "f1"},
        {"ledger_transaction_id": "A", "p_bet_id": "f1"},
        {"ledger_transaction_id": "B", "p_vegas_bet_id": "f1", "p_bet_id": "other"},
        {"ledger_transaction_id": "C", "p_vegas_bet_id": "cash"},
        {"ledger_transaction_id": "D"},
    )
    free = L.free_bet_ids(rows)
    assert collected(free) == [("f1",)]
    bets = rows.where(F.col("p_type") == "sportsbook_bet").withColumn("bet", L.bet_id())
    assert collected(L.exclude(bets, free, "bet", "bet_id"), "ledger_transaction_id") == [("C",), ("D",)]
    assert collected(L.only(bets, free, "bet", "bet_id"), "ledger_transaction_id") == [("A",), ("B",)]
    flagged = L.flag_promo(bets, free)
    assert collected(flagged, "ledger_transaction_id", "is_promo") == [("A", True), ("B", True), ("C", False), ("D", False)]


def test_free_bets_with_a_posting_in_the_window(spark):
    bets = table(spark, "bets", [{"id": "in", "free_bet_id": "f"}, {"id": "out", "free_bet_id": "f"}, {"id": "cash"}])
    rows = ledger(
        spark,
        {"p_vegas_bet_id": "in"},
        {"p_vegas_bet_id": "out", "t_changed_at": at("2023-03-01")},
        {"p_vegas_bet_id": "cash"},
    )
    assert collected(L.free_bet_ids_posted(bets, rows, WINDOW)) == [("in",)]


def test_flows_share_one_scan_and_may_overlap(spark, tmp_path):
    path = str(tmp_path / "ledger")
    ledger(spark, {"p_type": "deposit", "credit_cents": 900}, {"p_type": "other", "debit_cents": 50}).write.parquet(path)
    rows = spark.read.parquet(path)
    flows = [
        L.Flow("deposit", L.on_customer("deposit")),
        L.Flow("everything", F.col("a_type") == "customer_liability", flip=True),
    ]
    out = L.ledger_flows(rows, flows, TORONTO)
    assert collected(out, "flow", "cents") == [("deposit", 900), ("everything", -850)]
    assert out._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1


def test_wires_and_adjustments_split_amendments(spark):
    base = {"p_type": "amendment", "credit_cents": 10}
    rows = ledger(
        spark,
        {**base, "adjustment_reason": "9998", "adjustment_type": '"cash_deposit"'},
        {**base, "adjustment_reason": "9998", "adjustment_type": '"cash_withdrawal"'},
        {**base, "adjustment_reason": "1"},
        {**base, "adjustment_reason": None, "p_type": "amendment_rg"},
    )
    assert rows.where(L.wire(L.WIRE_DEPOSIT)).count() == 1
    assert rows.where(L.wire(L.WIRE_WITHDRAWAL)).count() == 1
    assert rows.where(L.cash_adjustment()).count() == 2


def test_a_third_of_all_postings_in_one_transaction(spark):
    """Equal legs of a hot transaction are weighted, never paired out."""
    n = 3000
    hot = spark.range(n).select(
        F.lit("HOT").alias("ledger_transaction_id"),
        F.concat(F.lit("p"), F.col("id")).alias("patron_id"),
        F.lit("x").alias("account"),
        F.lit(5).cast("bigint").alias("cents"),
        F.lit(None).cast("timestamp_ntz").alias("posted_at"),
        F.lit("r").alias("ref_id"),
    )
    out = L.match_legs(hot, hot, ["ref_id"])
    assert collected(out) == [("r", 5 * n * n)]


def test_exclude_keeps_rows_without_a_key_and_spreads_them(spark):
    from tallybook.operators.ledger import exclude

    rows = spark.createDataFrame([("a", 1), (None, 2), (None, 3), ("b", 4)], "bet_id string, n int")
    ids = spark.createDataFrame([("a",), (None,)], "bet_id string")
    got = exclude(rows, ids, "bet_id", "bet_id")
    assert got.columns == ["bet_id", "n"]
    assert collected(got, "n") == [(2,), (3,), (4,)]
    assert "coalesce" in got._jdf.queryExecution().optimizedPlan().toString()


def test_a_stake_meets_a_credit_posted_outside_the_window(spark):
    from tallybook.plans.finance import cash_bets

    leg = {"p_vegas_bet_id": "b1", "t_type": "sportsbook_bet", "p_type": "sportsbook_bet", "a_type": "customer_liability"}
    other = {**leg, "credit_cents": 700, "a_type": "sportsbook_unsettled_bets", "t_changed_at": datetime(2023, 2, 1)}
    debit = ledger(spark, {**leg, "debit_cents": 700})
    everything = debit.union(ledger(spark, other))
    free = spark.createDataFrame([], "bet_id string")
    assert cash_bets(debit, free, "America/Toronto").count() == 0
    assert collected(cash_bets(debit, free, "America/Toronto", credits=everything), "patron_id", "cents") == [("p1", 700)]
