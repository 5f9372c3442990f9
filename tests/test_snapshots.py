from datetime import datetime, timedelta

from conftest import at, collected, table

from tallybook.operators.snapshots import latest_asof, latest_attrs, latest_settlement

CUT = datetime(2023, 2, 1)


def versions(spark, rows):
    return table(spark, "jackpots", [dict(zip(("id", "display_name", "_changed_at", "updated_at"), r)) for r in rows])


def names(df):
    return collected(df, "id", "display_name")


def test_newest_first_clock_then_second(spark):
    df = versions(
        spark,
        [
            ("a", "old", at("2023-01-01"), at("2023-01-05")),
            ("a", "new", at("2023-01-02"), at("2023-01-02")),
            ("b", "low", at("2023-01-02"), at("2023-01-02")),
            ("b", "high", at("2023-01-02"), at("2023-01-03")),
        ],
    )
    assert names(latest_asof(df, ["id"], cutoff=CUT)) == [("a", "new"), ("b", "high")]


def test_ties_on_both_clocks_survive(spark):
    same = (at("2023-01-02"), at("2023-01-02"))
    df = versions(spark, [("a", "x", *same), ("a", "y", *same)])
    assert names(latest_asof(df, ["id"], cutoff=CUT)) == [("a", "x"), ("a", "y")]


def test_newest_without_second_clock_drops_the_key(spark):
    df = versions(spark, [("a", "old", at("2023-01-01"), at("2023-01-01")), ("a", "new", at("2023-01-02"), None)])
    assert names(latest_asof(df, ["id"], cutoff=CUT)) == []


def test_newest_pair_where_only_one_has_the_second_clock(spark):
    df = versions(spark, [("a", "with", at("2023-01-02"), at("2023-01-01")), ("a", "without", at("2023-01-02"), None)])
    assert names(latest_asof(df, ["id"], cutoff=CUT)) == [("a", "with")]


def test_cutoff_is_exclusive_and_grace_extends_it(spark):
    df = versions(
        spark,
        [
            ("a", "before", at("2023-01-31 23:59:59"), at("2023-01-31")),
            ("a", "exactly", at("2023-02-01 00:00:00"), at("2023-02-01")),
            ("a", "late", at("2023-02-01 00:01:59"), at("2023-02-01")),
            ("a", "too late", at("2023-02-01 00:02:00"), at("2023-02-01")),
        ],
    )
    assert names(latest_asof(df, ["id"], cutoff=CUT)) == [("a", "before")]
    assert names(latest_asof(df, ["id"], cutoff=CUT, grace=timedelta(minutes=2))) == [("a", "late")]


def test_missing_keys_and_clocks_never_match(spark):
    df = versions(spark, [(None, "x", at("2023-01-01"), at("2023-01-01")), ("a", "y", None, at("2023-01-01"))])
    assert names(latest_asof(df, ["id"], cutoff=CUT)) == []


def test_composite_key(spark):
    rows = [
        {"wallet_transaction_id": "w", "jackpot_id": j, "type": t, "_changed_at": at(c), "updated_at": at(c)}
        for j, t, c in (("1", "old", "2023-01-01"), ("1", "new", "2023-01-02"), ("2", "only", "2023-01-01"))
    ]
    df = table(spark, "wallet_transaction_jackpots", rows)
    newest = latest_asof(df, ["wallet_transaction_id", "jackpot_id"], ["updated_at"], CUT)
    assert collected(newest, "jackpot_id", "type") == [("1", "new"), ("2", "only")]


def test_latest_attrs_counts_a_missing_order_as_newest(spark):
    df = versions(
        spark,
        [
            ("a", "old", at("2023-01-01"), at("2023-01-01")),
            ("a", "new", at("2023-01-01"), at("2023-01-02")),
            ("b", "dated", at("2023-01-01"), at("2023-01-02")),
            ("b", "undated", at("2023-01-01"), None),
        ],
    )
    assert names(latest_attrs(df, "id", "updated_at", ["display_name"])) == [("a", "new"), ("b", "undated")]


def test_latest_settlement_keeps_ties(spark):
    df = spark.createDataFrame(
        [("w", at("2023-01-01"), 1), ("w", at("2023-01-02"), 2), ("w", at("2023-01-02"), 3)],
        "wager string, settled timestamp_ntz, n int",
    )
    assert collected(latest_settlement(df, ["wager"], "settled"), "n") == [(2,), (3,)]


def test_one_scan_one_shuffle_and_a_limit_before_it(spark, tmp_path):
    path = str(tmp_path / "t")
    versions(spark, [("a", "x", at("2023-01-02"), at("2023-01-02"))]).write.parquet(path)
    plan = latest_asof(spark.read.parquet(path), ["id"], cutoff=CUT)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1
    assert plan.count("Exchange ") == 1
    assert plan.count("WindowGroupLimit") == 2
