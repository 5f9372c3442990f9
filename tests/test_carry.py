"""Balances and snapshots that are carried on from period to period give what the whole history gives."""

from datetime import datetime, timedelta

import pytest
from conftest import at, collected, ledger, table
from pyspark.sql import functions as F

from tallybook.operators import balances, carry
from tallybook.operators.snapshots import advance_snapshot, latest_asof, take_snapshot

JAN, FEB, MAR = datetime(2023, 1, 1), datetime(2023, 2, 1), datetime(2023, 3, 1)


def posting(when, credit=0, patron="p1", **more):
    return {"t_changed_at": at(when), "credit_cents": credit, "a_patron_id": patron, **more}


EARLY = [
    posting("2022-11-05 12:00", 100),
    posting("2022-12-30 12:00", 10, "p2"),
    # midnight in Toronto is five hours later in UTC
    posting("2023-01-01 04:59:59", 1),
    posting("2023-01-01 05:00:00", 2),
    posting("2023-01-20 12:00", 1000, p_type="bonus_offer_payout"),
    posting("2023-01-21 12:00", 7, gaming_state="US-NJ"),
]
LATER = [posting("2023-02-01 05:00", 5), posting("2023-02-14 12:00", 50, "p3"), posting("2023-04-01 12:00", 9)]


def state(rows):
    return carry.ledger_moves(rows, state="CA-ON")


def full(rows, moment):
    moves = state(rows).where(F.col("posted_at") < F.lit(moment.isoformat()).cast("timestamp_ntz") + F.expr("interval 5 hours"))
    return collected(moves.groupBy("flow", "patron_id").agg(F.sum("cents")))


def held(carried):
    return collected(carried.nets.groupBy("flow", "patron_id").agg(F.sum("cents")))


def test_two_periods_equal_the_whole_history(spark):
    rows = ledger(spark, *EARLY, *LATER)
    january = carry.carry(state(rows), FEB)
    february = carry.carry(state(rows), MAR, before=january)
    assert held(january) == full(rows, FEB)
    assert held(february) == full(rows, MAR)
    assert collected(january.balance(carry.CASH, datetime(2023, 1, 28))) == collected(january.balance(carry.CASH))


def test_the_second_period_reads_only_its_own_and_the_open_days(spark):
    january = carry.carry(state(ledger(spark, *EARLY, *LATER)), FEB)
    # whatever became of the closed days, they are not read again
    changed = ledger(spark, *[{**r, "credit_cents": 10**9} for r in EARLY], *LATER)
    assert held(carry.carry(state(changed), MAR, before=january)) == full(ledger(spark, *EARLY, *LATER), MAR)


def test_a_late_posting_of_an_open_day_is_read_with_the_next_period(spark):
    late = posting("2023-01-30 12:00", 33, "p2")
    january = carry.carry(state(ledger(spark, *EARLY)), FEB)
    rows = ledger(spark, *EARLY, late, *LATER)
    assert held(carry.carry(state(rows), MAR, before=january)) == full(rows, MAR)


def test_a_late_posting_of_a_closed_day_is_handed_in(spark):
    late = posting("2022-12-24 12:00", 44, "p9")
    january = carry.carry(state(ledger(spark, *EARLY)), FEB)
    rows = ledger(spark, *EARLY, late, *LATER)
    handed = state(ledger(spark, late, posting("2023-01-31 12:00", 10**9)))
    assert held(carry.carry(state(rows), MAR, before=january, late=handed)) == full(rows, MAR)


def test_opening_and_closing_cash(spark):
    rows = ledger(spark, *EARLY, *LATER)
    users = table(spark, "users", [{"patron_id": p} for p in ("p1", "p2", "p3", "p4")])
    window = carry.ReportWindow(FEB, MAR)
    plain = balances.opening_and_closing(rows, users, users, window, state="CA-ON")
    carried = carry.carried_cash(carry.carry(state(rows), FEB), state(rows), users, users)
    assert [collected(x) for x in carried] == [collected(x) for x in plain]


def test_states_are_kept_by_moment(spark, tmp_path):
    folder = str(tmp_path / "states")
    rows = ledger(spark, *EARLY, *LATER)
    assert carry.load(spark, folder, MAR) is None
    january = carry.carry(state(rows), FEB)
    carry.save(january, folder)
    carry.save(carry.carry(state(rows), MAR, before=january), folder)
    assert carry.load(spark, folder, JAN) is None
    found = carry.load(spark, folder, datetime(2023, 2, 20))
    assert (found.upto, found.open_from, found.tz) == (FEB, january.open_from, january.tz) and held(found) == held(january)
    assert held(carry.carry(state(rows), MAR, before=found)) == held(carry.load(spark, folder, MAR)) == full(rows, MAR)


def test_a_state_is_not_carried_back(spark):
    january = carry.carry(state(ledger(spark, *EARLY)), FEB)
    with pytest.raises(ValueError):
        carry.carry(state(ledger(spark, *EARLY)), JAN, before=january)
    with pytest.raises(ValueError):
        january.balance(carry.CASH, JAN)


VERSIONS = [
    # id, name, first clock, second clock
    ("a", "a1", "2023-01-01", "2023-01-01"),
    ("a", "a2", "2023-01-10", "2023-01-10"),
    ("a", "a2 too", "2023-01-10", "2023-01-10"),
    ("b", "b1", "2023-01-01", "2023-01-01"),
    ("b", "b2", "2023-01-10", None),
    ("c", "c1", "2023-01-01", None),
    ("c", "c2", "2023-02-10", "2023-02-10"),
    ("d", "d1", "2023-02-10", "2023-02-11"),
    ("d", "d2", "2023-02-10", "2023-02-10"),
    ("e", "e1", "2023-01-05", "2023-01-05"),
    ("e", "e2", "2023-02-20", None),
    (None, "nobody", "2023-01-05", "2023-01-05"),
    ("f", "no clock", None, "2023-01-05"),
    ("g", "g1", "2023-01-31 00:01", "2023-02-02"),
]


def versions(spark, rows):
    keyed = [dict(zip(("id", "display_name", "_changed_at", "updated_at"), (r[0], r[1], r[2] and at(r[2]), r[3] and at(r[3])))) for r in rows]
    return table(spark, "jackpots", keyed)


def test_a_snapshot_carried_over_every_cutoff_is_the_full_ranking(spark):
    df, grace = versions(spark, VERSIONS), timedelta(minutes=2)
    kept = None
    for cutoff in [datetime(2023, 1, 1), datetime(2023, 1, 5), datetime(2023, 1, 31), FEB, datetime(2023, 2, 15), MAR]:
        if kept is None:
            kept = take_snapshot(df, ["id"], cutoff=cutoff, grace=grace)
        else:
            kept = advance_snapshot(kept, df, cutoff=cutoff, grace=grace)
        shown = latest_asof(df, ["id"], cutoff=cutoff, grace=grace)
        assert collected(kept.visible(), *df.columns) == collected(shown, *df.columns)


def test_a_snapshot_reads_only_the_versions_since(spark):
    kept = take_snapshot(versions(spark, VERSIONS), ["id"], cutoff=FEB)
    since = versions(spark, [r for r in VERSIONS if r[2] is None or r[2] >= "2023-02-01"] + [("a", "rewritten", "2023-01-30", "2023-01-30")])
    merged = advance_snapshot(kept, since, cutoff=MAR)
    assert collected(merged.visible(), "display_name") == collected(latest_asof(versions(spark, VERSIONS), ["id"], cutoff=MAR), "display_name")


def test_late_versions_are_ranked_with_the_old_ones(spark):
    late = [("a", "a3", "2023-01-15", "2023-01-15"), ("b", "b0", "2022-12-01", "2022-12-01"), ("e", "e0", "2023-01-05", "2023-01-05")]
    kept = take_snapshot(versions(spark, VERSIONS), ["id"], cutoff=FEB)
    merged = advance_snapshot(kept, versions(spark, VERSIONS), cutoff=datetime(2023, 2, 5), late=versions(spark, late))
    want = latest_asof(versions(spark, VERSIONS + late), ["id"], cutoff=datetime(2023, 2, 5))
    assert collected(merged.visible(), "id", "display_name") == collected(want, "id", "display_name")


def test_a_snapshot_is_not_carried_back(spark):
    kept = take_snapshot(versions(spark, VERSIONS), ["id"], cutoff=FEB)
    with pytest.raises(ValueError):
        advance_snapshot(kept, versions(spark, VERSIONS), cutoff=JAN)
