"""Every registered query against SQL on the smallest test tables, and the shape of its plan."""

import os
import re

import pytest
from pyspark.sql import DataFrameWriter

from tallybook.operators import bets, casino
from tallybook.operators.ledger import CASINO_WAGERS, SPORTS_BETS, WITHDRAWALS, free_bet_ids, matched_transfers
from tallybook.operators.revenue import GAME_KEYS
from tallybook.operators.settlement import resettlement, resettlement_rollup
from tallybook.plans import activity, finance
from testbed.compare import compare, connect
from testbed.oracle import build
from testbed.queries import PERIOD, QUERIES
from testbed.tables import catalog

SF = "/root/testdata/sf0.001"
STATEMENTS = build()
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not present")


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("key", QUERIES)
def test_same_as_sql(spark, con, key):
    same, note = compare(spark, con, key, SF, STATEMENTS[key])
    assert same, note


@pytest.mark.parametrize("key", [k for k in QUERIES if k.startswith("b")])
def test_plan_has_no_nested_loops_or_python(spark, key):
    plan = QUERIES[key](spark, SF)._jdf.queryExecution().executedPlan().toString()
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython", "MapInPandas"):
        assert bad not in plan


def ledger_scans(frame) -> int:
    leaves = frame._jdf.queryExecution().optimizedPlan().collectLeaves()
    relations = [leaf.relation() for leaf in map(leaves.apply, range(leaves.size())) if leaf.nodeName().startswith("LogicalRelation")]
    return sum(r.location().rootPaths().mkString(",").endswith("/accounting") for r in relations)


#: Reads of the ledger by each report, those for the copies it stores on its way included.
SCANS = {"r01": 3, "r02": 2, "r03_player_activity": 5, "r04": 1, "r05": 4, "r10": 3, "r11": 3, "r12": 3}


@pytest.mark.parametrize("key", [k for k in QUERIES if k in SCANS or k[:3] in SCANS])
def test_how_often_a_report_reads_the_ledger(spark, monkeypatch, key):
    QUERIES[key](spark, SF)  # the test tables themselves are stored by the first query that needs them
    stored, write = [], DataFrameWriter.parquet

    def counted(writer, *args, **kwargs):
        stored.append(ledger_scans(writer._df))
        return write(writer, *args, **kwargs)

    monkeypatch.setattr(DataFrameWriter, "parquet", counted)
    most = SCANS.get(key) or SCANS[key[:3]]
    assert sum(stored) + ledger_scans(QUERIES[key](spark, SF)) <= most
    assert sum(stored) > 0


def test_legs_are_matched_after_one_exchange(spark):
    rows = catalog(spark, SF).accounting
    pairs = {"bets": SPORTS_BETS, "casino": CASINO_WAGERS, "withdrawn": WITHDRAWALS}
    for frame in (QUERIES["b07_match_legs"](spark, SF), matched_transfers(rows, pairs, "UTC")):
        plan = frame._jdf.queryExecution().executedPlan().toString()
        assert len(re.findall(r"Exchange hashpartitioning", plan)) == 2, plan
        assert plan.count("hashpartitioning(ledger_transaction_id") == 1 and plan.count("FileScan") == 1


def test_driver_contract(spark):
    import __spark_entry__ as contract

    assert set(QUERIES) <= set(contract.oracle_sql()) <= set(contract.queries())


@pytest.mark.parametrize("report", [finance.results_detail_with_jackpots, finance.results_detail_without_jackpots])
def test_results_detail_in_its_final_order(spark, report):
    rows = report(catalog(spark, SF), PERIOD, ordered=True).collect()
    keys = [[(v is None, v or "") if v is None or isinstance(v, str) else (False, v) for v in r[:11]] for r in rows]
    assert rows and keys == sorted(keys)


def test_game_report_in_its_final_order(spark):
    rows = activity.game_report(catalog(spark, SF), PERIOD, ordered=True).collect()
    keys = [[(r[c] is None, r[c] or "") for c in r.__fields__[:2] + GAME_KEYS] for r in rows]
    assert rows and keys == sorted(keys)


def test_plain_results_detail_takes_the_models_it_is_given(spark):
    t = catalog(spark, SF)
    own = finance.results_detail_without_jackpots(t, PERIOD)
    given = finance.results_detail_without_jackpots(
        t,
        PERIOD,
        free_bets=free_bet_ids(t.accounting),
        free_bets_wagered=bets.free_bets_wagered(t.bets, PERIOD, tz=PERIOD.tz),
        resettled=resettlement_rollup(resettlement(t.accounting, t.bet_states, PERIOD, tz=PERIOD.tz)),
        free_rounds=casino.free_rounds_wagered(t.casino_wagers, t.patron_transactions, PERIOD, tz=PERIOD.tz),
        free_rounds_rolled_back=casino.casino_rollbacks(
            t.casino_wager_rollbacks, t.wager_and_game_info, PERIOD, tz=PERIOD.tz, patron_transactions=t.patron_transactions, promo=True
        ),
        later_states=t.bet_states,
    )
    assert given.exceptAll(own).isEmpty() and own.exceptAll(given).isEmpty()
    # what is given is what is used
    none = finance.results_detail_without_jackpots(t, PERIOD, free_rounds=casino.free_rounds_wagered(t.casino_wagers, t.patron_transactions, PERIOD, tz=PERIOD.tz).where("false"))
    assert none.count() < own.count()


def test_casino_report_works_out_its_rounds_once(spark):
    plan = QUERIES["r06_casino_ggr"](spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    # for the free rounds that won and for the cash rounds, which bring their jackpots along
    assert plan.count("$.game_provider") == 2


@pytest.mark.parametrize("report", ["r10_high_value_deposits", "r11_non_earning_occupation", "r12_non_earning_rolling"])
def test_sorted_reports_sort_stored_rows(spark, report):
    plan = QUERIES[report](spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    assert "Sort" in plan and "Join" not in plan
