"""Times the headline queries and prints one JSON line.

The stored domain tables are built before timing starts, and every query runs once to warm up
and once for the clock. Results are consumed whole by a no-op sink.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tallybook.session import local_session  # noqa: E402
from testbed.queries import QUERIES  # noqa: E402
from testbed.tables import STORED, catalog  # noqa: E402

HEADLINE = (
    "b01_latest_version",
    "b01_bets_asof",
    "b07_match_legs",
    "b14_resettlement",
    "b18_transfer_to_sports",
    "b22_jackpot_model",
    "b25_bet_and_market",
    "b26_measure_stack",
    "b28_cash_balance",
    "b36_player_sessions",
    "b47_threshold_alerts",
    "b52_payment_profile",
    "b53_player_ggr",
    "b60_game_players",
    "b61_casino_payouts",
    "b61_free_round_payouts",
    "b61_game_payouts",
    "r01_results_detail",
    "r02_results_detail_plain",
    "r03_player_activity",
    "r04_game_activity",
    "r05_ggr_by_product",
    "r06_casino_ggr",
    "r07_used_free_wagers",
    "r10_high_value_deposits",
    "r11_non_earning_occupation",
    "r12_non_earning_rolling",
    "r13_account_sheet",
    "r14_bet_history",
)


def consume(frame) -> None:
    frame.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    chosen = sys.argv[1:] or HEADLINE
    spark = local_session(cpus, shuffle_partitions=int(cpus))
    tables = catalog(spark, sf_dir)
    started = time.time()
    for name in STORED:
        getattr(tables, name)
    stored = time.time() - started
    took: dict[str, float] = {}
    for key in chosen:
        for _ in range(2):
            started = time.time()
            consume(QUERIES[key](spark, sf_dir))
            took[key] = round(time.time() - started, 3)
        print(f"{key} {took[key]}", file=sys.stderr, flush=True)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(took.values()), 3),
                "unit": "sec",
                "queries": took,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
                "store_tables_sec": round(stored, 3),
                "cpus": cpus,
                "spark": spark.version,
            }
        )
    )


if __name__ == "__main__":
    main()
