"""The domain tables, derived from the shared test tables.

The test tables hold no gaming ledger, so every domain table is stated once as a SELECT over
them, in SQL that both Spark and the checking engine read. ``{name}`` refers to another table;
@ntz is the zone-free timestamp type, @each(n) yields the numbers 1..n as rows.
"""

from __future__ import annotations

import re
from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession

from tallybook.lineage import freed_shuffles, shared_folder
from tallybook.sources.catalog import Catalog

RAW = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")

# a backslash, which the two engines read differently inside quotes
_BS = "chr(92)"

DERIVED: dict[str, str] = {
    # every order line is one patron transaction; code picks what kind, at a pseudo-random hour
    "lines": """
        SELECT CAST(l.l_orderkey AS STRING) AS order_id,
               'X' || CAST(l.l_orderkey AS STRING) || '-' || CAST(l.l_linenumber AS STRING)
                   || '-' || CAST(l.l_partkey AS STRING) || '-' || CAST(l.l_suppkey AS STRING) AS tx_id,
               CAST(o.o_custkey AS STRING) AS patron_id,
               l.l_linenumber AS line_no, l.l_partkey AS part_no, l.l_suppkey AS supp_no,
               l.l_returnflag AS flag, l.l_linestatus AS side,
               CAST(round(l.l_extendedprice * 100) AS BIGINT) AS cents,
               (l.l_partkey * 7 + l.l_suppkey) % 20 AS code,
               l.l_shipdate AS ship_day,
               l.l_shipdate + INTERVAL '1' HOUR * CAST(l.l_suppkey % 24 AS INT)
                            + INTERVAL '1' MINUTE * CAST(l.l_partkey % 60 AS INT) AS tx_at
        FROM {lineitem} l JOIN {orders} o ON l.l_orderkey = o.o_orderkey
    """,
    # a casino line is a round: a wager and, mostly, the payout or rollback that ends it
    "rounds": """
        SELECT patron_id, part_no, supp_no, line_no, cents, flag, ship_day,
               tx_id || '-w' AS wager_id,
               CASE WHEN side = 'F' THEN tx_id || '-p' WHEN line_no <= 3 THEN tx_id || '-r' END AS end_id,
               CASE WHEN side = 'F' THEN 'payout' WHEN line_no <= 3 THEN 'rollback' END AS end_type,
               CASE WHEN side <> 'F' THEN cents WHEN line_no = 6 THEN 0 ELSE cents + 250 END AS end_cents,
               CASE WHEN flag = 'A' THEN 'FR' || CAST(supp_no AS STRING) END AS award_id,
               tx_at AS wager_at,
               tx_at + INTERVAL '1' SECOND * CAST(part_no % 5400 AS INT) AS end_at
        FROM {lines} WHERE code BETWEEN 11 AND 14
    """,
    "casino_tx": """
        SELECT patron_id, part_no, supp_no, line_no, ship_day, wager_id AS tx_id, CAST(NULL AS STRING) AS parent_id,
               'wager' AS type, cents, award_id, wager_at AS tx_at
        FROM {rounds}
        UNION ALL
        SELECT patron_id, part_no, supp_no, line_no, ship_day, end_id, wager_id, end_type, end_cents, award_id, end_at
        FROM {rounds} WHERE end_id IS NOT NULL
    """,
    # legs 1 and 2 debit and credit the transaction, 3 and 4 the end of a casino round, 5 is leg 1 posted again
    "accounting": """
        SELECT 'L' || order_id AS ledger_transaction_id,
               CASE WHEN code BETWEEN 11 AND 14
                    THEN tx_id || CASE WHEN leg <= 2 THEN '-w' WHEN side = 'F' THEN '-p' ELSE '-r' END
                    ELSE tx_id END AS patron_transaction_id,
               CASE WHEN code BETWEEN 11 AND 14
                    THEN tx_id || CASE WHEN leg <= 2 THEN '-w' WHEN side = 'F' THEN '-p' ELSE '-r' END
                    ELSE tx_id END AS p_id,
               CASE WHEN code BETWEEN 11 AND 14 AND leg > 2 THEN tx_id || '-w' END AS parent_id,
               patron_id AS a_patron_id, patron_id AS p_patron_id,
               CASE WHEN code <= 10 THEN 'H' || order_id END AS bet_history_id,
               CASE WHEN code <= 10 AND line_no = 2 THEN order_id END AS p_bet_id,
               CASE WHEN code <= 10 AND line_no <> 2 THEN order_id END AS p_vegas_bet_id,
               CASE WHEN leg IN (1, 3, 5) THEN
                        CASE WHEN code <= 3 OR code = 7 OR code = 16 THEN 'customer_liability'
                             WHEN code = 4 THEN 'sportsbook_promo_expense'
                             WHEN code <= 6 THEN 'sportsbook_house_wins'
                             WHEN code <= 10 THEN CASE flag WHEN 'A' THEN 'customer_liability'
                                                            WHEN 'N' THEN 'sportsbook_house_wins'
                                                            ELSE 'sportsbook_unsettled_bets' END
                             WHEN code <= 14 THEN CASE WHEN leg = 3 THEN 'casino_house_wins'
                                                       WHEN flag = 'A' THEN 'casino_bonus_expense'
                                                       ELSE 'customer_liability' END
                             WHEN code = 15 THEN 'clearing_deposits'
                             WHEN code = 17 THEN 'clearing_withdrawals'
                             WHEN code = 18 THEN CASE WHEN flag = 'A' THEN 'customer_liability' ELSE 'adjustments' END
                             WHEN line_no IN (2, 4) THEN 'customer_liability'
                             ELSE 'clearing_other' END
                    ELSE
                        CASE WHEN code <= 4 THEN 'sportsbook_unsettled_bets'
                             WHEN code <= 6 THEN 'customer_liability'
                             WHEN code = 7 THEN 'sportsbook_house_wins'
                             WHEN code <= 10 THEN CASE flag WHEN 'A' THEN 'sportsbook_house_wins'
                                                            WHEN 'N' THEN 'customer_liability'
                                                            ELSE CASE WHEN side = 'F' THEN 'sportsbook_house_wins'
                                                                      ELSE 'customer_liability' END END
                             WHEN code <= 14 THEN CASE WHEN leg = 4 THEN 'customer_liability'
                                                       ELSE 'casino_house_wins' END
                             WHEN code = 15 THEN 'customer_liability'
                             WHEN code = 16 THEN 'clearing_withdrawals'
                             WHEN code = 17 THEN 'customer_liability'
                             WHEN code = 18 THEN CASE WHEN flag = 'A' THEN 'adjustments' ELSE 'customer_liability' END
                             WHEN line_no IN (2, 4) THEN 'clearing_other'
                             ELSE 'customer_liability' END
               END AS a_type,
               p_type,
               CASE WHEN code <= 3 THEN 'sportsbook_bet' WHEN code = 16 THEN 'withdrawal' ELSE p_type END AS t_type,
               CASE WHEN supp_no % 13 = 0 THEN 'US-NJ' ELSE 'CA-ON' END AS gaming_state,
               CASE WHEN code = 18 THEN CASE line_no % 3 WHEN 0 THEN '9998' WHEN 1 THEN '9990' END END AS adjustment_reason,
               CASE WHEN code = 18 THEN CASE WHEN flag = 'A' THEN '"cash_withdrawal"' ELSE '"cash_deposit"' END END
                   AS adjustment_type,
               CASE WHEN leg IN (1, 5) THEN cents WHEN leg = 3 THEN end_cents ELSE 0 END AS debit_cents,
               CASE WHEN leg = 2 THEN cents - CASE WHEN line_no = 7 THEN 1 ELSE 0 END
                    WHEN leg = 4 THEN end_cents ELSE 0 END AS credit_cents,
               CASE WHEN leg IN (3, 4) THEN tx_at + INTERVAL '1' SECOND * CAST(part_no % 5400 AS INT) ELSE tx_at END
                   AS t_changed_at
        FROM (
            SELECT g.*,
                   CASE WHEN code <= 3 THEN 'sportsbook_bet'
                        WHEN code = 4 THEN 'sportsbook_free_bet'
                        WHEN code = 5 THEN 'sportsbook_payout'
                        WHEN code = 6 THEN 'sportsbook_cash_out_bet'
                        WHEN code = 7 THEN 'sportsbook_bet_lost'
                        WHEN code = 8 THEN 'sportsbook_bet_resettlement'
                        WHEN code = 9 THEN CASE WHEN line_no <= 3 THEN 'sportsbook_bet_resettlement'
                                                ELSE 'sportsbook_bet_ungrade' END
                        WHEN code = 10 THEN 'sportsbook_bet_void'
                        WHEN code <= 14 AND leg <= 2 THEN CASE WHEN flag = 'A' THEN 'casino_free_wager'
                                                               ELSE 'casino_wager' END
                        WHEN code <= 14 THEN CASE WHEN side = 'F' THEN 'casino_payout' ELSE 'casino_rollback' END
                        WHEN code = 15 THEN 'deposit'
                        WHEN code = 16 THEN 'withdrawal'
                        WHEN code = 17 THEN CASE WHEN flag = 'R' THEN 'withdrawal_decline'
                                                 ELSE 'withdrawal_cancellation' END
                        WHEN code = 18 THEN CASE WHEN flag = 'N' THEN 'amendment_rg' ELSE 'amendment' END
                        WHEN line_no = 2 THEN 'region_transfer_out'
                        WHEN line_no = 3 THEN 'bonus_offer_payout'
                        WHEN line_no = 4 THEN 'bonus_offer_revoked'
                        WHEN line_no = 5 THEN 'cash_deposit'
                        ELSE 'region_transfer_in' END AS p_type,
                   CASE WHEN side <> 'F' THEN cents WHEN line_no = 6 THEN 0 ELSE cents + 250 END AS end_cents
            FROM (SELECT l.*, @each(5) AS leg FROM {lines} l) g
            WHERE leg <= 2
               OR (leg <= 4 AND code BETWEEN 11 AND 14 AND (side = 'F' OR line_no <= 3))
               OR (leg = 5 AND code <= 3 AND line_no = 5)
        ) p
    """,
    "bets": """
        SELECT CAST(o_orderkey AS STRING) AS id, CAST(o_custkey AS STRING) AS patron_id,
               CASE WHEN o_orderkey % 10 = 0 THEN 'parlay' WHEN o_orderkey % 10 = 5 THEN 'parlay_plus'
                    ELSE 'straight' END AS type,
               CASE o_orderstatus WHEN 'F' THEN 'settled' WHEN 'O' THEN 'open' ELSE 'voided' END AS status,
               CASE o_orderkey % 3 WHEN 0 THEN 'win' WHEN 1 THEN 'loss' ELSE 'push' END AS outcome,
               CASE WHEN o_orderpriority = '1-URGENT' THEN 'FB' || CAST(o_orderkey AS STRING) END AS free_bet_id,
               CASE WHEN o_orderpriority = '2-HIGH' AND o_orderkey % 7 = 0
                    THEN 'PE' || CAST(o_orderkey AS STRING) END AS promo_engine_free_bet_id,
               'CA-ON' AS gaming_state,
               CAST(round(o_totalprice * 100) AS BIGINT) AS bet_amount_cents,
               CAST(round(o_totalprice * 100) AS BIGINT)
                   * CASE o_orderkey % 3 WHEN 0 THEN 2 WHEN 1 THEN 0 ELSE 1 END AS payout_amount_cents,
               CAST(round(o_totalprice * 100) AS BIGINT)
                   * CASE o_orderkey % 3 WHEN 0 THEN 1 ELSE 0 END AS win_amount_cents,
               o_orderdate + INTERVAL '1' HOUR * CAST(o_orderkey % 24 AS INT)
                           + INTERVAL '1' MINUTE * CAST(o_custkey % 60 AS INT) AS placed_at,
               CASE WHEN o_orderstatus <> 'O'
                    THEN o_orderdate + INTERVAL '1' HOUR * CAST(o_orderkey % 24 + o_custkey % 72 AS INT)
                                     + INTERVAL '1' MINUTE * CAST(o_custkey % 60 AS INT) END AS closed_at,
               o_orderkey % 29 = 0 AS regraded
        FROM {orders}
    """,
    # three versions of every bet; some of the newest lack the second clock, some tie with the one before
    "bets_history": """
        SELECT id, patron_id, type, CASE WHEN version = 3 THEN status ELSE 'open' END AS status, outcome,
               free_bet_id, promo_engine_free_bet_id,
               CAST(1 + bet_amount_cents % 400 AS DECIMAL(20, 4)) AS price,
               bet_amount_cents, win_amount_cents,
               payout_amount_cents + version AS payout_amount_cents,
               placed_at, closed_at,
               placed_at + INTERVAL '1' HOUR
                   * CAST(CASE WHEN version = 3 AND bet_amount_cents % 11 = 0 THEN 2 ELSE version END AS INT) AS _changed_at,
               CASE WHEN version = 3 AND bet_amount_cents % 13 = 0 THEN NULL
                    ELSE placed_at + INTERVAL '1' HOUR
                         * CAST(CASE WHEN version = 3 AND bet_amount_cents % 11 = 0 THEN 2 ELSE version END AS INT) END
                   AS updated_at
        FROM (SELECT b.*, @each(3) AS version FROM {bets} b) v
    """,
    "bet_states": """
        SELECT 'H' || CAST(o_orderkey AS STRING) AS bet_history_id,
               CASE o_orderkey % 6 WHEN 0 THEN 'voided' WHEN 1 THEN 'refund' WHEN 2 THEN 'win' WHEN 3 THEN 'loss'
                                   WHEN 4 THEN 'push' ELSE 'open' END AS state,
               CASE o_custkey % 7 WHEN 0 THEN 'open' WHEN 1 THEN 'loss' WHEN 2 THEN 'win' WHEN 3 THEN 'push'
                                  WHEN 4 THEN 'refund' WHEN 5 THEN 'voided' ELSE 'open' END AS previous_state,
               CASE WHEN o_orderpriority = '1-URGENT' THEN 'FB' || CAST(o_orderkey AS STRING) END AS free_bet_id,
               CASE WHEN o_orderpriority = '2-HIGH' AND o_orderkey % 7 = 0
                    THEN 'PE' || CAST(o_orderkey AS STRING) END AS promo_engine_free_bet_id,
               CAST(1 + o_custkey % 3 AS INT) AS previous_ordinal,
               o_orderdate + INTERVAL '1' HOUR * 40 AS new_timestamp,
               o_orderdate + INTERVAL '1' HOUR * CAST(CASE WHEN o_orderkey % 4 < 2 THEN 30 ELSE 14 END AS INT)
                   AS new_previous_timestamp
        FROM {orders}
    """,
    # straights have a leg, save some without any; parlays have two
    "legs": f"""
        SELECT CAST(o_orderkey AS STRING) AS vegas_bet_id,
               '{{{{"name": "Moneyline ' || {_BS} || '| ' || o_orderpriority || '"}}}}' AS market,
               CASE o_custkey % 6 WHEN 0 THEN 'main' WHEN 1 THEN 'player_prop' WHEN 2 THEN 'game_prop'
                                  WHEN 3 THEN 'future' WHEN 4 THEN 'promo' ELSE 'other' END AS market_classification,
               '{{{{"name": "' || CASE WHEN o_custkey % 9 = 0 THEN '' ELSE 'Home ' || {_BS} || '| Away '
                                    || CAST(o_custkey AS STRING) END || '", "start_time": "'
                   || CASE WHEN o_custkey % 8 = 0 THEN 'later' ELSE CAST(CAST(o_orderdate AS DATE) AS STRING)
                                    || ' 18:30:00' END
                   || '", "sport": "{{{{' || {_BS} || '"name' || {_BS} || '": ' || {_BS} || '"ice hockey' || {_BS} || '"}}}}"'
                   || ', "competition": "{{{{' || {_BS} || '"name' || {_BS} || '": ' || {_BS} || '"league '
                   || CAST(o_orderkey % 4 AS STRING) || {_BS} || '"}}}}"}}}}' AS event,
               CASE WHEN o_orderkey % 2 = 0 THEN 'home' ELSE 'away' END AS market_selection_name,
               CAST(CASE WHEN o_orderkey % 5 = 0 THEN 2 ELSE 1 END AS INT) AS num_legs,
               CAST(CASE WHEN o_custkey % 3 = 0 THEN 0 WHEN o_custkey % 3 = 1 THEN leg ELSE 1 END AS INT)
                   AS num_live_legs
        FROM (SELECT o.*, @each(2) AS leg FROM {{orders}} o) x
        WHERE leg = 1 AND o_orderkey % 19 <> 3 OR o_orderkey % 5 = 0
    """,
    "wager_and_game_info": """
        SELECT t.tx_id AS patron_transaction_id, t.patron_id, t.parent_id, t.type,
               CAST(t.part_no AS STRING) AS game_id, p.p_name AS game_name,
               CASE p.p_type WHEN 'STANDARD' THEN 'slots' WHEN 'MEDIUM' THEN 'table' WHEN 'PROMO' THEN 'roulette'
                             WHEN 'ECONOMY' THEN 'live' WHEN 'LARGE' THEN 'bingo' END AS game_category,
               'S' || t.patron_id || '-' || CAST(CAST(t.ship_day AS DATE) AS STRING) AS casino_session_id,
               t.award_id AS promo_engine_free_round_award_id, t.cents AS amount_cents,
               t.tx_at AS transaction_timestamp_utc
        FROM {casino_tx} t LEFT JOIN {part} p ON t.part_no = p.p_partkey
    """,
    "patron_transactions": """
        SELECT tx_id AS id, patron_id, tx_at AS _changed_at FROM {casino_tx}
    """,
    "casino_wagers": """
        SELECT t.tx_id AS patron_transaction_id, t.award_id AS promo_engine_free_round_award_id,
               CASE WHEN t.supp_no % 13 = 0 THEN 'US-NJ' ELSE 'CA-ON' END AS gaming_state,
               '{{"game_name": "' || p.p_name || CASE WHEN p.p_partkey % 5 = 0 THEN '_R3' ELSE '' END
                   || '", "game_category": "' || lower(p.p_type) || '", "game_provider": "' || p.p_brand || '"}}' AS metadata,
               t.cents AS amount_cents, t.tx_at AS _changed_at
        FROM {casino_tx} t LEFT JOIN {part} p ON t.part_no = p.p_partkey
        WHERE t.type = 'wager'
    """,
    "casino_payouts": """
        SELECT tx_id AS patron_transaction_id, award_id AS promo_engine_free_round_award_id,
               CASE WHEN supp_no % 13 = 0 THEN 'US-NJ' ELSE 'CA-ON' END AS gaming_state,
               cents AS amount_cents, tx_at AS _changed_at
        FROM {casino_tx} WHERE type = 'payout'
    """,
    "casino_wager_rollbacks": """
        SELECT tx_id AS patron_transaction_id, tx_at + INTERVAL '1' MINUTE * 5 AS _changed_at
        FROM {casino_tx} WHERE type = 'rollback'
    """,
    "rollback_payout_info": """
        SELECT tx_id AS patron_transaction_id, CAST(part_no AS STRING) AS game_id
        FROM {casino_tx} WHERE type = 'rollback'
    """,
    "games": """
        SELECT CAST(p_partkey AS STRING) AS id,
               p_name || CASE WHEN p_partkey % 5 = 0 THEN '_R3' ELSE '' END AS name,
               p_brand AS game_provider, lower(p_type) AS category,
               CASE p_type WHEN 'STANDARD' THEN 'S' WHEN 'MEDIUM' THEN 'V' WHEN 'PROMO' THEN 'roulette'
                           WHEN 'ECONOMY' THEN 'live' WHEN 'LARGE' THEN 'table' END AS game_provider_game_category
        FROM {part}
    """,
    # two versions of every wallet row, the older with another amount
    "wallet_transactions": """
        SELECT 'W' || tx_id AS id, 'provider-' || CAST(supp_no % 4 AS STRING) AS game_provider,
               'round-' || tx_id AS game_provider_game_round_id, 'gp-' || tx_id AS game_provider_transaction_id,
               'W' || parent_id AS parent_wallet_transaction_id, tx_id AS remote_wallet_transaction_id,
               'session-' || patron_id AS game_session_id, award_id AS free_round_award_id,
               patron_id AS identity_user_id,
               CASE WHEN version = 2 THEN cents ELSE cents + 100 END AS amount,
               tx_at + INTERVAL '1' MINUTE * CAST(version AS INT) AS _changed_at,
               tx_at + INTERVAL '1' MINUTE * CAST(version AS INT) AS updated_at
        FROM (SELECT t.*, @each(2) AS version FROM {casino_tx} t) v
    """,
    "wallet_transaction_jackpots": """
        SELECT 'W' || tx_id AS wallet_transaction_id, 'J' || CAST(part_no % 5 AS STRING) AS jackpot_id,
               CASE WHEN type = 'wager' THEN 'contribution' ELSE 'win' END AS type,
               CASE WHEN type = 'wager' THEN 0
                    WHEN line_no = 4 THEN CAST((cents - cents % 100) / 100 AS BIGINT) ELSE part_no % 50 END AS amount_units,
               CASE WHEN type = 'wager' THEN part_no * 12345
                    WHEN line_no = 4 THEN (cents % 100) * 10000000 + 5000000 ELSE supp_no * 1000001 END AS amount_nanos,
               tx_at AS inserted_at,
               tx_at + INTERVAL '1' MINUTE * CAST(version AS INT) AS _changed_at,
               tx_at + INTERVAL '1' MINUTE * CAST(version AS INT) AS updated_at
        FROM (SELECT t.*, @each(2) AS version FROM {casino_tx} t) v
        WHERE (type = 'wager' AND supp_no % 3 = 0) OR (type = 'payout' AND supp_no % 5 = 0)
    """,
    "jackpots": """
        SELECT 'J' || CAST(r_regionkey AS STRING) AS id,
               CASE WHEN version = 1 THEN 'old ' ELSE '' END || r_name AS display_name,
               CAST('1994-01-01 00:00:00' AS @ntz) + INTERVAL '1' DAY * CAST(version AS INT) AS _changed_at,
               CAST('1994-01-01 00:00:00' AS @ntz) + INTERVAL '1' DAY * CAST(version AS INT) AS updated_at
        FROM (SELECT r.*, @each(2) AS version FROM {region} r) v
    """,
    "users": """
        SELECT CAST(c.c_custkey AS STRING) AS patron_id, 'C' || CAST(c.c_custkey AS STRING) AS customer_id,
               c.c_name AS username, c.c_mktsegment AS first_name, n.n_name AS last_name,
               CASE c.c_custkey % 3 WHEN 0 THEN 'male' WHEN 1 THEN 'female' END AS gender,
               CASE c.c_mktsegment WHEN 'HOUSEHOLD' THEN 'homemaker' WHEN 'MACHINERY' THEN 'retired'
                                   WHEN 'BUILDING' THEN 'employed' WHEN 'FURNITURE' THEN 'student' END AS employment_status,
               c.c_mktsegment AS job_title, n.n_name AS employer_name,
               DATE '1950-01-01' + CAST(c.c_custkey % 18000 AS INT) AS birthdate,
               CASE WHEN c.c_custkey % 50 = 7 THEN TRUE WHEN c.c_custkey % 97 = 1 THEN NULL ELSE FALSE END AS is_tester,
               CAST('1995-01-01 03:00:00' AS @ntz) + INTERVAL '1' DAY * CAST(c.c_custkey % 2000 AS INT) AS inserted_at,
               CASE WHEN c.c_custkey % 11 <> 0
                    THEN CAST('1995-01-01 05:00:30' AS @ntz) + INTERVAL '1' DAY * CAST(c.c_custkey % 2000 AS INT) END
                   AS registration_completed_at,
               CAST('1996-03-01 02:00:00' AS @ntz) + INTERVAL '1' DAY * CAST(c.c_custkey % 2000 AS INT)
                   + INTERVAL '1' HOUR * CAST(c.c_custkey % 13 AS INT) AS last_login_at
        FROM {customer} c JOIN {nation} n ON c.c_nationkey = n.n_nationkey
    """,
    "account_users": """
        SELECT patron_id AS id, first_name, last_name, birthdate, inserted_at, last_login_at, registration_completed_at
        FROM {users}
    """,
    "kyc_verifications": """
        SELECT CAST(c_custkey AS STRING) AS user_id,
               CASE c_custkey % 4 WHEN 0 THEN 'success' WHEN 1 THEN 'approved' WHEN 2 THEN 'rejected' ELSE 'pending' END
                   AS status,
               CASE WHEN c_custkey % 9 <> 0 THEN 'passport' END AS document_type,
               'D' || CAST(c_custkey * 17 AS STRING) AS document_reference_number,
               DATE '2001-01-01' + CAST(c_custkey % 900 AS INT) AS document_expiration_date
        FROM {customer}
    """,
    "emails": """
        SELECT CAST(c_custkey AS STRING) AS user_id, 'p' || CAST(c_custkey AS STRING) || '@example.test' AS email
        FROM {customer} WHERE c_custkey % 6 <> 1
    """,
    "addresses": """
        SELECT CAST(c.c_custkey AS STRING) AS user_id, CAST(c.c_custkey AS STRING) || ' ' || lower(r.r_name) || ' street'
                   AS line_1,
               CASE WHEN c.c_custkey % 5 = 0 THEN 'unit 2' END AS line_2,
               'north ' || lower(r.r_name) AS city, r.r_name AS region,
               'M' || CAST(c.c_custkey % 10 AS STRING) || 'X 1Y' || CAST(c.c_custkey % 7 AS STRING) AS postal_code
        FROM {customer} c JOIN {nation} n ON c.c_nationkey = n.n_nationkey
                          JOIN {region} r ON n.n_regionkey = r.r_regionkey
        WHERE c.c_custkey % 8 <> 3
    """,
    "phone_numbers": """
        SELECT CAST(c_custkey AS STRING) AS user_id, '555-' || CAST(c_custkey AS STRING) AS number
        FROM {customer} WHERE c_custkey % 4 <> 2 OR c_custkey % 3 = 0
    """,
    "break_status": """
        SELECT CAST(c_custkey AS STRING) AS patron_id, '19980101' AS BreakStart,
               CASE WHEN c_custkey % 2 = 0 THEN '19980201' END AS BreakEnd
        FROM {customer} WHERE c_custkey % 17 = 3
    """,
    "self_exclusion_status": """
        SELECT CAST(c_custkey AS STRING) AS patron_id, '19990101' AS SEStart, '20000101' AS SEEnd
        FROM {customer} WHERE c_custkey % 23 = 4
    """,
    "bonus_transactions": """
        SELECT CAST(o_custkey AS STRING) AS user_id,
               CASE o_orderpriority WHEN '3-MEDIUM' THEN 'Bonus Playthrough'
                                    WHEN '2-HIGH' THEN 'bonus playthrough cancellation' ELSE 'Bonus Award' END
                   AS transaction_type,
               o_orderkey % 5000 - 2000 AS transaction_amount,
               o_orderdate + INTERVAL '1' HOUR * CAST(o_orderkey % 24 AS INT) AS transaction_timestamp_utc
        FROM {orders}
    """,
    "user_award_bonus_cash": """
        SELECT 'BC' || CAST(o_orderkey AS STRING) AS id, CAST(o_custkey AS STRING) AS user_id,
               CAST(round(o_totalprice) AS BIGINT) AS amount_cents, o_orderdate + INTERVAL '1' DAY * 40 AS expires_at
        FROM {orders}
    """,
    "user_bonus_cash_transactions": """
        SELECT 'BC' || order_id AS user_award_bonus_cash_id,
               CASE flag WHEN 'R' THEN 'unlock' ELSE 'revoke' END AS transaction_type,
               cents AS amount_cents, tx_at AS t_changed_at
        FROM {lines}
    """,
    "user_award_free_bets": """
        SELECT 'FB' || CAST(o_orderkey AS STRING) AS id, CAST(o_custkey AS STRING) AS user_id,
               'AB' || CAST((o_orderkey + version) % 30 AS STRING) AS award_free_bet_id,
               o_orderdate + INTERVAL '1' HOUR * 9 AS awarded_at,
               CASE WHEN version = 2 AND o_orderkey % 5 = 0 THEN NULL
                    ELSE o_orderdate + INTERVAL '1' HOUR * CAST(version AS INT) END AS updated_at
        FROM (SELECT o.*, @each(2) AS version FROM {orders} o) v
        WHERE o_orderpriority = '1-URGENT' AND o_custkey % 6 <> 0
    """,
    "user_award_free_wagers": """
        SELECT 'FR' || CAST(s_suppkey AS STRING) AS id, CAST(s_nationkey AS STRING) AS user_id,
               'AW' || CAST((s_suppkey + version) % 25 AS STRING) AS award_free_wager_id,
               CAST('1995-06-01 03:30:00' AS @ntz) + INTERVAL '1' DAY * CAST(s_suppkey % 900 AS INT) AS awarded_at,
               CAST('1995-06-01 00:00:00' AS @ntz) + INTERVAL '1' DAY * CAST(version AS INT) AS updated_at
        FROM (SELECT s.*, @each(2) AS version FROM {supplier} s) v
        WHERE s_suppkey % 9 <> 2
    """,
    "award_free_bets": """
        SELECT 'AB' || CAST(n_nationkey AS STRING) AS id, 'PR' || CAST(n_nationkey % 6 AS STRING) AS promotion_id,
               CAST(n_nationkey * 500 AS BIGINT) AS amount_cents
        FROM {nation}
    """,
    "award_free_wagers": """
        SELECT 'AW' || CAST(n_nationkey AS STRING) AS id, 'PR' || CAST(n_nationkey % 4 AS STRING) AS promotion_id,
               CAST(n_nationkey * 250 AS BIGINT) AS amount_cents
        FROM {nation}
    """,
    "promotions": """
        SELECT 'PR' || CAST(r_regionkey AS STRING) AS id,
               'Promotion ' || r_name || ' v' || CAST(version AS STRING) AS name,
               CASE WHEN r_regionkey % 2 = 0 THEN 'reload' ELSE 'welcome' END AS promotion_type,
               CAST('1995-01-01 00:00:00' AS @ntz) + INTERVAL '1' DAY * CAST(version AS INT) AS updated_at
        FROM (SELECT r.*, @each(2) AS version FROM {region} r) v
    """,
    "payment_deposits": """
        SELECT tx_id AS deposit_id, 'PP' || CAST(supp_no % 25 AS STRING) AS provider_id, 'PC' || patron_id AS customer_id,
               CASE WHEN line_no <> 3 THEN '"' || lower(flag) || '-card"' END AS type,
               CASE WHEN line_no <> 5 THEN '"' || CAST(1000 + part_no % 9 AS STRING) || '"' END AS last_digits,
               CASE WHEN line_no = 1 AND side = 'O' THEN 'created' ELSE 'complete' END AS state,
               cents AS amount_requested_cents
        FROM {lines} WHERE code IN (15, 18)
    """,
    "payment_providers": """
        SELECT 'PP' || CAST(n_nationkey AS STRING) AS id, 'provider ' || CAST(n_nationkey % 12 AS STRING) AS name,
               'PM' || CAST(n_regionkey AS STRING) AS merchant_id
        FROM {nation}
    """,
    "payment_merchants": """
        SELECT 'PM' || CAST(r_regionkey AS STRING) AS id, lower(r_name) AS name FROM {region}
    """,
    "payment_customers": """
        SELECT 'PC' || CAST(c_custkey AS STRING) AS id, 'PU' || CAST(c_custkey AS STRING) AS user_id FROM {customer}
    """,
    "payment_users": """
        SELECT 'PU' || CAST(c_custkey AS STRING) AS id, CAST(c_custkey AS STRING) AS patron_id FROM {customer}
    """,
}

# tables many queries read are written once per session and read back as a stored table would be
# rows stay in the order they are made in: sorting them holds, and at size spills, whole tasks of wide rows
STORED = ("accounting", "casino_tx", "wager_and_game_info")

_REF = re.compile(r"(?<!\{)\{(\w+)\}(?!\})")


def _needs(name: str) -> list[str]:
    return list(dict.fromkeys(_REF.findall(DERIVED[name])))


def _dialect(sql: str, ntz: str, each: str) -> str:
    sql = sql.replace("@ntz", ntz)
    return re.sub(r"@each\((\d)\)", lambda m: each.format(", ".join(map(str, range(1, int(m[1]) + 1)))), sql)


_stored: dict[tuple[str, str, str], str] = {}


def _store(spark: SparkSession, sf_dir: str, name: str, frame: DataFrame) -> DataFrame:
    application = spark.sparkContext.applicationId
    key = (application, sf_dir, name)
    if key not in _stored:
        folder = shared_folder(spark)
        if folder is None:
            return frame
        place = f"{folder}/tables-{application}/{re.sub(r'[^A-Za-z0-9.]', '_', sf_dir)}/{name}"
        with freed_shuffles(spark):
            frame.write.mode("overwrite").option("compression", "zstd").parquet(place)
        _stored[key] = place
    return spark.read.parquet(_stored[key])


def catalog(spark: SparkSession, sf_dir: str) -> Catalog:
    """The domain tables over one directory of test tables."""

    def open_table(name: str) -> DataFrame:
        if name in RAW:
            return spark.read.parquet(f"{sf_dir}/{name}.parquet")
        if (spark.sparkContext.applicationId, sf_dir, name) in _stored:
            return _store(spark, sf_dir, name, None)
        needed = {n: getattr(tables, n) for n in _needs(name)}
        sql = _dialect(DERIVED[name], "TIMESTAMP_NTZ", "explode(array({0}))")
        frame = spark.sql(sql, **needed)
        return _store(spark, sf_dir, name, frame) if name in STORED else frame

    tables = Catalog(open_table)
    return tables


@lru_cache(maxsize=None)
def _closure(name: str) -> tuple[str, ...]:
    found: list[str] = []
    for needed in _needs(name):
        if needed in DERIVED:
            found += [n for n in _closure(needed) if n not in found]
    return (*found, name)


def with_tables(names: list[str], body: str) -> str:
    """SQL for the checking engine: the tables as leading WITH items, then the body.

    ``body`` either starts with WITH, which is merged, or is a plain SELECT.
    """
    ordered: list[str] = []
    for name in names:
        ordered += [n for n in _closure(name) if n not in ordered]
    items = []
    for name in ordered:
        sql = _dialect(DERIVED[name], "TIMESTAMP", "unnest([{0}])")
        sql = _REF.sub(lambda m: m[1], sql).replace("{{", "{").replace("}}", "}")
        items.append(f"{name} AS ({sql.strip()})")
    body = body.strip()
    if not items:
        return body
    if body[:5].upper() == "WITH ":
        return "WITH " + ",\n".join(items) + ",\n" + body[5:]
    return "WITH " + ",\n".join(items) + "\n" + body
