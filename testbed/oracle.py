"""The same results in plain SQL, stated independently of the library.

FRAGMENTS are named relations over the derived tables, ``{name}`` refers to another fragment or
table; CHECKS gives the final SELECT of every query.
"""

from __future__ import annotations

import re

from tallybook.operators.settlement import RULES
from testbed.tables import DERIVED, with_tables

# the period of testbed.queries, in UTC and in local time
U0, U1 = "TIMESTAMP '1996-01-01 05:00:00'", "TIMESTAMP '2001-01-01 05:00:00'"
L0, L1 = "TIMESTAMP '1996-01-01'", "TIMESTAMP '2001-01-01'"


def local(col: str) -> str:
    return f"timezone('America/Toronto', timezone('UTC', {col}))"


def within(col: str, low: str = U0, high: str = U1) -> str:
    return f"({col} >= {low} AND {col} < {high})"


def usd(cents: str) -> str:
    return f"CAST(CAST({cents} AS DECIMAL(28,0)) * 0.01 AS DECIMAL(38,2))"


def exact(value: str) -> str:
    return f"CAST({value} AS DECIMAL(30,9))"


def big(value: str) -> str:
    return f"CAST({value} AS BIGINT)"


def day(ts: str) -> str:
    return f"CAST(date_trunc('day', {ts}) AS TIMESTAMP)"


def month(ts: str) -> str:
    return f"CAST(date_trunc('month', {ts}) AS TIMESTAMP)"


def second(ts: str) -> str:
    return f"CAST(date_trunc('second', {ts}) AS TIMESTAMP)"


def share(top: str, bottom: str) -> str:
    """Quotient of two positive integers to six decimals, half up."""
    return (
        f"CAST(CAST((CAST({top} AS HUGEINT) * 2000000 + {bottom}) // (2 * CAST({bottom} AS HUGEINT)) AS DECIMAL(30,0))"
        " * 0.000001 AS DECIMAL(38,6))"
    )


def capital(col: str) -> str:
    return f"(upper(substr({col}, 1, 1)) || lower(substr({col}, 2)))"


def initcap(col: str) -> str:
    return (
        f"array_to_string(list_transform(string_split({col}, ' '), lambda w: upper(substr(w, 1, 1)) || lower(substr(w, 2))), ' ')"
    )


BET = "COALESCE(p_vegas_bet_id, p_bet_id)"
LIABLE = "a_type = 'customer_liability'"
NET = "sum(credit_cents) - sum(debit_cents)"
SPORTS_TYPES = "('sportsbook_cash_out_bet', 'sportsbook_payout', 'sportsbook_bet_lost')"
REAL = "patron_id IN (SELECT patron_id FROM {users} WHERE is_tester = FALSE)"


def legs(side: str, where: str, ref: str, extra: str = "") -> str:
    return f"""SELECT DISTINCT ledger_transaction_id, a_patron_id AS patron_id, a_type AS account,
        {side}_cents AS cents, t_changed_at AS posted_at, {ref} AS ref_id{extra}
        FROM {{accounting}} WHERE {side}_cents > 0 AND {where}"""


def paired(debit: str, credit: str, keys: str) -> str:
    return f"""SELECT {keys}, {big('sum(d.cents)')} AS cents
        FROM {{{debit}}} d JOIN {{{credit}}} c
          ON d.ledger_transaction_id = c.ledger_transaction_id AND d.cents = c.cents
        GROUP BY ALL"""


def rule_rows() -> str:
    """The decision table as rows; a missing test is NULL."""

    def text(values) -> str:
        return "NULL" if not values else "[" + ", ".join(f"'{v}'" for v in values) + "]"

    def flag(value) -> str:
        return "CAST(NULL AS BOOLEAN)" if value is None else str(value).upper()

    rows = [
        f"({i}, '{r.amount}', {text(r.state)}, {text(r.not_state)}, {text(r.previous)}, {text(r.not_previous)}, "
        f"{flag(r.promo)}, {text(r.accounts)}, {flag(r.same_day)})"
        for i, r in enumerate(RULES)
    ]
    names = "n, amount, st, not_st, prev, not_prev, promo, accounts, same_day"
    return f"SELECT * FROM (VALUES {', '.join(rows)}) AS r({names})"


FRAGMENTS: dict[str, str] = {
    # snapshots: newest first clock, then newest second clock, joined back by equality
    "rules": rule_rows(),
    "ledger_w": f"SELECT * FROM {{accounting}} WHERE {within('t_changed_at')}",
    "ledger_on": "SELECT * FROM {ledger_w} WHERE gaming_state = 'CA-ON'",
    "real_users": "SELECT patron_id FROM {users} WHERE is_tester = FALSE",
    "start_users": f"SELECT * FROM {{users}} WHERE inserted_at < {U0}",
    "free_ids": f"SELECT DISTINCT {BET} AS bet_id FROM {{accounting}} WHERE p_type = 'sportsbook_free_bet'",
    "free_w": f"""SELECT {local('placed_at')} AS ts, patron_id, id AS bet_id, {big('sum(bet_amount_cents)')} AS cents
        FROM {{bets}} WHERE free_bet_id IS NOT NULL AND {within('placed_at')} GROUP BY ALL""",
    "voided_w": f"""SELECT {local('closed_at')} AS ts, patron_id, id AS bet_id, free_bet_id IS NOT NULL AS is_promo,
        {big('sum(bet_amount_cents)')} AS cents
        FROM {{bets}} WHERE status = 'voided' AND {within('closed_at')} GROUP BY ALL""",
    "pending_w": f"""SELECT patron_id, id AS bet_id, free_bet_id IS NOT NULL AS is_promo,
        {big('sum(bet_amount_cents)')} AS cents, {L0} AS ts
        FROM {{bets}} WHERE status = 'open' AND placed_at < {U1} GROUP BY ALL""",
    # settlement
    "settle_groups": f"""SELECT {local('t_changed_at')} AS ts, a_patron_id AS patron_id, {BET} AS bet_id,
        COALESCE(s.promo_engine_free_bet_id, s.free_bet_id) AS promo_id, s.state, s.previous_state, a_type AS account,
        new_timestamp, new_previous_timestamp, p.gaming_state, sum(debit_cents) AS debits, sum(credit_cents) AS credits
        FROM {{accounting}} p JOIN {{bet_states}} s USING (bet_history_id)
        WHERE p_type IN ('sportsbook_bet_resettlement', 'sportsbook_bet_ungrade', 'sportsbook_bet_void')
        GROUP BY ALL""",
    "settle_ruled": """SELECT g.*, (SELECT min(n) FROM {rules} r
            WHERE (r.st IS NULL OR list_contains(r.st, g.state))
              AND (r.not_st IS NULL OR NOT list_contains(r.not_st, g.state))
              AND (r.prev IS NULL OR list_contains(r.prev, g.previous_state))
              AND (r.not_prev IS NULL OR NOT list_contains(r.not_prev, g.previous_state))
              AND (r.promo IS NULL OR r.promo = (g.promo_id IS NOT NULL))
              AND (r.accounts IS NULL OR list_contains(r.accounts, g.account))
              AND (r.same_day IS NULL
                   OR r.same_day = (CAST(g.new_timestamp AS DATE) = CAST(g.new_previous_timestamp AS DATE)))) AS n
        FROM {settle_groups} g""",
    "settle_all": f"""SELECT ts, patron_id, bet_id, promo_id, state, previous_state, account, gaming_state,
        {big('''COALESCE(CASE r.amount WHEN 'credits' THEN credits WHEN '-credits' THEN -credits WHEN 'debits' THEN debits
             WHEN '-debits' THEN -debits WHEN 'net' THEN debits - credits WHEN '-net' THEN credits - debits END, 0)''')} AS cents
        FROM {{settle_ruled}} g LEFT JOIN {{rules}} r USING (n)""",
    "settle_w": f"SELECT * FROM {{settle_all}} WHERE {within('ts', L0, L1)}",
    "settle_on": "SELECT * FROM {settle_w} WHERE gaming_state = 'CA-ON'",
    "first_all": f"""SELECT {local('t_changed_at')} AS ts, t_changed_at, a_patron_id AS patron_id, {BET} AS bet_id,
        COALESCE(s.promo_engine_free_bet_id, s.free_bet_id) AS promo_id, s.state, previous_ordinal, p.gaming_state,
        credit_cents - debit_cents AS net
        FROM {{accounting}} p JOIN {{bet_states}} s USING (bet_history_id)
        WHERE p_type = 'sportsbook_bet_resettlement' AND {LIABLE} AND previous_state = 'open'""",
    "first_sums": f"""SELECT ts, patron_id, bet_id, promo_id, state, gaming_state, TRUE AS is_first,
            {big("sum(CASE WHEN (state = 'refund') = (promo_id IS NULL) THEN net ELSE 0 END)")} AS cents
        FROM {{first_all}} WHERE state IN ('refund', 'win') AND previous_ordinal = 1 GROUP BY ALL
        UNION ALL
        SELECT ts, patron_id, bet_id, promo_id, state, gaming_state, FALSE, {big('sum(net)')}
        FROM {{first_all}} WHERE state = 'refund' AND previous_ordinal > 1 AND promo_id IS NULL GROUP BY ALL""",
    "first_on": f"SELECT * EXCLUDE (gaming_state) FROM {{first_sums}} WHERE gaming_state = 'CA-ON' AND {within('ts', L0, L1)}",
    # sports money in and out
    "bet_dr": legs("debit", f"p_type = 'sportsbook_bet' AND {LIABLE} AND {within('t_changed_at')}", BET),
    "bet_cr": legs("credit", f"p_type = 'sportsbook_bet' AND a_type = 'sportsbook_unsettled_bets' AND {within('t_changed_at')}", BET),
    "bet_pairs": paired("bet_dr", "bet_cr", f"{local('d.posted_at')} AS ts, d.patron_id, d.ref_id"),
    "cash_dr": "SELECT * FROM {bet_dr} WHERE ref_id IS NULL OR ref_id NOT IN (SELECT bet_id FROM {free_ids} WHERE bet_id IS NOT NULL)",
    "cash_cr": "SELECT * FROM {bet_cr} WHERE ref_id IS NULL OR ref_id NOT IN (SELECT bet_id FROM {free_ids} WHERE bet_id IS NOT NULL)",
    "cash_pairs": paired("cash_dr", "cash_cr", f"{local('d.posted_at')} AS ts, d.patron_id, d.ref_id AS bet_id"),
    "sports_net": f"""SELECT {local('t_changed_at')} AS ts, a_patron_id AS patron_id, {BET} AS bet_id, {big(NET)} AS cents
        FROM {{ledger_w}} WHERE p_type IN {SPORTS_TYPES} AND {LIABLE} GROUP BY ALL""",
    # casino
    "spin_dr": legs("debit", f"p_type = 'casino_wager' AND {LIABLE} AND {within('t_changed_at')}", "p_id", ", gaming_state"),
    "spin_cr": legs(
        "credit", f"p_type = 'casino_wager' AND a_type = 'casino_house_wins' AND {within('t_changed_at')}", "p_id", ", gaming_state"
    ),
    "spins": paired("spin_dr", "spin_cr", f"{local('d.posted_at')} AS ts, d.patron_id, d.ref_id, d.gaming_state"),
    "spins_on": """SELECT ts, patron_id, ref_id, cents FROM {spins} WHERE gaming_state = 'CA-ON'""",
    "undone": f"""SELECT {local('pt._changed_at')} AS ts, wg.patron_id, r.patron_transaction_id AS ref_id,
        wg.game_category AS category, wg.promo_engine_free_round_award_id IS NOT NULL AS is_promo,
        {big('sum(wg.amount_cents)')} AS cents
        FROM {{casino_wager_rollbacks}} r JOIN {{patron_transactions}} pt ON pt.id = r.patron_transaction_id
        JOIN {{wager_and_game_info}} wg ON wg.patron_transaction_id = r.patron_transaction_id AND wg.type = 'rollback'
        WHERE {within('pt._changed_at')} GROUP BY ALL""",
    "free_spins": f"""SELECT {local('pt._changed_at')} AS ts, pt.patron_id, w.patron_transaction_id AS ref_id,
        wg.game_category AS category, {big('sum(w.amount_cents)')} AS cents
        FROM {{casino_wagers}} w JOIN {{patron_transactions}} pt ON pt.id = w.patron_transaction_id
        LEFT JOIN {{wager_and_game_info}} wg ON wg.patron_transaction_id = pt.id
        WHERE w.promo_engine_free_round_award_id IS NOT NULL AND {within('pt._changed_at')} GROUP BY ALL""",
    "casino_won": f"""SELECT {local('t_changed_at')} AS ts, a_patron_id AS patron_id, p_id AS ref_id,
        p.promo_engine_free_round_award_id AS award_id, a.parent_id, a.gaming_state, {big(NET)} AS cents
        FROM {{ledger_w}} a LEFT JOIN {{casino_payouts}} p USING (patron_transaction_id)
        WHERE p_type = 'casino_payout' AND {LIABLE} GROUP BY ALL""",
    "casino_won_on": "SELECT ts, patron_id, ref_id, cents FROM {casino_won} WHERE award_id IS NULL AND gaming_state = 'CA-ON'",
    "free_paid": f"""SELECT pt.patron_id, {local('pt._changed_at')} AS ts, p.patron_transaction_id AS ref_id,
        {big('sum(p.amount_cents)')} AS cents
        FROM {{casino_payouts}} p JOIN {{patron_transactions}} pt ON pt.id = p.patron_transaction_id
        WHERE p.promo_engine_free_round_award_id IS NOT NULL AND p.amount_cents <> 0 AND {within('pt._changed_at')}
        GROUP BY ALL""",
    # jackpots
    "wallet_now": f"""SELECT b.* FROM {{wallet_transactions}} b
        WHERE _changed_at < {U1} + INTERVAL 2 MINUTE
        QUALIFY rank() OVER (PARTITION BY id ORDER BY _changed_at DESC, updated_at DESC NULLS LAST) = 1""",
    "links_now": f"""SELECT b.* FROM {{wallet_transaction_jackpots}} b
        WHERE _changed_at < {U1} + INTERVAL 2 MINUTE
        QUALIFY rank() OVER (PARTITION BY wallet_transaction_id, jackpot_id
                             ORDER BY _changed_at DESC, updated_at DESC NULLS LAST) = 1""",
    "names_now": f"""SELECT b.* FROM {{jackpots}} b WHERE _changed_at < {U1}
        QUALIFY rank() OVER (PARTITION BY id ORDER BY _changed_at DESC, updated_at DESC NULLS LAST) = 1""",
    "model": None,  # filled below
    "contributed": f"""SELECT remote_wallet_transaction_id AS ref_id, amount_precision FROM {{model}} WHERE type = 'contribution'""",
    "won_paid": """SELECT remote_wallet_transaction_id AS ref_id, amount_precision FROM {model}
        WHERE type = 'win' AND free_round_award_id IS NULL""",
    "won_free": """SELECT remote_wallet_transaction_id AS ref_id, amount_precision FROM {model}
        WHERE type = 'win' AND free_round_award_id IS NOT NULL""",
    # markets
    "market": f"""WITH unesc AS (
            SELECT l.*, replace(market, chr(92) || '|', '|') AS m, replace(event, chr(92) || '|', '|') AS e FROM {{legs}} l)
        SELECT DISTINCT u.vegas_bet_id AS bet_id, json_extract_string(m, '$.name') AS market_type,
            CASE WHEN market_classification = 'main' THEN 'Straight Wager'
                 WHEN market_classification IN ('player_prop', 'game_prop', 'future', 'promo') THEN 'Future Wager' END AS bet_type,
            upper(json_extract_string(json_extract_string(e, '$.competition'), '$.name')) AS league,
            {initcap("json_extract_string(json_extract_string(e, '$.sport'), '$.name')")} AS event_type,
            json_extract_string(e, '$.name') AS event_description,
            TRY_CAST(json_extract_string(e, '$.start_time') AS TIMESTAMP) AS event_timestamp,
            market_selection_name AS selection, num_legs, num_live_legs
        FROM {{bets}} b LEFT JOIN unesc u ON u.vegas_bet_id = b.id WHERE b.type = 'straight'
        UNION ALL
        SELECT vegas_bet_id, b.type, b.type, b.type, b.type, NULL, NULL, NULL, max(num_legs), max(num_live_legs)
        FROM {{bets}} b LEFT JOIN {{legs}} l ON l.vegas_bet_id = b.id WHERE b.type LIKE 'parlay%'
        GROUP BY vegas_bet_id, b.type""",
}


def _model(wallet: str, links: str, names: str, head: str, tail: str = "") -> str:
    return f"""SELECT {head}, wallet_transaction_id, type, game_provider, game_provider_game_round_id,
        game_provider_transaction_id, parent_wallet_transaction_id, remote_wallet_transaction_id, game_session_id,
        free_round_award_id, jackpot_id, display_name, amount_precision, wallet_amount, inserted_at, updated_at,
        {exact("CASE WHEN abs(rest) < 0.01 THEN 0 ELSE rest END")} AS casino_payout_normal, rest AS casino_payout_precise
        FROM (SELECT {head}, wallet_transaction_id, type, game_provider, game_provider_game_round_id,
                game_provider_transaction_id, parent_wallet_transaction_id, remote_wallet_transaction_id, game_session_id,
                free_round_award_id, jackpot_id, display_name, amount_precision, wallet_amount, inserted_at, updated_at,
                {exact("max(wallet_amount) - sum(amount_precision)")} AS rest
              FROM (SELECT j.wallet_transaction_id, j.type, t.* EXCLUDE (id, _changed_at, updated_at, amount, identity_user_id),
                      t.identity_user_id AS patron_id, j._changed_at, jp.id AS jackpot_id, jp.display_name,
                      j.inserted_at, j.updated_at,
                      CAST(amount_units + CAST(amount_nanos AS DECIMAL(18,0)) * 0.000000001 AS DECIMAL(28,9)) AS amount_precision,
                      CAST(CASE WHEN j.type = 'win' THEN {usd('t.amount')} ELSE 0 END AS DECIMAL(20,2)) AS wallet_amount
                    FROM {{{wallet}}} t JOIN {{{links}}} j ON j.wallet_transaction_id = t.id
                    JOIN {{{names}}} jp ON jp.id = j.jackpot_id) x
              GROUP BY ALL) y{tail}"""


FRAGMENTS["model"] = _model("wallet_now", "links_now", "names_now", "_changed_at")

CHECKS: dict[str, str] = {}


def checks(**given: str) -> None:
    CHECKS.update(given)


_E = "TIMESTAMP '2024-01-05 05:00:00'", "TIMESTAMP '2024-01-26 05:00:00'"

checks(
    b01_latest_version="""SELECT user_id, event_type, event_id, ts, value FROM {events}
        WHERE ts < TIMESTAMP '2024-01-20 00:02:00' AND user_id IS NOT NULL AND event_type IS NOT NULL
        QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) = 1""",
    b01_bets_asof=f"""WITH newest AS (SELECT id, max(_changed_at) AS c FROM {{bets_history}} WHERE _changed_at < {U1} GROUP BY id),
        second_clock AS (SELECT b.id, c, max(updated_at) AS u FROM {{bets_history}} b JOIN newest n
                         ON n.id = b.id AND n.c = b._changed_at GROUP BY ALL)
        SELECT b.id, status, payout_amount_cents, _changed_at, updated_at FROM {{bets_history}} b
        JOIN second_clock s ON s.id = b.id AND s.c = b._changed_at AND s.u = b.updated_at""",
    b01_snapshot_carried=" UNION ALL ".join(
        f"""SELECT id, status, payout_amount_cents, _changed_at, updated_at, TIMESTAMP '{c}' AS cutoff FROM {{bets_history}}
            WHERE _changed_at < TIMESTAMP '{c}' + INTERVAL 2 MINUTE
            QUALIFY rank() OVER (PARTITION BY id ORDER BY _changed_at DESC, updated_at DESC NULLS LAST) = 1
                    AND updated_at IS NOT NULL"""
        for c in ("1997-03-01", "1997-03-02 01:00:00", "1999-06-30")
    ),
    b02_latest_single_clock=f"""SELECT wallet_transaction_id, jackpot_id, type, updated_at FROM {{wallet_transaction_jackpots}} b
        WHERE updated_at = (SELECT max(updated_at) FROM {{wallet_transaction_jackpots}} m
                            WHERE m.wallet_transaction_id = b.wallet_transaction_id AND m.jackpot_id = b.jackpot_id
                              AND m.updated_at < {U1} + INTERVAL 2 MINUTE)""",
    b03_report_window=f"""SELECT event_id, ts, {within('ts', *_E)} AS in_utc,
        {within(local('ts'), "TIMESTAMP '2024-01-05'", "TIMESTAMP '2024-01-26'")} AS in_local
        FROM {{events}} WHERE ts >= {_E[0]} - INTERVAL 1 DAY AND ts < {_E[1]}""",
    b03_declared_layout=f"""SELECT CAST({local('ts')} AS DATE) AS event_day, count(*) AS events FROM {{events}}
        WHERE ts >= {_E[0]} - INTERVAL 1 DAY AND ts < {_E[1]} GROUP BY ALL""",
    b03_months_back="""SELECT id, placed_at FROM {bets}
        WHERE placed_at >= TIMESTAMP '1998-02-01 04:00:00' AND placed_at < TIMESTAMP '1998-09-01 04:00:00'""",
    b04_local_time=f"""SELECT id, {local('placed_at')} AS local FROM {{bets}}
        UNION ALL SELECT 'e' || CAST(event_id AS VARCHAR), {local('ts')} FROM {{events}}""",
    b05_buckets=f"""SELECT {month(local('ts'))} AS month, {day(local('ts'))} AS day, {second(local('ts'))} AS second,
        count(*) AS events FROM {{events}} GROUP BY ALL""",
    b06_ledger_legs="SELECT * FROM {bet_dr}",
    b07_match_legs="SELECT * FROM {bet_pairs}",
    b08_net_movement="SELECT * FROM {sports_net}",
    b08_net_movement_flipped=f"""SELECT {local('t_changed_at')} AS ts, a_patron_id AS patron_id,
        {big('sum(debit_cents) - sum(credit_cents)')} AS cents
        FROM {{ledger_on}} WHERE p_type = 'region_transfer_out' AND {LIABLE} GROUP BY ALL""",
    b09_promo_split=f"""SELECT a_patron_id, CASE WHEN f.bet_id IS NULL THEN 'cash' ELSE 'free' END AS kind,
        count(*) AS postings, {big('sum(debit_cents)')} AS debits
        FROM {{ledger_w}} a LEFT JOIN {{free_ids}} f ON f.bet_id = {BET} WHERE p_type = 'sportsbook_bet' GROUP BY ALL""",
    b10_free_bets_posted="SELECT bet_id FROM {free_ids}",
    b10_free_bet_index=f"""SELECT DISTINCT {BET} AS bet_id, 'ledger' AS of FROM {{accounting}} WHERE p_type = 'sportsbook_free_bet'
        UNION ALL SELECT DISTINCT {BET}, 'index' FROM {{accounting}}
            WHERE p_type = 'sportsbook_free_bet' AND t_changed_at < TIMESTAMP '2000-01-01'
        UNION ALL SELECT DISTINCT {BET}, 'report' FROM {{accounting}}
            WHERE p_type = 'sportsbook_free_bet' AND gaming_state = 'CA-ON'
              AND a_patron_id IN (SELECT patron_id FROM {{users}} WHERE is_tester = FALSE)""",
    b10_free_bets_in_window=f"""SELECT DISTINCT b.id AS bet_id FROM {{bets}} b JOIN {{ledger_on}} a ON b.id = {BET}
        WHERE b.free_bet_id IS NOT NULL""",
    b11_free_bets_wagered="SELECT * FROM {free_w}",
    b12_voided="SELECT * FROM {voided_w}",
    b12_voided_by_day=f"""SELECT {day(local('closed_at'))} AS gaming_day, {big('sum(bet_amount_cents)')} AS cents
        FROM {{bets}} WHERE status = 'voided' AND free_bet_id IS NULL GROUP BY ALL""",
    b13_open_exposure="SELECT * FROM {pending_w}",
    b14_resettlement="SELECT ts, patron_id, bet_id, promo_id, state, previous_state, account, cents FROM {settle_w}",
    b15_resettlement_rollup=f"""SELECT ts, patron_id, bet_id, {big('sum(cents)')} AS cents, 'both' AS kind
            FROM {{settle_w}} GROUP BY ALL
        UNION ALL
        SELECT ts, patron_id, bet_id, {big('sum(cents)')}, CASE WHEN promo_id IS NULL THEN 'cash' ELSE 'free' END AS kind
            FROM {{settle_w}} GROUP BY ts, patron_id, bet_id, kind""",
    b16_first_settlement="SELECT * FROM {first_on}",
    b17_transfer_from_sports="SELECT * FROM {sports_net} UNION ALL SELECT ts, patron_id, bet_id, cents FROM {first_on}",
    b18_transfer_to_sports="SELECT * FROM {cash_pairs} UNION ALL SELECT * FROM {free_w}",
    b19_transfer_to_casino="""SELECT s.*, w.game_category, w.game_id FROM {spins} s
        LEFT JOIN {wager_and_game_info} w ON w.patron_transaction_id = s.ref_id""",
    b20_casino_rollbacks="SELECT * FROM {undone}",
    b21_free_rounds_wagered="SELECT * FROM {free_spins}",
    b22_jackpot_model="SELECT * FROM {model}",
    b23_jackpot_contributions=f"""SELECT s.patron_id, w.game_category, {exact('sum(amount_precision)')} AS amount
        FROM {{spins}} s JOIN {{contributed}} c USING (ref_id)
        LEFT JOIN {{wager_and_game_info}} w ON w.patron_transaction_id = s.ref_id GROUP BY ALL""",
    b24_jackpot_adjustments=f"""SELECT patron_id, {exact('sum(amount)')} AS amount FROM (
            SELECT patron_id, amount_precision AS amount FROM {{spins}} JOIN {{contributed}} USING (ref_id)
            UNION ALL
            SELECT patron_id, -amount_precision FROM (
                SELECT DISTINCT ts, patron_id, ref_id, amount_precision FROM {{casino_won}} JOIN {{won_paid}} USING (ref_id)
                WHERE award_id IS NULL)) x GROUP BY ALL""",
    b25_bet_and_market="SELECT * FROM {market}",
    r09_bet_and_market="SELECT * FROM {market}",
)

FRAGMENTS["rb_dr"] = legs(
    "debit",
    f"p_type = 'casino_rollback' AND a_type = 'casino_house_wins' AND gaming_state = 'CA-ON' AND {within('t_changed_at')}",
    "patron_transaction_id",
    ", p_id",
)
FRAGMENTS["rb_cr"] = legs(
    "credit",
    f"p_type = 'casino_rollback' AND {LIABLE} AND gaming_state = 'CA-ON' AND {within('t_changed_at')}",
    "patron_transaction_id",
    ", p_id",
)
FRAGMENTS["rb_pairs"] = paired("rb_dr", "rb_cr", f"{local('d.posted_at')} AS ts, d.patron_id")
checks(b20_matched_rollbacks="SELECT * FROM {rb_pairs}")

# --- stacks, balances, sessions ---------------------------------------------------------------

FRAGMENTS["small_stack"] = f"""SELECT ts, patron_id, {big('sum(free)')} AS free, {big('sum(voided)')} AS voided,
    {big('sum(paid)')} AS paid FROM (
        SELECT ts, patron_id, cents AS free, 0 AS voided, 0 AS paid FROM {{free_w}}
        UNION ALL SELECT ts, patron_id, 0, -cents, 0 FROM {{voided_w}} WHERE NOT is_promo
        UNION ALL SELECT ts, patron_id, 0, 0, cents FROM {{sports_net}}) x GROUP BY ALL"""

REASON = "p_type IN ('amendment', 'amendment_rg') AND adjustment_reason = '9998' AND adjustment_type"
AML_REASON = "p_type IN ('amendment', 'amendment_rg') AND adjustment_reason IN ('9998', '9990') AND adjustment_type"

FRAGMENTS["deposits_on"] = f"""SELECT flow, {local('t_changed_at')} AS ts, a_patron_id AS patron_id, {big(NET)} AS cents
    FROM (SELECT *, CASE WHEN p_type = 'deposit' THEN 'deposit' WHEN p_type = 'region_transfer_in' THEN 'region_in'
                         WHEN {REASON} = '"cash_deposit"' THEN 'wire_deposit' END AS flow
          FROM {{ledger_on}} WHERE {LIABLE}) x WHERE flow IS NOT NULL GROUP BY ALL"""
FRAGMENTS["wd_dr"] = legs(
    "debit", f"t_type = 'withdrawal' AND {LIABLE} AND gaming_state = 'CA-ON' AND {within('t_changed_at')}", "patron_transaction_id"
)
FRAGMENTS["wd_cr"] = legs(
    "credit",
    f"t_type = 'withdrawal' AND a_type = 'clearing_withdrawals' AND gaming_state = 'CA-ON' AND {within('t_changed_at')}",
    "patron_transaction_id",
)
FRAGMENTS["wd_pairs"] = paired("wd_dr", "wd_cr", f"{local('d.posted_at')} AS ts, d.patron_id")
FRAGMENTS["withdrawals_on"] = f"""SELECT ts, patron_id, cents, 'withdrawal' AS flow FROM {{wd_pairs}}
    UNION ALL
    SELECT {local('t_changed_at')} AS ts, a_patron_id, {big('sum(debit_cents) - sum(credit_cents)')}, flow
    FROM (SELECT *, CASE WHEN p_type = 'region_transfer_out' THEN 'region_out'
                         WHEN {REASON} = '"cash_withdrawal"' THEN 'wire_withdrawal' END AS flow
          FROM {{ledger_on}} WHERE {LIABLE}) x WHERE flow IS NOT NULL GROUP BY ALL"""
_CANCEL = "p_type IN ('withdrawal_cancellation', 'withdrawal_decline')"
FRAGMENTS["cancel_dr"] = legs(
    "debit",
    f"{_CANCEL} AND a_type = 'clearing_withdrawals' AND gaming_state = 'CA-ON' AND {within('t_changed_at')}",
    "patron_transaction_id",
)
FRAGMENTS["cancel_cr"] = legs(
    "credit", f"{_CANCEL} AND {LIABLE} AND gaming_state = 'CA-ON' AND {within('t_changed_at')}", "patron_transaction_id"
)
FRAGMENTS["cancelled_on"] = paired("cancel_dr", "cancel_cr", f"{local('d.posted_at')} AS ts, d.patron_id")
FRAGMENTS["adjustments_on"] = f"""SELECT {local('t_changed_at')} AS ts, a_patron_id AS patron_id, {big(NET)} AS cents
    FROM {{ledger_on}} WHERE {LIABLE} AND p_type IN ('amendment', 'amendment_rg')
      AND (adjustment_reason IS NULL OR adjustment_reason <> '9998') GROUP BY ALL"""
FRAGMENTS["released"] = f"""SELECT {local('t_changed_at')} AS ts, a_patron_id AS patron_id, {big(NET)} AS cents
    FROM {{accounting}} WHERE {LIABLE} AND p_type IN ('bonus_offer_payout', 'bonus_offer_revoked', 'cash_deposit') GROUP BY ALL"""


def balance(users: str, bound: str) -> str:
    return f"""SELECT u.patron_id, {big(f'''COALESCE((SELECT sum(credit_cents - debit_cents) FROM {{accounting}} a
        WHERE a.a_patron_id = u.patron_id AND {LIABLE} AND gaming_state = 'CA-ON' AND {bound}), 0)''')} AS cents
        FROM {{{users}}} u"""


FRAGMENTS["opening_cash"] = balance("start_users", f"t_changed_at < {U0}")
FRAGMENTS["closing_cash"] = balance("users", "TRUE")
_PLAY = "lower(transaction_type) NOT IN ('bonus playthrough', 'bonus playthrough cancellation')"


def bonus_booked(users: str, bound: str) -> str:
    return f"""SELECT u.patron_id, {big('COALESCE(sum(transaction_amount), 0)')} AS cents FROM {{{users}}} u
        LEFT JOIN {{bonus_transactions}} b ON b.user_id = u.patron_id AND {_PLAY} AND {bound} GROUP BY ALL"""


def bonus_gone(users: str, bound: str) -> str:
    return f"""SELECT patron_id, {big('-sum(cents)')} AS cents FROM {{released}}
        WHERE patron_id IN (SELECT patron_id FROM {{{users}}}) AND {bound} GROUP BY ALL"""


FRAGMENTS["late"] = f"""SELECT p.user_id, p.id AS user_award_bonus_cash_id, t.t_changed_at, {big('sum(t.amount_cents)')} AS cents
    FROM {{user_award_bonus_cash}} p JOIN {{user_bonus_cash_transactions}} t ON t.user_award_bonus_cash_id = p.id
    WHERE t.transaction_type = 'unlock' AND p.expires_at < {U0} AND t.t_changed_at >= p.expires_at
      AND {within('t.t_changed_at')} GROUP BY ALL"""
FRAGMENTS["bonus_open"] = f"""{bonus_booked('start_users', f'transaction_timestamp_utc < {U0}')}
    UNION ALL {bonus_gone('start_users', f'ts < {L0}')}
    UNION ALL SELECT user_id, {big('sum(cents)')} FROM {{late}}
              WHERE user_id IN (SELECT patron_id FROM {{start_users}}) GROUP BY ALL"""
FRAGMENTS["bonus_close"] = f"""{bonus_booked('users', f'transaction_timestamp_utc < {U1}')}
    UNION ALL {bonus_gone('users', f'ts < {L1}')}"""
FRAGMENTS["bonus_moves"] = f"""SELECT user_id AS patron_id, {big('sum(transaction_amount)')} AS cents FROM {{bonus_transactions}}
        WHERE user_id IN (SELECT patron_id FROM {{start_users}}) AND {_PLAY} AND {within('transaction_timestamp_utc')} GROUP BY ALL
    UNION ALL {bonus_gone('start_users', within('ts', L0, L1))}
    UNION ALL SELECT patron_id, {big('sum(cents)')} FROM {{bonus_close}}
        WHERE patron_id IN (SELECT patron_id FROM {{users}} WHERE {within('inserted_at')}) GROUP BY ALL"""


def session_sql(rows: str, entity: str, session: str, ts: str, low: str, high: str) -> str:
    return f"""SELECT {entity}, count(DISTINCT session) AS num_game_sessions,
        {big('floor(greatest(sum(epoch_us(closed) - epoch_us(greatest(opened, lo))), 60000000) / 60000000.0 + 0.5)')}
            AS total_gameplay_duration
        FROM (SELECT {entity}, {session} AS session, min({ts}) AS opened, max({ts}) AS closed, {low} AS lo
              FROM {rows} GROUP BY 1, 2) s
        WHERE (opened >= {low} AND closed < {high}) OR (opened < {low} AND closed > {low})
        GROUP BY {entity}"""


FRAGMENTS["plays"] = f"""SELECT wg.* FROM {{wager_and_game_info}} wg JOIN {{patron_transactions}} pt
    ON pt.id = wg.patron_transaction_id WHERE wg.type <> 'rollback'
      AND pt._changed_at >= {U0} - INTERVAL 1 DAY AND pt._changed_at < {U1}"""
FRAGMENTS["player_sessions"] = session_sql("{plays}", "patron_id", "casino_session_id", "transaction_timestamp_utc", U0, U1)
FRAGMENTS["spins_cat"] = """SELECT s.*, w.game_category AS category FROM {spins} s
    LEFT JOIN {wager_and_game_info} w ON w.patron_transaction_id = s.ref_id"""


def counts(*sources: tuple[str, str, str, int]) -> str:
    parts = [
        f"""SELECT ts, patron_id, {category} AS category, {sign} * count(DISTINCT {ref}) AS num_wagers,
            {sign} * sum(cents) AS cents FROM {rows} GROUP BY ALL"""
        for rows, ref, category, sign in sources
    ]
    return " UNION ALL ".join(f"({p})" for p in parts)


BUCKETS = ", ".join(
    f"{big(f'COALESCE(sum(cents) FILTER (WHERE {test}), 0)')} AS wagers_{name}"
    for name, test in {
        "slots": "category = 'slots'",
        "tables": "category IN ('table', 'roulette')",
        "livedealer": "category = 'live'",
        "betting": "category = 'betting'",
        "other": "category NOT IN ('slots', 'table', 'roulette', 'live', 'betting')",
    }.items()
)

checks(
    b26_measure_stack="SELECT * FROM {small_stack}",
    b27_measure_totals=f"""SELECT patron_id, {usd('sum(free)')} AS free, {usd('sum(voided)')} AS voided,
        CAST({usd('sum(paid)')} AS DECIMAL(38,1)) AS paid FROM {{small_stack}} GROUP BY ALL""",
    b28_cash_balance="""SELECT *, 'start' AS at FROM {opening_cash} UNION ALL SELECT *, 'end' FROM {closing_cash}""",
    b28_carried_cash="""SELECT *, 'start' AS at FROM {opening_cash} UNION ALL SELECT *, 'end' FROM {closing_cash}""",
    b28_carried_balances=" UNION ALL ".join(
        f"""SELECT {local} AS at, '{flow}' AS flow, {who} AS patron_id, {big(f'sum({amount})')} AS cents
            FROM {{{table}}} WHERE {where} AND {clock} < {utc} GROUP BY {who}"""
        for local, utc in (
            (L0, U0), ("TIMESTAMP '1998-07-01'", "TIMESTAMP '1998-07-01 04:00:00'"), (L1, U1)
        )
        for flow, table, who, amount, clock, where in (
            ("cash", "accounting", "a_patron_id", "credit_cents - debit_cents", "t_changed_at", f"{LIABLE} AND gaming_state = 'CA-ON'"),
            ("released", "accounting", "a_patron_id", "credit_cents - debit_cents", "t_changed_at",
             f"{LIABLE} AND p_type IN ('bonus_offer_payout', 'bonus_offer_revoked', 'cash_deposit')"),
            ("bonus", "bonus_transactions", "user_id", "transaction_amount", "transaction_timestamp_utc", _PLAY),
        )
    ),
    b33_carried_bonus=f"SELECT patron_id, {big('sum(cents)')} AS cents FROM {{bonus_open}} GROUP BY ALL",
    b34_carried_bonus=f"SELECT patron_id, {big('sum(cents)')} AS cents FROM {{bonus_close}} GROUP BY ALL",
    b29_deposits="SELECT * FROM {deposits_on}",
    b30_withdrawals="SELECT * FROM {withdrawals_on}",
    b30_cancelled_withdrawals="SELECT * FROM {cancelled_on}",
    b31_cash_adjustments="SELECT * FROM {adjustments_on}",
    b32_bonus_released="SELECT * FROM {released}",
    b33_opening_bonus=f"SELECT patron_id, {big('sum(cents)')} AS cents FROM {{bonus_open}} GROUP BY ALL",
    b33_late_unlocks="SELECT * FROM {late}",
    b34_closing_bonus=f"SELECT patron_id, {big('sum(cents)')} AS cents FROM {{bonus_close}} GROUP BY ALL",
    b35_bonus_adjustments="SELECT * FROM {bonus_moves}",
    b36_player_sessions="SELECT * FROM {player_sessions}",
    b36_event_sessions=session_sql("{events}", "user_id", "CAST(CAST(ts AS DATE) AS VARCHAR)", "ts", *_E),
    b37_wager_counts=f"""SELECT patron_id, {big('sum(num_wagers)')} AS num_wagers, {big('sum(cents)')} AS wagered, {BUCKETS}
        FROM ({counts(('{free_w}', 'bet_id', "'betting'", 1),
                      ('(SELECT * FROM {voided_w} WHERE NOT is_promo)', 'bet_id', "'betting'", -1),
                      ('{spins_cat}', 'ref_id', 'category', 1),
                      ('{undone}', 'ref_id', 'category', -1))}) x GROUP BY ALL""",
    b38_last_activity=f"""SELECT p_patron_id AS patron_id, max(t_changed_at) AS last_active_at FROM {{accounting}}
        WHERE gaming_state = 'CA-ON' AND t_changed_at < {U1} GROUP BY ALL""",
)

# --- promotions -------------------------------------------------------------------------------


def newest(rows: str, key: str, attrs: str) -> str:
    return f"""SELECT {key}, {attrs} FROM ({rows}) n
        QUALIFY row_number() OVER (PARTITION BY {key} ORDER BY updated_at DESC NULLS FIRST) = 1"""


def _awards(kind: str, given: str, terms: str, link: str) -> str:
    rows = f"""SELECT a.id AS free_wager_id, a.user_id AS customer_id, t.id AS award_program_id,
        {local('awarded_at')} AS awarded_date, {usd('t.amount_cents')} AS coupon_amount, a.updated_at
        FROM {{{given}}} a JOIN {{{terms}}} t ON t.id = a.{link}"""
    return newest(rows, "free_wager_id", f"customer_id, award_program_id, awarded_date, coupon_amount, '{kind}' AS type")


def _programmes(kind: str, terms: str) -> str:
    rows = f"""SELECT t.id AS award_program_id, p.id AS program_code, p.name AS program_name,
        p.promotion_type AS award_type, p.updated_at FROM {{promotions}} p JOIN {{{terms}}} t ON t.promotion_id = p.id"""
    return newest(rows, "award_program_id", f"program_code, program_name, award_type, '{kind}' AS type")


FRAGMENTS["awards"] = (
    f"({_awards('free bet', 'user_award_free_bets', 'award_free_bets', 'award_free_bet_id')}) UNION ALL "
    f"({_awards('free wager', 'user_award_free_wagers', 'award_free_wagers', 'award_free_wager_id')})"
)
FRAGMENTS["programmes"] = (
    f"({_programmes('free bet award', 'award_free_bets')}) UNION ALL ({_programmes('free wager award', 'award_free_wagers')})"
)
FRAGMENTS["settled_free"] = f"""SELECT DISTINCT patron_id, id AS wager_id, free_bet_id AS promo_free_wager_id, outcome,
    FALSE AS is_jackpot, {usd('bet_amount_cents')} AS wager_amount, {exact(usd('payout_amount_cents'))} AS payout_amount,
    {exact('0')} AS jackpot_payout_amount, placed_at, closed_at, regraded, gaming_state, 'Sports' AS product,
    'Sports' AS game_category
    FROM {{bets}} WHERE free_bet_id IS NOT NULL AND status = 'settled' AND outcome <> 'push'"""
FRAGMENTS["free_life"] = f"""SELECT DISTINCT o.patron_id, o.patron_transaction_id AS wager_id,
    o.promo_engine_free_round_award_id AS promo_free_wager_id,
    CASE WHEN e.type = 'rollback' THEN 'rollback' WHEN e.amount_cents > 0 THEN 'win'
         WHEN e.amount_cents = 0 THEN 'loss' END AS outcome,
    m.amount_precision IS NOT NULL AS is_jackpot, {usd('o.amount_cents')} AS wager_amount,
    {exact(f"{usd('COALESCE(e.amount_cents, 0)')} - COALESCE(m.amount_precision, 0)")} AS payout_amount,
    {exact('COALESCE(m.amount_precision, 0)')} AS jackpot_payout_amount, w._changed_at AS placed_at,
    greatest(w._changed_at, p._changed_at, r._changed_at) AS closed_at, e.type = 'rollback' AS regraded,
    w.gaming_state, 'Casino' AS product, o.game_category
    FROM {{wager_and_game_info}} o
    JOIN {{patron_transactions}} pt ON pt.id = o.patron_transaction_id AND {within('pt._changed_at')}
    JOIN {{wager_and_game_info}} e ON e.parent_id = o.patron_transaction_id AND e.type IN ('payout', 'rollback')
    LEFT JOIN {{model}} m ON m.remote_wallet_transaction_id = e.patron_transaction_id
    JOIN {{casino_wagers}} w ON w.patron_transaction_id = o.patron_transaction_id
    LEFT JOIN {{casino_payouts}} p ON e.type = 'payout' AND p.patron_transaction_id = e.patron_transaction_id
    LEFT JOIN {{casino_wager_rollbacks}} r ON e.type = 'rollback' AND r.patron_transaction_id = e.patron_transaction_id
    WHERE o.type = 'wager' AND o.promo_engine_free_round_award_id IS NOT NULL"""


def segment(col: str) -> str:
    return f"CASE {col} WHEN 'live' THEN 'Live Dealer' WHEN 'roulette' THEN 'Table' ELSE {capital(col)} END"


def provider_segment(col: str) -> str:
    return (
        f"CASE {col} WHEN 'live' THEN 'Live Dealer' WHEN 'roulette' THEN 'Table' WHEN 'S' THEN 'Slots' "
        f"WHEN 'V' THEN 'VideoPoker' ELSE {capital(col)} END"
    )


FRAGMENTS["used"] = f"""SELECT DISTINCT {second(local('s.closed_at'))} AS "Settled Timestamp Toronto", s.patron_id AS "Patron ID",
    s.product AS "Product", {segment('s.game_category')} AS "Game Type", a.award_program_id AS "Award Program ID",
    COALESCE(g.program_name, 'Manual Award') AS "Program Name", s.wager_id AS "Wager ID",
    s.promo_free_wager_id AS "Promo Free Wager ID", {second(local('s.placed_at'))} AS "Placed At Timestamp Toronto",
    s.outcome AS "Outcome", s.wager_amount AS "Wager Amount", s.payout_amount AS "Payout Amount",
    s.jackpot_payout_amount AS "Jackpot Win Amount", s.gaming_state AS "Gaming State", s.regraded AS "Regrade",
    s.is_jackpot AS "Jackpot Win", {local("TIMESTAMP '2002-03-04 05:06:07'")} AS report_run_timestamp_toronto
    FROM (SELECT * FROM {{settled_free}} UNION ALL SELECT * FROM {{free_life}}) s
    JOIN {{users}} u ON u.patron_id = s.patron_id
    LEFT JOIN {{awards}} a ON a.free_wager_id = s.promo_free_wager_id
    LEFT JOIN {{programmes}} g ON g.award_program_id = a.award_program_id
    WHERE {local('s.closed_at')} BETWEEN {L0} AND {L1}"""

_META = """replace(json_extract_string(metadata, '$.game_name'), '_R3', '') AS game_name,
    json_extract_string(metadata, '$.game_category') AS game_category,
    json_extract_string(metadata, '$.game_provider') AS game_provider"""

FRAGMENTS["game_paid"] = f"""SELECT pt._changed_at, g.patron_transaction_id AS ref_id, m.name AS game_name, m.game_provider,
    m.category AS game_category, {big('sum(g.amount_cents)')} AS cents
    FROM {{wager_and_game_info}} g JOIN {{patron_transactions}} pt ON pt.id = g.patron_transaction_id
    JOIN {{casino_payouts}} p ON p.patron_transaction_id = g.patron_transaction_id
    JOIN {{games}} m ON m.id = g.game_id
    WHERE g.promo_engine_free_round_award_id IS NULL AND p.gaming_state = 'CA-ON' AND {within('pt._changed_at')}
      AND g.patron_id IN (SELECT patron_id FROM {{real_users}}) GROUP BY ALL"""
FRAGMENTS["cash_spins"] = f"""SELECT pt._changed_at, w.patron_transaction_id AS ref_id,
    json_extract_string(metadata, '$.game_name') AS game_name, json_extract_string(metadata, '$.game_provider') AS game_provider,
    json_extract_string(metadata, '$.game_category') AS game_category, {big('sum(w.amount_cents)')} AS cents
    FROM {{casino_wagers}} w JOIN {{patron_transactions}} pt ON pt.id = w.patron_transaction_id
    WHERE w.promo_engine_free_round_award_id IS NULL AND w.amount_cents <> 0 AND w.gaming_state = 'CA-ON'
      AND {within('pt._changed_at')} AND pt.patron_id IN (SELECT patron_id FROM {{real_users}}) GROUP BY ALL"""

checks(
    b39_latest_attrs="SELECT * FROM {awards}",
    b39_award_programmes="SELECT * FROM {programmes}",
    b39_latest_event_attrs="""SELECT user_id, event_type, value FROM {events}
        QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_type DESC, value DESC) = 1""",
    b40_free_round_lifecycle="SELECT * FROM {free_life}",
    b41_settled_free_bets="SELECT * FROM {settled_free}",
    r07_used_free_wagers="SELECT * FROM {used}",
    b42_latest_settlement="""WITH newest AS (SELECT l_partkey, l_suppkey, max(l_shipdate) AS d FROM {lineitem} GROUP BY ALL)
        SELECT l.l_partkey, l.l_suppkey, l_shipdate, l_returnflag, l_quantity FROM {lineitem} l JOIN newest n
          ON n.l_partkey = l.l_partkey AND n.l_suppkey = l.l_suppkey AND n.d = l_shipdate WHERE l_returnflag <> 'R'""",
    b43_game_metadata=f"SELECT patron_transaction_id, {_META} FROM {{casino_wagers}}",
    b61_casino_payouts="SELECT ts, patron_id, ref_id, award_id, parent_id, cents FROM {casino_won}",
    b61_free_round_payouts="SELECT * FROM {free_paid}",
    b61_game_payouts="SELECT * FROM {game_paid}",
    b62_cash_rounds=f"""SELECT {day(local('_changed_at'))} AS gaming_day, game_name, game_provider, game_category,
        {big('sum(cents)')} AS cents FROM {{cash_spins}} GROUP BY ALL""",
)


_REF = re.compile(r"(?<!\{)\{(\w+)\}(?!\})")


def _closure(sql: str, seen: list[str], domain: list[str]) -> None:
    for name in dict.fromkeys(_REF.findall(sql)):
        if name in FRAGMENTS:
            if name not in seen:
                _closure(FRAGMENTS[name], seen, domain)
                seen.append(name)
        elif name in DERIVED and name not in domain:
            domain.append(name)


def build() -> dict[str, str]:
    """Complete statements, one per checked query."""
    # imported here: the reports' checks are stated in a module of their own
    from testbed import oracle_reports  # noqa: F401

    out = {}
    for key, body in CHECKS.items():
        fragments: list[str] = []
        domain: list[str] = []
        _closure(body, fragments, domain)
        items = ",\n".join(f"{f} AS ({_REF.sub(lambda m: m[1], FRAGMENTS[f])})" for f in fragments)
        final = _REF.sub(lambda m: m[1], body).strip()
        if items and final[:5].upper() == "WITH ":
            final = f"WITH {items},\n{final[5:]}"
        elif items:
            final = f"WITH {items}\n{final}"
        out[key] = with_tables(domain, final)
    return out
