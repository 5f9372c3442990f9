"""SQL for the filings, the monitoring operators and the reports."""

from __future__ import annotations

from testbed.oracle import (
    CHECKS,
    AML_REASON,
    BET,
    BUCKETS,
    FRAGMENTS,
    L0,
    L1,
    LIABLE,
    NET,
    U0,
    U1,
    _model,
    big,
    capital,
    checks,
    counts,
    day,
    exact,
    initcap,
    legs,
    local,
    month,
    paired,
    provider_segment,
    second,
    segment,
    session_sql,
    share,
    usd,
    within,
)

# --- filings ----------------------------------------------------------------------------------


def _capped(margin: str, promo: str) -> str:
    return f"""CASE WHEN {promo} = 0 THEN {exact('0')} ELSE {margin} END AS ed_cap,
        CASE WHEN {promo} >= {margin} THEN {margin} ELSE {promo} END AS eligible_deductions"""


FRAGMENTS["brands"] = f"""SELECT p_brand, {usd('w')} AS wagers, {usd('p')} AS winnings,
    {exact(usd('CAST(f AS BIGINT) // 8'))} AS free_bet_winnings
    FROM (SELECT p_brand, sum(cents) FILTER (WHERE l_linestatus = 'F') AS w,
            sum(cents) FILTER (WHERE l_linestatus = 'O' AND l_returnflag = 'A') AS p,
            sum(cents) FILTER (WHERE l_linestatus = 'F' AND p_size > 25) AS f
          FROM (SELECT *, {big('round(l_extendedprice * 100)')} AS cents FROM {{lineitem}}) l
          JOIN {{part}} ON l_partkey = p_partkey GROUP BY ALL) x"""
FRAGMENTS["filing_days"] = """SELECT CAST(unnest(generate_series(TIMESTAMP '1996-01-01', TIMESTAMP '2000-12-31', INTERVAL 1 DAY))
    AS TIMESTAMP) AS gaming_day"""

checks(
    b44_deduction_cap=f"""SELECT *, {_capped(exact('CAST((wagers - winnings) AS DECIMAL(28,2)) * 0.10'), 'free_bet_winnings')}
        FROM {{brands}}""",
    b45_densify="""WITH days AS (SELECT CAST(unnest(generate_series(TIMESTAMP '1995-01-01',
                TIMESTAMP '2001-08-01', INTERVAL 1 DAY)) AS TIMESTAMP) AS gaming_day),
            keys AS (SELECT gaming_day, unnest(['AUTOMOBILE', 'BUILDING', 'FURNITURE', 'HOUSEHOLD', 'MACHINERY', 'Poker']) AS product_code FROM days)
        SELECT gaming_day, product_code, gaming_day + INTERVAL 1 DAY AS period_end, count(o_orderkey) AS orders
        FROM keys LEFT JOIN ({orders} o JOIN {customer} c ON o.o_custkey = c.c_custkey)
          ON date_trunc('day', o_orderdate) = gaming_day AND c_mktsegment = product_code GROUP BY ALL""".replace(
        "({orders} o JOIN {customer} c ON o.o_custkey = c.c_custkey)",
        "(SELECT o_orderkey, o_orderdate, c_mktsegment FROM {orders} JOIN {customer} ON o_custkey = c_custkey) f",
    ),
    b46_report_ids="""SELECT DISTINCT CAST(date_trunc('day', o_orderdate) AS TIMESTAMP) AS gaming_day,
        'EOP100001' || strftime(o_orderdate, '%Y%m%d') AS transaction_id,
        'GGR_OP100001_OP100001' || strftime(o_orderdate, '%Y%m%d') || '_' || strftime(o_orderdate, '%Y%m%d') || '_'
            || strftime(o_orderdate + INTERVAL 1 DAY, '%Y%m%d') || '_1' AS ggr_file_name,
        'OP100001' || strftime(o_orderdate, '%Y%m%d') || '_1_OP100001_S100001A_' || strftime(o_orderdate, '%Y%m%d')
            || '_Casino' AS record_id,
        CAST(date_trunc('day', o_orderdate) AS TIMESTAMP) + INTERVAL 2 DAY AS transaction_date FROM {orders}""",
)

# --- monitoring -------------------------------------------------------------------------------

FRAGMENTS["aml_deposits"] = f"""SELECT * FROM {{accounting}} WHERE {LIABLE}
    AND (p_type = 'deposit' OR ({AML_REASON} = '"cash_deposit"'))"""
FRAGMENTS["deposit_tx"] = f"""SELECT {month(local('t_changed_at'))} AS transaction_period, {local('t_changed_at')} AS ts,
    u.username, a_patron_id AS patron_id, patron_transaction_id AS transaction_id, {big(NET)} AS cents
    FROM {{aml_deposits}} d JOIN {{users}} u ON u.patron_id = d.a_patron_id GROUP BY ALL"""
FRAGMENTS["alerts"] = f"""SELECT 'Single' AS transaction_type, transaction_period, username, patron_id,
        {big('sum(cents)')} AS deposit_cents, count(DISTINCT transaction_id) AS deposits
    FROM {{deposit_tx}} WHERE cents >= 5000000 GROUP BY ALL HAVING count(DISTINCT transaction_id) = 1
    UNION ALL
    SELECT 'Aggregate', transaction_period, username, patron_id, {big('sum(cents)')}, count(DISTINCT transaction_id)
    FROM {{deposit_tx}} WHERE cents < 5000000 GROUP BY ALL
    HAVING count(DISTINCT transaction_id) > 1 AND sum(cents) >= 7500000"""
FRAGMENTS["depositors"] = f"""SELECT {month(local('t_changed_at'))} AS transaction_period, a_patron_id AS patron_id,
    username, first_name, last_name, employment_status, job_title, employer_name, gaming_state,
    {big(NET)} AS deposit_cents, count(DISTINCT patron_transaction_id) AS deposits
    FROM {{aml_deposits}} d JOIN {{users}} u ON u.patron_id = d.a_patron_id AND is_tester = FALSE
    WHERE {within('t_changed_at')} GROUP BY ALL HAVING {NET} >= 2500000"""


def look_back(months: int, floor: int) -> str:
    low = f"{U0} - INTERVAL {months} MONTH"
    return f"""SELECT a_patron_id AS patron_id, {big(NET)} AS cents, count(DISTINCT patron_transaction_id) AS n
        FROM {{aml_deposits}} WHERE {within('t_changed_at', low)}
          AND a_patron_id IN (SELECT patron_id FROM {{real_users}}) GROUP BY ALL HAVING {NET} >= {floor}"""


FRAGMENTS["over_six"] = look_back(6, 5000000)
FRAGMENTS["over_twelve"] = look_back(12, 10000000)


def lifetime_given(rows: str, floor: int) -> str:
    return f"""SELECT a_patron_id AS patron_id, {big(NET)} AS lt_deposit_cents,
        count(DISTINCT patron_transaction_id) AS lt_deposits FROM {rows} GROUP BY ALL HAVING {NET} >= {floor}"""


FRAGMENTS["lt_given"] = lifetime_given("{aml_deposits}", 5000000)

# withdrawals of all time, and those of the period
for _name, _bound in (("all", ""), ("in", f" AND {within('t_changed_at')}")):
    FRAGMENTS[f"out_dr_{_name}"] = legs("debit", f"t_type = 'withdrawal' AND {LIABLE}{_bound}", "patron_transaction_id")
    FRAGMENTS[f"out_cr_{_name}"] = legs(
        "credit", f"t_type = 'withdrawal' AND a_type = 'clearing_withdrawals'{_bound}", "patron_transaction_id"
    )
    FRAGMENTS[f"out_{_name}"] = f"""SELECT d.* FROM {{out_dr_{_name}}} d JOIN {{out_cr_{_name}}} c
        ON c.ledger_transaction_id = d.ledger_transaction_id AND c.cents = d.cents"""
FRAGMENTS["wires_out"] = f"""SELECT * FROM {{accounting}} WHERE {LIABLE} AND {AML_REASON} = '"cash_withdrawal"'"""


def _taken(matched: str, wires: str, keys_matched: str, keys_wires: str, prefix: str) -> str:
    return f"""SELECT {keys_matched}count(DISTINCT d.ref_id) AS {prefix}withdrawals,
            {big('sum(d.cents)')} AS {prefix}withdrawal_cents FROM {matched} GROUP BY ALL
        UNION ALL
        SELECT {keys_wires}count(DISTINCT patron_transaction_id), {big('sum(debit_cents) - sum(credit_cents)')}
        FROM {wires} GROUP BY ALL"""


FRAGMENTS["lt_taken"] = _taken("{out_all} d", "{wires_out}", "d.patron_id, ", "a_patron_id, ", "lt_")
FRAGMENTS["payment"] = f"""SELECT iu.username, pu.patron_id, {second(local('iu.registration_completed_at'))} AS kyc_date,
    {second(local('iu.last_login_at'))} AS last_login_at, count(DISTINCT deposit_id) AS deposits,
    {big('sum(amount_requested_cents)')} AS amount_cents, count(DISTINCT m.name) AS merchants,
    count(DISTINCT p.name) AS providers,
    count(DISTINCT COALESCE(trim(d.type, '"'), 'No Info') || '-' || COALESCE(trim(d.last_digits, '"'), 'No Info')) AS payment_cards
    FROM {{payment_deposits}} d JOIN {{payment_providers}} p ON p.id = d.provider_id
    JOIN {{payment_merchants}} m ON m.id = p.merchant_id JOIN {{payment_customers}} c ON c.id = d.customer_id
    JOIN {{payment_users}} pu ON pu.id = c.user_id JOIN {{users}} iu ON iu.patron_id = pu.patron_id
    WHERE d.state <> 'created' GROUP BY ALL"""


def activity(keys: str, rows: str, cash: str, free: str, prefix: str = "") -> str:
    return f"""SELECT {keys}, count(DISTINCT id) AS {prefix}bets,
        count(DISTINCT CASE WHEN free_bet_id IS NOT NULL THEN id END) AS {prefix}free_bets,
        {big(cash)} AS {prefix}settled_cash, {big(free)} AS {prefix}settled_free
        FROM {rows} WHERE status = 'settled' GROUP BY ALL"""


_PAID = "sum(bet_amount_cents) FILTER (WHERE free_bet_id IS NULL)"
_FREE = "sum(bet_amount_cents) FILTER (WHERE free_bet_id IS NOT NULL)"

# one row per second, bet and player, as the results are filtered
_STACK_COLUMNS = "ts, bet_id, patron_id, placed, paid, voided, resettled"


def stack(*parts: tuple[str, str], ts: str = "ts", weight: str = "1") -> str:
    kinds = ("placed", "voided", "resettled", "paid")
    branches = []
    for kind, rows in parts:
        columns = ", ".join(f"{'cents' if k == kind else '0'} AS {k}" for k in kinds)
        branches.append(f"SELECT {ts} AS ts, bet_id, patron_id, {columns} FROM {rows} s")
    sums = ", ".join(f"{big(f'sum({k})')} AS {k}" for k in kinds)
    return f"SELECT ts, bet_id, patron_id, {sums} FROM ({' UNION ALL '.join(branches)}) x GROUP BY ALL"


FRAGMENTS["detail"] = stack(
    ("placed", "{cash_pairs}"),
    ("voided", "(SELECT * FROM {voided_w} WHERE NOT is_promo)"),
    ("resettled", "(SELECT ts, patron_id, bet_id, cents FROM {settle_w})"),
    ("paid", "{sports_net}"),
)


def ggr(rows: str, driver: str = "") -> str:
    """Sum over (second, bet, player) rows with anything in them, once per market row."""
    return f"""SELECT patron_id, {big('sum(placed - paid - voided + resettled)')} AS ggr_cents
        FROM (SELECT x.patron_id, x.bet_id, m.market_type, m.selection, m.num_legs, m.num_live_legs, m.event_type,
                sum(placed) AS placed, sum(paid) AS paid, sum(voided) AS voided, sum(resettled) AS resettled
              FROM (SELECT {second('ts')} AS ts, bet_id, patron_id, sum(placed) AS placed, sum(paid) AS paid,
                      sum(voided) AS voided, sum(resettled) AS resettled FROM {rows} GROUP BY 1, 2, 3
                    HAVING sum(placed) <> 0 OR sum(paid) <> 0 OR sum(voided) <> 0 OR sum(resettled) <> 0) x
              LEFT JOIN {{market}} m ON m.bet_id = x.bet_id {driver}
              GROUP BY ALL) y GROUP BY ALL"""


checks(
    b29_deposit_transactions="SELECT * FROM {deposit_tx}",
    b47_threshold_alerts="SELECT * FROM {alerts}",
    b48_rolling_alerts="""SELECT COALESCE(s.patron_id, t.patron_id) AS patron_id, s.cents AS r6_deposit_cents,
        s.n AS r6_deposits, t.cents AS r12_deposit_cents, t.n AS r12_deposits
        FROM {over_six} s FULL JOIN {over_twelve} t ON t.patron_id = s.patron_id
        WHERE COALESCE(s.patron_id, t.patron_id) IN (SELECT patron_id FROM {depositors})""",
    b49_bet_activity=activity(f"{month(local('closed_at'))} AS transaction_period, patron_id", "{bets}", _PAID, _FREE),
    b49_lifetime_activity=activity("patron_id", "{bets}", "sum(bet_amount_cents)", f"COALESCE({_FREE}, 0)", "lt_"),
    b50_lifetime_withdrawals="SELECT * FROM {lt_taken}",
    b51_lifetime_deposits="SELECT *, CAST(1 AS INT) AS ranks FROM {lt_given}",
    b52_payment_profile="SELECT * FROM {payment}",
    b53_player_ggr=ggr("{detail}"),
    b54_enrich=f"""SELECT u.patron_id, u.username, COALESCE(b.bets, 0) AS bets, COALESCE(b.free_bets, 0) AS free_bets,
        COALESCE(g.lt_deposits, 0) AS lt_deposits, {share('b.settled_cash', 'g.lt_deposit_cents')} AS settled_per_deposit
        FROM {{users}} u LEFT JOIN ({activity('patron_id', '{bets}', _PAID, _FREE)}) b USING (patron_id)
        LEFT JOIN {{lt_given}} g USING (patron_id)""",
    b55_labels="""SELECT u.patron_id, CASE WHEN is_tester THEN 'Test' ELSE 'Real' END AS designation,
        CASE gender WHEN 'male' THEN 'M' WHEN 'female' THEN 'F' ELSE 'X' END AS gender,
        (DATE '2002-03-04' - birthdate) // 365 AS age, substr(postal_code, 1, 3) AS fsa,
        COALESCE(employment_status IN ('retired', 'homemaker', 'student', 'unemployed'), FALSE) AS non_earning
        FROM {users} u LEFT JOIN {addresses} a ON a.user_id = u.patron_id""",
    b55_game_labels=f"""SELECT segment, provider_segment, count(*) AS "rows" FROM (
            SELECT {segment('category')} AS segment, {provider_segment('game_provider_game_category')} AS provider_segment FROM {{games}}
            UNION ALL
            SELECT CASE WHEN num_legs = 1 THEN 'Fixed Odds Single' WHEN num_legs > 1 THEN 'Fixed Odds Combo' END,
                CASE WHEN num_live_legs = 0 THEN 'Pre Event' WHEN num_live_legs = num_legs THEN 'Live Action' ELSE 'Both' END
            FROM {{legs}}) x GROUP BY ALL""",
    b56_status_flags="""SELECT u.patron_id, CASE WHEN BreakEnd IS NULL THEN '0' ELSE '1' END AS "BreakStatus",
        COALESCE(BreakStart, '') AS "BreakStart", COALESCE(BreakEnd, '') AS "BreakEnd",
        CASE WHEN SEEnd IS NULL THEN '0' ELSE '1' END AS "SEStatus", COALESCE(SEStart, '') AS "SEStart",
        COALESCE(SEEnd, '') AS "SEEnd"
        FROM {users} u LEFT JOIN {break_status} b USING (patron_id) LEFT JOIN {self_exclusion_status} s USING (patron_id)""",
    b59_sports_detail="SELECT * FROM {detail}",
)

# --- account and bet sheets -------------------------------------------------------------------

FRAGMENTS["sheet"] = f"""SELECT u.id, first_name, last_name, birthdate, email, {initcap('line_1')} AS line_1, line_2,
    {initcap('city')} AS city, region, postal_code, number AS phone_number, document_type, document_expiration_date,
    document_reference_number, min(CAST(inserted_at AS DATE)) AS account_created, max(CAST(last_login_at AS DATE)) AS last_log_in
    FROM {{account_users}} u JOIN {{kyc_verifications}} k ON k.user_id = u.id
    LEFT JOIN {{emails}} e ON e.user_id = u.id LEFT JOIN {{addresses}} a ON a.user_id = u.id
    LEFT JOIN {{phone_numbers}} p ON p.user_id = u.id
    WHERE k.status IN ('success', 'approved') AND document_type IS NOT NULL AND registration_completed_at IS NOT NULL
    GROUP BY ALL"""
FRAGMENTS["history"] = f"""SELECT u.first_name, u.last_name, b.patron_id, b.id, b.type, b.price, b.bet_amount_cents,
    b.win_amount_cents, b.payout_amount_cents, COALESCE(b.free_bet_id, b.promo_engine_free_bet_id) AS free_bet_id,
    b.status, b.outcome, b.placed_at, b.closed_at
    FROM (SELECT * FROM {{bets_history}} WHERE _changed_at < {U1}
          QUALIFY rank() OVER (PARTITION BY id ORDER BY _changed_at DESC) = 1
              AND updated_at = max(updated_at) OVER (PARTITION BY id, _changed_at)) b
    LEFT JOIN {{users}} u ON u.patron_id = b.patron_id"""
_LISTED = "(SELECT CAST(c_custkey AS VARCHAR) FROM {customer} WHERE c_mktsegment = 'HOUSEHOLD')"

checks(
    b57_account_sheet="SELECT * FROM {sheet}",
    b58_bet_history="SELECT * FROM {history}",
    r13_account_sheet=f"SELECT * FROM {{sheet}} WHERE id IN {_LISTED}",
    r14_bet_history=f"SELECT * FROM {{history}} WHERE patron_id IN {_LISTED}",
)

# --- jackpots over two clocks -----------------------------------------------------------------

FRAGMENTS["wallet_one"] = f"""SELECT * FROM {{wallet_transactions}} WHERE updated_at < {U1} + INTERVAL 2 MINUTE
    QUALIFY rank() OVER (PARTITION BY id ORDER BY updated_at DESC) = 1"""
FRAGMENTS["links_one"] = f"""SELECT * FROM {{wallet_transaction_jackpots}} WHERE updated_at < {U1} + INTERVAL 2 MINUTE
    QUALIFY rank() OVER (PARTITION BY wallet_transaction_id, jackpot_id ORDER BY updated_at DESC) = 1"""
checks(
    r08_jackpots_from_history=_model("wallet_now", "links_now", "names_now", "_changed_at"),
    r08_jackpots_from_current=_model("wallet_one", "links_one", "jackpots", "patron_id"),
)

# --- results detail ---------------------------------------------------------------------------

FRAGMENTS["sports_detail"] = stack(
    ("placed", "(SELECT * FROM {cash_pairs} UNION ALL SELECT * FROM {free_w})"),
    ("voided", "(SELECT * FROM {voided_w} WHERE NOT is_promo)"),
    ("resettled", "(SELECT ts, patron_id, bet_id, cents FROM {settle_w})"),
    ("paid", "(SELECT * FROM {sports_net} UNION ALL SELECT ts, patron_id, bet_id, cents FROM {first_on})"),
)


def sports_rows(parlay_names: str) -> str:
    return f"""SELECT 'CA-ON' AS state, CAST(ts AS DATE) AS day, 'Sports' AS product, {second('ts')} AS moment_at, s.bet_id AS wager,
        CAST(NULL AS VARCHAR) AS tx, s.patron_id AS account,
        CASE WHEN u.is_tester THEN 'Test' ELSE 'Real' END AS designation, m.event_type AS wager_type, m.bet_type AS description,
        CASE WHEN COALESCE(m.event_description, '') = '' AND {parlay_names} THEN m.market_type
             ELSE m.event_description END AS event,
        {second(local('m.event_timestamp'))} AS event_at, m.selection,
        sum(placed) AS placed, -sum(paid) AS paid, -sum(voided) AS voided, sum(resettled) AS resettled, 0 AS rolled,
        {exact('0')} AS contribution, {exact('0')} AS win
        FROM {{sports_detail}} s LEFT JOIN {{market}} m ON m.bet_id = s.bet_id JOIN {{users}} u ON u.patron_id = s.patron_id
        WHERE {within('ts', L0, L1)} GROUP BY ALL"""


FRAGMENTS["spin_wins"] = """SELECT DISTINCT gaming_state, ts, patron_id, ref_id, award_id, amount_precision FROM {casino_won}
    JOIN (SELECT * FROM {won_paid} UNION ALL SELECT * FROM {won_free}) w USING (ref_id)"""
FRAGMENTS["undone_own"] = f"""SELECT {local('r._changed_at')} AS ts, wg.patron_id, r.patron_transaction_id AS ref_id,
    {big('sum(wg.amount_cents)')} AS cents
    FROM {{casino_wager_rollbacks}} r JOIN {{wager_and_game_info}} wg USING (patron_transaction_id)
    WHERE wg.type = 'rollback' AND wg.promo_engine_free_round_award_id IS NULL AND {within('r._changed_at')} GROUP BY ALL"""


def _moves(*branches: str) -> str:
    return " UNION ALL ".join(branches)


_SPIN_MOVES = (
    "SELECT 'CA-ON' AS state, ts, ref_id AS wager, ref_id, patron_id, cents AS placed, 0 AS rolled, 0 AS paid, 0.0 AS c, 0.0 AS w FROM {spins}",
    "SELECT 'CA-ON', ts, ref_id, ref_id, patron_id, cents, 0, 0, 0.0, 0.0 FROM {free_spins}",
    "SELECT gaming_state, ts, parent_id, ref_id, patron_id, 0, 0, cents, 0.0, 0.0 FROM {casino_won}",
)
FRAGMENTS["spin_moves"] = _moves(
    *_SPIN_MOVES,
    "SELECT 'CA-ON', ts, ref_id, ref_id, patron_id, 0, cents, 0, 0.0, 0.0 FROM {undone}",
    """SELECT gaming_state, ts, ref_id, ref_id, patron_id, 0, 0, 0, sum(amount_precision), 0.0
       FROM {spins} JOIN {contributed} USING (ref_id) GROUP BY gaming_state, ts, ref_id, patron_id""",
    "SELECT gaming_state, ts, ref_id, ref_id, patron_id, 0, 0, 0, 0.0, amount_precision FROM {spin_wins}",
)
FRAGMENTS["spin_moves_plain"] = _moves(
    *_SPIN_MOVES,
    "SELECT 'CA-ON', ts, ref_id, ref_id, patron_id, 0, cents, 0, 0.0, 0.0 FROM {undone_own}",
    "SELECT 'CA-ON', ts, ref_id, ref_id, patron_id, 0, cents, 0, 0.0, 0.0 FROM {undone} WHERE is_promo",
)


def casino_rows(moves: str) -> str:
    return f"""SELECT state, CAST(ts AS DATE) AS day, 'Casino' AS product, {second('ts')} AS moment_at, wager,
        g.patron_transaction_id AS tx, s.patron_id AS account, CASE WHEN u.is_tester THEN 'Test' ELSE 'Real' END AS designation,
        {segment('g.game_category')} AS wager_type, 'Casino Wager' AS description, g.game_name AS event,
        CAST(NULL AS TIMESTAMP) AS event_at, CAST(NULL AS VARCHAR) AS selection,
        placed, -paid AS paid, 0 AS voided, 0 AS resettled, -rolled AS rolled, {exact('-c')} AS contribution, {exact('w')} AS win
        FROM {{{moves}}} s JOIN {{users}} u ON u.patron_id = s.patron_id
        LEFT JOIN {{wager_and_game_info}} g ON g.patron_transaction_id = s.ref_id WHERE {within('ts', L0, L1)}"""


FRAGMENTS["detail_rows"] = f"{sports_rows('''lower(m.bet_type) NOT IN ('parlay', 'parlay_plus')''')} UNION ALL {casino_rows('spin_moves')}"
FRAGMENTS["detail_rows_plain"] = (
    f"{sports_rows('''m.bet_type NOT IN ('Parlay', 'Parlay_plus')''')} UNION ALL {casino_rows('spin_moves_plain')}"
)

_DETAIL_KEYS = """state AS "Gaming State", day AS "Gaming Date", product AS "Product", moment_at AS "Transaction Time",
    wager AS "Wager ID", tx AS "Patron Transaction ID", account AS "Account Number", designation AS "Account Designation",
    wager_type AS "Wager Type", description AS "Wager Description", event AS "Event Description", event_at AS "Event Date",
    selection AS "Selection" """


def detail_amounts(agg: str) -> str:
    def a(column: str) -> str:
        return f"{agg}({column})" if agg else f"({column})"

    return f"""{usd(a('placed'))} AS "Wager Placed Amount", {usd(a('paid'))} AS "Wager Paid Amount",
        {usd(a('voided'))} AS "Void Wager Amount", CAST(0 AS DECIMAL(38,2)) AS "Cancelled Wager Amount",
        {usd(a('resettled'))} AS "Resettled Wager Adjustment", {usd(a('rolled'))} AS "Rollback Wager Amount" """


checks(
    r01_results_detail=f"""SELECT {_DETAIL_KEYS}, {detail_amounts('sum')},
        {exact('sum(contribution)')} AS "Jackpot Contributions and Reseeds", {exact('sum(win)')} AS "Jackpot Win Payouts",
        {exact(usd('sum(placed + paid + voided + resettled + rolled)') + ' + sum(contribution) + sum(win)')} AS "Gross Revenue"
        FROM {{detail_rows}} GROUP BY ALL""",
    r02_results_detail_plain=f"""SELECT {_DETAIL_KEYS}, {detail_amounts('')},
        {usd('placed + paid + voided + resettled + rolled')} AS "Gross Revenue" FROM {{detail_rows_plain}}""",
)

# --- player activity --------------------------------------------------------------------------

FRAGMENTS["promo_ids"] = f"SELECT DISTINCT b.id AS bet_id FROM {{bets}} b JOIN {{ledger_on}} a ON b.id = {BET} WHERE free_bet_id IS NOT NULL"
FRAGMENTS["on_dr"] = legs(
    "debit", f"p_type = 'sportsbook_bet' AND {LIABLE} AND gaming_state = 'CA-ON' AND {within('t_changed_at')}", BET
)
FRAGMENTS["on_cr"] = legs(
    "credit",
    f"p_type = 'sportsbook_bet' AND a_type = 'sportsbook_unsettled_bets' AND gaming_state = 'CA-ON' AND {within('t_changed_at')}",
    BET,
)
FRAGMENTS["on_cash_dr"] = "SELECT d.* FROM {on_dr} d ANTI JOIN {promo_ids} p ON p.bet_id = d.ref_id"
FRAGMENTS["on_cash_cr"] = "SELECT c.* FROM {on_cr} c ANTI JOIN {promo_ids} p ON p.bet_id = c.ref_id"
FRAGMENTS["on_cash"] = paired("on_cash_dr", "on_cash_cr", f"{local('d.posted_at')} AS ts, d.patron_id, d.ref_id AS bet_id")
FRAGMENTS["on_sports_net"] = f"""SELECT {local('t_changed_at')} AS ts, a_patron_id AS patron_id, {BET} AS bet_id,
    p.bet_id IS NOT NULL AS is_promo, {big(NET)} AS cents
    FROM {{ledger_on}} a LEFT JOIN {{promo_ids}} p ON p.bet_id = {BET}
    WHERE p_type IN ('sportsbook_cash_out_bet', 'sportsbook_payout', 'sportsbook_bet_lost') AND {LIABLE} GROUP BY ALL"""
FRAGMENTS["free_won"] = """SELECT DISTINCT f.ts, f.patron_id, f.ref_id, amount_precision FROM {free_paid} f JOIN {won_free} USING (ref_id)"""
FRAGMENTS["spins_on_cat"] = """SELECT s.*, w.game_category AS category FROM {spins_on} s
    LEFT JOIN {wager_and_game_info} w ON w.patron_transaction_id = s.ref_id"""
FRAGMENTS["on_counts"] = counts(
    ("{spins_on_cat}", "ref_id", "category", 1),
    ("(SELECT * FROM {undone} WHERE NOT is_promo)", "ref_id", "category", -1),
    ("{free_spins}", "ref_id", "category", 1),
    ("(SELECT * FROM {undone} WHERE is_promo)", "ref_id", "category", -1),
    ("{on_cash}", "bet_id", "'betting'", 1),
    ("(SELECT * FROM {voided_w} WHERE NOT is_promo)", "bet_id", "'betting'", -1),
    ("{free_w}", "bet_id", "'betting'", 1),
    ("(SELECT * FROM {voided_w} WHERE is_promo)", "bet_id", "'betting'", -1),
)

_MEASURES = (
    "start_balance deposits withdrawals adjustments player_win unsettled withdrawable end_balance promo_start promo_adjust "
    "promo_wagers promo_unsettled promo_end sessions wagers minutes slots tables livedealer betting other won_jackpot"
).split()


def measure_rows(rows: str, ts: str = "ts", where: str = "TRUE", **given: str) -> str:
    columns = ", ".join(f"{given.get(m, '0')} AS {m}" for m in _MEASURES)
    return f"SELECT {day(ts)} AS gaming_day, patron_id, {columns} FROM {rows} WHERE {where}"


FRAGMENTS["player_rows"] = " UNION ALL ".join(
    [
        measure_rows("{opening_cash}", L0, start_balance="cents"),
        measure_rows("{deposits_on}", deposits="cents"),
        measure_rows("{withdrawals_on}", withdrawals="cents"),
        measure_rows("{cancelled_on}", withdrawals="-cents"),
        measure_rows("{adjustments_on}", adjustments="cents"),
        measure_rows("{released}", where=within("ts", L0, L1), adjustments="cents"),
        measure_rows("{on_sports_net}", where="NOT is_promo", player_win="cents"),
        measure_rows("{on_sports_net}", where="is_promo", withdrawable="cents"),
        measure_rows("{first_on}", player_win="cents"),
        measure_rows("{casino_won_on}", player_win="cents"),
        measure_rows("{settle_on}", where="promo_id IS NULL", player_win="-cents"),
        measure_rows("{settle_on}", where="promo_id IS NOT NULL", withdrawable="-cents"),
        measure_rows("{pending_w}", where="NOT is_promo", unsettled="cents"),
        measure_rows("{pending_w}", where="is_promo", promo_unsettled="cents"),
        measure_rows("{free_paid}", withdrawable="cents"),
        measure_rows("{free_won}", won_jackpot="amount_precision"),
        measure_rows("{closing_cash}", L0, end_balance="cents"),
        measure_rows("{bonus_open}", L0, promo_start="cents"),
        measure_rows("{bonus_moves}", L0, promo_adjust="cents"),
        measure_rows("{free_w}", promo_wagers="cents"),
        measure_rows("{voided_w}", where="is_promo", promo_wagers="-cents"),
        measure_rows("{free_spins}", promo_wagers="cents"),
        measure_rows("{undone}", where="is_promo", promo_wagers="-cents"),
        measure_rows("{bonus_close}", L0, promo_end="cents"),
        measure_rows("{player_sessions}", L0, sessions="num_game_sessions", minutes="total_gameplay_duration"),
        measure_rows(
            "{on_counts}",
            wagers="num_wagers",
            slots="CASE WHEN category = 'slots' THEN cents ELSE 0 END",
            tables="CASE WHEN category IN ('table', 'roulette') THEN cents ELSE 0 END",
            livedealer="CASE WHEN category = 'live' THEN cents ELSE 0 END",
            betting="CASE WHEN category = 'betting' THEN cents ELSE 0 END",
            other="CASE WHEN category NOT IN ('slots', 'table', 'roulette', 'live', 'betting') THEN cents ELSE 0 END",
        ),
    ]
)
FRAGMENTS["player_sums"] = f"""SELECT gaming_day, patron_id,
    {', '.join(f"{big(f'sum({m})')} AS {m}" for m in _MEASURES[:-1])}, {exact('sum(won_jackpot)')} AS won_jackpot
    FROM {{player_rows}} GROUP BY ALL"""

_ALL = "slots + tables + livedealer + betting + other"
_WON = f"CAST({usd('player_win')} + won_jackpot AS DECIMAL(38,2))"
checks(
    r03_player_activity=f"""SELECT DISTINCT DATE '1996-01-01' AS "GamingDay", 'S100001A' AS "GamingSiteID", u.patron_id AS "PlayerID",
        (DATE '2002-03-04' - birthdate) // 365 AS "Age",
        CASE gender WHEN 'male' THEN 'M' WHEN 'female' THEN 'F' ELSE 'X' END AS "Gender", substr(postal_code, 1, 3) AS "FSA",
        strftime({local('registration_completed_at')}, '%Y%m%d') AS "RegistrationDate",
        COALESCE(strftime({local('last_at')}, '%Y%m%d'), '00000000') AS "LastActiveDate",
        {usd('start_balance')} AS "StartBalance", {usd('deposits')} AS "Deposits", {usd('withdrawals')} AS "Withdrawals",
        {usd('adjustments')} AS "Adjustments", {usd(f'{_ALL} - promo_wagers')} AS "PlayerWagers", {_WON} AS "PlayerWin",
        {usd('unsettled')} AS "UnsettledWagers",
        CAST({_WON} - {usd(f'{_ALL} - promo_wagers')} AS DECIMAL(38,2)) AS "Win/Loss",
        CAST({usd('withdrawable')} - won_jackpot AS DECIMAL(38,2)) AS "WithdrawableWin", {usd('end_balance')} AS "EndBalance",
        {usd('promo_start')} AS "PromoStartBalance", {usd('promo_adjust')} AS "PromoAdjustments",
        {usd('promo_wagers')} AS "PromoPlayerWagers", {usd('promo_unsettled')} AS "PromoUnsettledWagers",
        0 AS "PromoPlayerWin", {usd('promo_end')} AS "PromoEndBalance", sessions AS "#ofGameSessions", wagers AS "#ofWagers",
        minutes AS "TotalGameplayDuration", {usd('slots')} AS "WagersSlots", {usd('tables')} AS "WagersTables",
        {usd('livedealer')} AS "WagersLiveDealer", {usd('betting')} AS "WagersBetting", 0 AS "WagersP2PPoker",
        {usd('other')} AS "WagersOther", {usd(_ALL)} AS "WagersMobile", 0 AS "WagersPC",
        CASE WHEN BreakEnd IS NULL THEN '0' ELSE '1' END AS "BreakStatus", COALESCE(BreakStart, '') AS "BreakStart",
        COALESCE(BreakEnd, '') AS "BreakEnd", CASE WHEN SEEnd IS NULL THEN '0' ELSE '1' END AS "SEStatus",
        COALESCE(SEStart, '') AS "SEStart", COALESCE(SEEnd, '') AS "SEEnd", '0' AS "HighRisk"
        FROM {{player_sums}} d JOIN {{users}} u ON u.patron_id = d.patron_id AND u.is_tester = FALSE
        LEFT JOIN {{addresses}} a ON a.user_id = d.patron_id
        LEFT JOIN (SELECT p_patron_id, max(t_changed_at) AS last_at FROM {{accounting}}
                   WHERE gaming_state = 'CA-ON' AND t_changed_at < {U1} GROUP BY ALL) la ON la.p_patron_id = d.patron_id
        LEFT JOIN {{break_status}} b ON b.patron_id = d.patron_id
        LEFT JOIN {{self_exclusion_status}} s ON s.patron_id = d.patron_id""",
)

# --- game activity ----------------------------------------------------------------------------

_GAME = "num_wagers wagers unsettled win win_jackpot promo promo_unsettled withdrawable withdrawable_jackpot".split()


def game_rows(rows: str, bet: str, tx: str, where: str = "TRUE", **given: str) -> str:
    columns = ", ".join(f"{given.get(m, '0')} AS {m}" for m in _GAME)
    return f"SELECT ts, patron_id, {bet} AS bet_id, {tx} AS tx, {columns} FROM {rows} WHERE {where}"


def bet_rows(rows: str, where: str = "TRUE", **given: str) -> str:
    return game_rows(rows, "bet_id", "CAST(NULL AS VARCHAR)", where, **given)


def spin_rows(rows: str, where: str = "TRUE", **given: str) -> str:
    return game_rows(rows, "CAST(NULL AS VARCHAR)", "ref_id", where, **given)


FRAGMENTS["won_on"] = "SELECT DISTINCT ts, patron_id, ref_id, amount_precision FROM {casino_won_on} JOIN {won_paid} USING (ref_id)"
FRAGMENTS["made_on"] = "SELECT ts, patron_id, ref_id, amount_precision FROM {spins_on} JOIN {contributed} USING (ref_id)"
FRAGMENTS["game_moves"] = " UNION ALL ".join(
    [
        bet_rows("{on_cash}", num_wagers="1", wagers="cents"),
        spin_rows("{spins_on}", num_wagers="1", wagers="cents"),
        spin_rows("{undone}", "NOT is_promo", num_wagers="-1", wagers="-cents"),
        spin_rows("{undone}", "is_promo", num_wagers="-1", promo="-cents"),
        spin_rows("{made_on}", win_jackpot="amount_precision"),
        bet_rows("{voided_w}", "NOT is_promo", num_wagers="-1", wagers="-cents"),
        bet_rows("{voided_w}", "is_promo", num_wagers="-1", promo="-cents"),
        bet_rows("{pending_w}", "NOT is_promo", unsettled="cents"),
        bet_rows("{pending_w}", "is_promo", promo_unsettled="cents"),
        bet_rows("{on_sports_net}", "NOT is_promo", win="cents"),
        bet_rows("{on_sports_net}", "is_promo", withdrawable="cents"),
        bet_rows("{first_on}", win="cents"),
        spin_rows("{casino_won_on}", win="cents"),
        spin_rows("{won_on}", win_jackpot="-amount_precision"),
        bet_rows("{settle_on}", "promo_id IS NULL", win="-cents"),
        bet_rows("{settle_on}", "promo_id IS NOT NULL", withdrawable="-cents"),
        bet_rows("{free_w}", num_wagers="1", promo="cents"),
        spin_rows("{free_spins}", num_wagers="1", promo="cents"),
        spin_rows("{free_paid}", withdrawable="cents"),
        spin_rows("{free_won}", withdrawable_jackpot="-amount_precision"),
    ]
)
FRAGMENTS["game_moves_small"] = " UNION ALL ".join(
    [
        spin_rows("{spins}", num_wagers="1", wagers="cents"),
        bet_rows("{cash_pairs}", num_wagers="1", wagers="cents"),
    ]
)
FRAGMENTS["game_sessions"] = session_sql(
    "(SELECT * FROM {plays} WHERE patron_id IN (SELECT patron_id FROM {real_users}))",
    "game_id",
    "casino_session_id",
    "transaction_timestamp_utc",
    U0,
    U1,
)
FRAGMENTS["game_sessions_all"] = session_sql("{plays}", "game_id", "casino_session_id", "transaction_timestamp_utc", U0, U1)


def game_sums(moves: str, played: str) -> str:
    return f"""SELECT CASE WHEN d.bet_id IS NULL THEN 'Casino' ELSE 'Betting' END AS "ProductCode",
        CASE WHEN d.bet_id IS NULL THEN {provider_segment('g.game_provider_game_category')} ELSE 'Sports' END AS "ProductSegment",
        CASE WHEN d.bet_id IS NULL THEN g.name ELSE m.event_type END AS "Game",
        CASE WHEN d.bet_id IS NULL THEN NULL WHEN m.num_legs = 1 THEN 'Fixed Odds Single'
             WHEN m.num_legs > 1 THEN 'Fixed Odds Combo' END AS "BetTypeA",
        CASE WHEN d.bet_id IS NULL THEN NULL WHEN m.num_live_legs = 0 THEN 'Pre Event'
             WHEN m.num_live_legs = m.num_legs THEN 'Live Action' ELSE 'Both' END AS "BetTypeB",
        CASE WHEN count(d.bet_id) = 0 THEN max(p.num_game_sessions) END AS "#ofGameSessions",
        CASE WHEN count(d.bet_id) = 0 THEN max(p.total_gameplay_duration) END AS "TotalGameplayDuration",
        count(DISTINCT CASE WHEN num_wagers > 0 THEN d.patron_id END) AS "#ofUniquePlayers",
        {big('sum(num_wagers)')} AS "#ofWagers", {usd('sum(wagers)')} AS "WagersGame", {usd('sum(unsettled)')} AS unsettled,
        CAST({usd('sum(win)')} + sum(win_jackpot) AS DECIMAL(38,2)) AS win, {usd('sum(promo)')} AS promo,
        {usd('sum(promo_unsettled)')} AS promo_unsettled,
        CAST({usd('sum(withdrawable)')} + sum(withdrawable_jackpot) AS DECIMAL(38,2)) AS withdrawable
        FROM {{{moves}}} d JOIN {{real_users}} u ON u.patron_id = d.patron_id
        LEFT JOIN {{wager_and_game_info}} wg ON wg.patron_transaction_id = d.tx
        LEFT JOIN {{market}} m ON m.bet_id = d.bet_id
        LEFT JOIN {{{played}}} p ON p.game_id = wg.game_id LEFT JOIN {{games}} g ON g.id = p.game_id
        WHERE {within('ts', L0, L1)} GROUP BY 1, 2, 3, 4, 5"""


FRAGMENTS["game_report"] = game_sums("game_moves", "game_sessions")
checks(
    b60_game_players=f"""SELECT "ProductCode", "ProductSegment", "Game", "BetTypeA", "BetTypeB", "#ofGameSessions",
        "TotalGameplayDuration", "#ofUniquePlayers", "#ofWagers", "WagersGame"
        FROM ({game_sums('game_moves_small', 'game_sessions_all')}) x""",
    r04_game_activity="""SELECT '19960101' AS "GamingDay", 'S100001A' AS "GamingSiteID",
        * EXCLUDE (unsettled, win, promo, promo_unsettled, withdrawable), unsettled AS "UnsettledWagers", win AS "WinGame",
        CAST(0 AS DECIMAL(38,2)) AS "Fees", CAST("WagersGame" - win AS DECIMAL(38,2)) AS "NonAdjustedGGR",
        promo AS "PromoWagersGame", promo_unsettled AS "PromoUnsettledWagers", CAST(0 AS DECIMAL(38,2)) AS "PromoWinGame",
        withdrawable AS "WithdrawableWin" FROM {game_report}""",
)

# --- GGR by product ---------------------------------------------------------------------------

FRAGMENTS["ggr_free"] = f"""SELECT DISTINCT {BET} AS bet_id FROM {{accounting}} WHERE p_type = 'sportsbook_free_bet'
    AND gaming_state = 'CA-ON' AND a_patron_id IN (SELECT patron_id FROM {{real_users}})"""
_MINE = "p_patron_id IN (SELECT patron_id FROM {real_users})"
_NOT_FREE = f"({BET} IS NULL OR {BET} NOT IN (SELECT bet_id FROM {{ggr_free}} WHERE bet_id IS NOT NULL))"
FRAGMENTS["ggr_dr"] = legs("debit", f"t_type = 'sportsbook_bet' AND {LIABLE} AND gaming_state = 'CA-ON' AND {_MINE} AND {_NOT_FREE}", "NULL")
FRAGMENTS["ggr_cr"] = legs(
    "credit",
    f"t_type = 'sportsbook_bet' AND a_type = 'sportsbook_unsettled_bets' AND gaming_state = 'CA-ON' AND {_MINE} AND {_NOT_FREE}",
    "NULL",
)
FRAGMENTS["ggr_placed"] = paired("ggr_dr", "ggr_cr", f"{local('d.posted_at')} AS ts")
FRAGMENTS["ggr_rb_dr"] = legs("debit", f"p_type = 'casino_rollback' AND a_type = 'casino_house_wins' AND gaming_state = 'CA-ON' AND {_MINE}", "p_id")
FRAGMENTS["ggr_rb_cr"] = legs("credit", f"p_type = 'casino_rollback' AND {LIABLE} AND gaming_state = 'CA-ON' AND {_MINE}", "p_id")
FRAGMENTS["ggr_undone"] = paired("ggr_rb_dr", "ggr_rb_cr", f"{local('d.posted_at')} AS ts")
FRAGMENTS["ggr_net"] = f"""SELECT {local('t_changed_at')} AS ts, {big(NET)} AS cents FROM {{accounting}}
    WHERE p_type IN ('sportsbook_cash_out_bet', 'sportsbook_payout', 'sportsbook_bet_lost') AND {LIABLE}
      AND gaming_state = 'CA-ON' AND {_MINE}
      AND ({BET} IS NULL OR {BET} NOT IN (SELECT id FROM {{bets}} WHERE free_bet_id IS NOT NULL
                                          AND patron_id IN (SELECT patron_id FROM {{real_users}}))) GROUP BY ALL"""
_R = "patron_id IN (SELECT patron_id FROM {real_users})"
FRAGMENTS["ggr_jackpot"] = f"""SELECT gaming_day, CAST(sum(amount) AS DECIMAL(38,2)) AS amount FROM (
        SELECT {day('ts')} AS gaming_day, w.game_name, amount_precision AS amount
        FROM {{made_on}} s LEFT JOIN {{wager_and_game_info}} w ON w.patron_transaction_id = s.ref_id WHERE s.{_R}
        UNION ALL
        SELECT {day('ts')}, w.game_name, -amount_precision
        FROM {{casino_won_on}} s JOIN {{won_paid}} USING (ref_id)
        LEFT JOIN {{wager_and_game_info}} w ON w.patron_transaction_id = s.ref_id WHERE s.{_R}) x
    GROUP BY gaming_day, game_name"""
FRAGMENTS["ggr_facts"] = " UNION ALL ".join(
    f"SELECT {ts} AS gaming_day, '{product}' AS product_code, {w} AS w, {v} AS v, {j} AS j FROM {rows}"
    for rows, ts, product, w, v, j in (
        ("{settle_on} WHERE promo_id IS NULL AND " + _R, day("ts"), "Betting", "0", "-cents", "0.0"),
        ("{bets} WHERE status = 'voided' AND free_bet_id IS NULL AND " + _R, day(local("closed_at")), "Betting", "-bet_amount_cents", "0", "0.0"),
        ("{ggr_placed}", day("ts"), "Betting", "cents", "0", "0.0"),
        ("{ggr_net}", day("ts"), "Betting", "0", "cents", "0.0"),
        ("{first_on} WHERE " + _R, day("ts"), "Betting", "0", "cents", "0.0"),
        ("{casino_won_on} WHERE " + _R, day("ts"), "Casino", "0", "cents", "0.0"),
        ("{spins_on} WHERE " + _R, day("ts"), "Casino", "cents", "0", "0.0"),
        ("{ggr_jackpot}", "gaming_day", "Casino", "0", "0", "amount"),
        ("{ggr_undone}", day("ts"), "Casino", "-cents", "0", "0.0"),
    )
)
FRAGMENTS["ggr_days"] = f"""SELECT d.gaming_day, product_code, {usd('COALESCE(sum(w), 0)')} AS wagers,
    CAST({usd('COALESCE(sum(v), 0)')} + COALESCE(sum(j), 0) AS DECIMAL(38,2)) AS winnings
    FROM (SELECT gaming_day, unnest(['Betting', 'Casino']) AS product_code FROM {{filing_days}}) d
    LEFT JOIN {{ggr_facts}} f USING (gaming_day, product_code) GROUP BY ALL"""
checks(
    r05_ggr_by_product="""SELECT 'OP100001' || strftime(gaming_day, '%y%m%d') AS "TransactionID",
        strftime(gaming_day + INTERVAL 1 DAY, '%Y%m%d') AS "TransactionDate", 'OP100001' AS "iGOOperatorID",
        'S100001A' AS "GamingSiteID", strftime(gaming_day, '%Y%m%d') AS "PeriodStart", strftime(gaming_day, '%Y%m%d') AS "PeriodEnd",
        strftime(gaming_day, '%Y%m%d') AS "GamingDay", product_code AS "ProductCode",
        CAST(wagers - winnings AS DECIMAL(38,2)) AS "GGR", wagers AS "Wagers", winnings AS "Winnings",
        CAST(0 AS DECIMAL(38,2)) AS "EligibleDeductions", '1' AS "FileVersion" FROM {ggr_days}""",
)

# --- casino GGR -------------------------------------------------------------------------------

FRAGMENTS["used_latest"] = """SELECT * FROM {used}
    QUALIFY rank() OVER (PARTITION BY "Patron ID", "Wager ID" ORDER BY "Settled Timestamp Toronto" DESC) = 1"""
FRAGMENTS["promo_paid"] = f"""SELECT {day('"Settled Timestamp Toronto"')} AS gaming_day, metadata, "Payout Amount" AS amount
    FROM {{used_latest}} l JOIN {{casino_wagers}} c ON c.patron_transaction_id = "Wager ID"
      AND c.promo_engine_free_round_award_id = "Promo Free Wager ID"
    WHERE "Outcome" <> 'rollback' AND "Product" = 'Casino' AND "Payout Amount" <> 0
      AND "Patron ID" IN (SELECT patron_id FROM {{real_users}}) AND {within('"Settled Timestamp Toronto"', L0, L1)}"""
FRAGMENTS["game_undone_dr"] = legs(
    "debit",
    f"p_type = 'casino_rollback' AND a_type = 'casino_house_wins' AND gaming_state = 'CA-ON' AND {_MINE} AND {within('t_changed_at')}",
    "patron_transaction_id",
    ", p_id",
)
FRAGMENTS["game_undone_cr"] = legs(
    "credit",
    f"p_type = 'casino_rollback' AND {LIABLE} AND gaming_state = 'CA-ON' AND {_MINE} AND {within('t_changed_at')}",
    "patron_transaction_id",
    ", p_id",
)
FRAGMENTS["game_undone"] = paired("game_undone_dr", "game_undone_cr", f"{local('d.posted_at')} AS ts, d.ref_id")
_ATTRS = "game_provider, game_category, game_name"
FRAGMENTS["game_jackpots"] = f"""SELECT gaming_day, {_ATTRS}, CAST(sum(amount) AS DECIMAL(38,2)) AS amount FROM (
        SELECT {day(local('_changed_at'))} AS gaming_day, {_ATTRS}, amount_precision AS amount FROM {{cash_spins}} JOIN {{contributed}} USING (ref_id)
        UNION ALL
        SELECT {day(local('_changed_at'))}, {_ATTRS}, -amount_precision FROM {{game_paid}} JOIN {{won_paid}} USING (ref_id)) x
    GROUP BY ALL"""
FRAGMENTS["game_facts"] = f"""
    SELECT gaming_day, json_extract_string(metadata, '$.game_provider') AS game_provider,
        json_extract_string(metadata, '$.game_category') AS game_category, json_extract_string(metadata, '$.game_name') AS game_name,
        0 AS w, 0 AS v, 0.0 AS j, amount AS f FROM {{promo_paid}}
    UNION ALL SELECT {day(local('_changed_at'))}, {_ATTRS}, cents, 0, 0.0, 0.0 FROM {{cash_spins}}
    UNION ALL SELECT {day('ts')}, g.game_provider, g.category, g.name, -cents, 0, 0.0, 0.0 FROM {{game_undone}} u
        JOIN {{rollback_payout_info}} i ON i.patron_transaction_id = u.ref_id JOIN {{games}} g ON g.id = i.game_id
    UNION ALL SELECT {day(local('_changed_at'))}, {_ATTRS}, 0, cents, 0.0, 0.0 FROM {{game_paid}}
    UNION ALL SELECT gaming_day, {_ATTRS}, 0, 0, amount, 0.0 FROM {{game_jackpots}}"""
FRAGMENTS["game_sums"] = f"""SELECT gaming_day, game_provider, game_category, replace(game_name, '_R3', '') AS game_name,
    {usd('sum(w)')} AS wagers, CAST({usd('sum(v)')} + sum(j) AS DECIMAL(38,2)) AS winnings, {exact('sum(f)')} AS free_bet_winnings
    FROM {{game_facts}} GROUP BY 1, 2, 3, 4"""
checks(
    r06_casino_ggr=f"""SELECT 'EOP100001' || strftime(d.gaming_day, '%Y%m%d') AS transaction_id,
        strftime(d.gaming_day + INTERVAL 2 DAY, '%Y%m%d') AS transaction_date, 'OP100001' AS igo_operator_id,
        'S100001A' AS gaming_site_id, strftime(d.gaming_day, '%Y%m%d') AS period_start,
        strftime(d.gaming_day, '%Y%m%d') AS period_end, strftime(d.gaming_day, '%Y%m%d') AS gaming_day, 'Casino' AS product_code,
        game_provider, game_category, game_name, wagers, winnings, free_bet_winnings,
        {_capped(exact('CAST((wagers - winnings) AS DECIMAL(28,2)) * 0.10'), 'free_bet_winnings')}, '1' AS file_version
        FROM {{filing_days}} d LEFT JOIN {{game_sums}} s ON s.gaming_day = d.gaming_day""",
)

# --- monitoring reports -----------------------------------------------------------------------

_BOTH = "p_type IN ('sportsbook_bet', 'casino_wager')"
_HOUSE = "a_type IN ('sportsbook_unsettled_bets', 'casino_house_wins')"
_PAYS = "p_type IN ('sportsbook_cash_out_bet', 'sportsbook_payout', 'sportsbook_bet_lost', 'casino_payout')"

# high-value deposits look at all time
FRAGMENTS["hv_dr"] = legs("debit", f"{_BOTH} AND {LIABLE} AND ({BET} IS NULL OR {BET} NOT IN (SELECT bet_id FROM {{free_ids}} WHERE bet_id IS NOT NULL))", BET)
FRAGMENTS["hv_cr"] = legs("credit", f"{_BOTH} AND {_HOUSE} AND ({BET} IS NULL OR {BET} NOT IN (SELECT bet_id FROM {{free_ids}} WHERE bet_id IS NOT NULL))", BET)
FRAGMENTS["hv_placed"] = paired("hv_dr", "hv_cr", f"{local('d.posted_at')} AS ts, d.patron_id, d.ref_id AS bet_id")
FRAGMENTS["hv_stack"] = stack(
    (
        "placed",
        f"""(SELECT ts, patron_id, bet_id, cents FROM {{hv_placed}} UNION ALL
             SELECT {local('placed_at')}, patron_id, id, bet_amount_cents FROM {{bets}} WHERE free_bet_id IS NOT NULL)""",
    ),
    (
        "voided",
        f"""(SELECT {local('closed_at')} AS ts, patron_id, id AS bet_id, bet_amount_cents AS cents FROM {{bets}}
             WHERE status = 'voided' AND free_bet_id IS NULL)""",
    ),
    ("resettled", "(SELECT s.ts, s.patron_id, s.bet_id, s.cents FROM {settle_all} s JOIN {alerts} r ON r.patron_id = s.patron_id)"),
    (
        "paid",
        f"""(SELECT {local('t_changed_at')} AS ts, a_patron_id AS patron_id, {BET} AS bet_id, credit_cents - debit_cents AS cents
             FROM {{accounting}} a JOIN {{alerts}} r ON r.patron_id = a.a_patron_id WHERE {_PAYS} AND {LIABLE}
             UNION ALL SELECT ts, patron_id, bet_id, cents FROM {{first_sums}})""",
    ),
)
FRAGMENTS["hv_ggr"] = ggr("{hv_stack}")
FRAGMENTS["hv_bets"] = activity(f"{month('closed_at')} AS transaction_period, patron_id", "{bets}", _PAID, _FREE)
FRAGMENTS["hv_lt_bets"] = activity("patron_id", "{bets}", _PAID, _FREE, "lt_")
FRAGMENTS["hv_taken"] = _taken(
    "{out_all} d",
    "{wires_out}",
    f"{month(local('d.posted_at'))} AS transaction_period, d.patron_id, ",
    f"{month(local('t_changed_at'))}, a_patron_id, ",
    "",
)
_PROFILE = "p.merchants, p.providers, p.payment_cards, p.kyc_date, p.last_login_at"

checks(
    r10_high_value_deposits=f"""SELECT r.transaction_period AS deposit_period, r.transaction_type AS deposit_detection, r.patron_id,
        r.username, u.first_name, u.last_name, u.employment_status, u.job_title AS occupation, u.employer_name,
        COALESCE(b.bets, 0) AS bets, COALESCE(b.free_bets, 0) AS free_bets, {usd('COALESCE(b.settled_cash, 0)')} AS settled_cash,
        {usd('COALESCE(b.settled_free, 0)')} AS settled_free, r.deposits, {usd('r.deposit_cents')} AS deposit_amount,
        COALESCE(w.withdrawals, 0) AS withdrawals, {usd('COALESCE(w.withdrawal_cents, 0)')} AS withdrawal_amount,
        COALESCE({share('b.settled_cash', 'r.deposit_cents')}, 0) AS "Settled:Deposit", COALESCE(lb.lt_bets, 0) AS lt_bets,
        COALESCE(lb.lt_free_bets, 0) AS lt_free_bets, {usd('COALESCE(lb.lt_settled_cash, 0)')} AS lt_settled_cash,
        {usd('COALESCE(lb.lt_settled_free, 0)')} AS lt_settled_free, COALESCE(ld.lt_deposits, 0) AS lt_deposits,
        {usd('COALESCE(ld.lt_deposit_cents, 0)')} AS lt_deposit_amount, COALESCE(lw.lt_withdrawals, 0) AS lt_withdrawals,
        {usd('COALESCE(lw.lt_withdrawal_cents, 0)')} AS lt_withdrawal_amount,
        COALESCE({share('lb.lt_settled_cash', 'ld.lt_deposit_cents')}, 0) AS "LT Settled:Deposit",
        {usd('g.ggr_cents')} AS lt_ggr_cash, {_PROFILE}
        FROM {{alerts}} r JOIN {{users}} u ON u.patron_id = r.patron_id AND u.is_tester = FALSE
        LEFT JOIN {{hv_bets}} b ON b.patron_id = r.patron_id AND b.transaction_period = r.transaction_period
        LEFT JOIN {{hv_lt_bets}} lb ON lb.patron_id = r.patron_id
        LEFT JOIN {{hv_taken}} w ON w.patron_id = r.patron_id AND w.transaction_period = r.transaction_period
        LEFT JOIN {{lt_taken}} lw ON lw.patron_id = r.patron_id LEFT JOIN {{lt_given}} ld ON ld.patron_id = r.patron_id
        LEFT JOIN {{payment}} p ON p.patron_id = r.patron_id LEFT JOIN {{hv_ggr}} g ON g.patron_id = r.patron_id
        WHERE {within('r.transaction_period', L0, L1)}""",
)

# the occupation reports stay inside the period and repeat what is joined to a driver row by row
FRAGMENTS["oc_bets_all"] = "SELECT b.* FROM {bets} b JOIN {depositors} r ON r.patron_id = b.patron_id"
FRAGMENTS["oc_free"] = f"""SELECT DISTINCT b.id AS bet_id FROM {{oc_bets_all}} b JOIN {{ledger_w}} a ON b.id = {BET}
    WHERE b.free_bet_id IS NOT NULL"""
_OC = f"""a_patron_id IN (SELECT patron_id FROM {{depositors}}) AND {within('t_changed_at')}
    AND ({BET} IS NULL OR {BET} NOT IN (SELECT bet_id FROM {{oc_free}}))"""
FRAGMENTS["oc_dr"] = legs("debit", f"{_BOTH} AND {LIABLE} AND {_OC}", BET)
FRAGMENTS["oc_cr"] = legs("credit", f"{_BOTH} AND {_HOUSE} AND {_OC}", BET)
FRAGMENTS["oc_placed"] = paired("oc_dr", "oc_cr", f"{local('d.posted_at')} AS ts, d.patron_id, d.ref_id AS bet_id")
FRAGMENTS["oc_stack"] = stack(
    (
        "placed",
        "(SELECT ts, patron_id, bet_id, cents FROM {oc_placed} UNION ALL SELECT * FROM {free_w} WHERE patron_id IN (SELECT patron_id FROM {depositors}))",
    ),
    (
        "voided",
        "(SELECT v.ts, v.patron_id, v.bet_id, v.cents FROM {voided_w} v JOIN {depositors} r ON r.patron_id = v.patron_id WHERE NOT is_promo)",
    ),
    ("resettled", "(SELECT s.ts, s.patron_id, s.bet_id, s.cents FROM {settle_w} s JOIN {depositors} r ON r.patron_id = s.patron_id)"),
    (
        "paid",
        f"""(SELECT {local('t_changed_at')} AS ts, a_patron_id AS patron_id, {BET} AS bet_id, credit_cents - debit_cents AS cents
             FROM {{ledger_w}} a JOIN {{depositors}} r ON r.patron_id = a.a_patron_id WHERE {_PAYS} AND {LIABLE}
             UNION ALL SELECT ts, patron_id, bet_id, cents FROM {{first_sums}} WHERE {within('ts', L0, L1)})""",
    ),
)
FRAGMENTS["oc_ggr"] = ggr("{oc_stack}", "JOIN (SELECT patron_id FROM {depositors}) r ON r.patron_id = x.patron_id")
FRAGMENTS["oc_bets"] = activity(
    f"{month(local('closed_at'))} AS transaction_period, patron_id",
    f"(SELECT * FROM {{oc_bets_all}} WHERE {within('closed_at')})",
    "sum(bet_amount_cents)",
    _FREE,
)
FRAGMENTS["oc_lt_bets"] = activity("patron_id", "{oc_bets_all}", "sum(bet_amount_cents)", f"COALESCE({_FREE}, 0)", "lt_")
_WIRES = "(SELECT a.* FROM {wires_out} a JOIN {depositors} r ON r.patron_id = a.a_patron_id"
FRAGMENTS["oc_taken"] = _taken(
    "(SELECT * FROM {out_in} WHERE patron_id IN (SELECT patron_id FROM {depositors})) d",
    f"{_WIRES} WHERE {within('t_changed_at')}) w",
    f"{month(local('d.posted_at'))} AS transaction_period, d.patron_id, ",
    f"{month(local('t_changed_at'))}, a_patron_id, ",
    "",
)
FRAGMENTS["oc_lt_taken"] = _taken(
    "(SELECT o.* FROM {out_in} o JOIN {depositors} r ON r.patron_id = o.patron_id) d",
    f"{_WIRES}) w",
    "d.patron_id, ",
    "a_patron_id, ",
    "lt_",
)
FRAGMENTS["oc_lt_given"] = lifetime_given("(SELECT a.* FROM {aml_deposits} a JOIN {depositors} r ON r.patron_id = a.a_patron_id) x", 2500000)


def occupation(look_back: str, joins: str, where: str) -> str:
    return f"""SELECT d.transaction_period AS deposit_period, d.patron_id, d.username,
        COALESCE(d.employment_status IN ('retired', 'homemaker', 'student', 'unemployed'), FALSE) AS is_non_earning,
        d.first_name, d.last_name, d.job_title AS occupation, d.employment_status AS occupation_type, d.employer_name,
        b.bets, b.free_bets, {usd('b.settled_cash')} AS settled_cash, {usd('b.settled_free')} AS settled_free, d.deposits,
        {usd('d.deposit_cents')} AS deposit_amount, {look_back} COALESCE(w.withdrawals, 0) AS withdrawals,
        {usd('COALESCE(w.withdrawal_cents, 0)')} AS withdrawal_amount,
        {share('b.settled_cash', 'd.deposit_cents')} AS "Settled:Deposit", lb.lt_bets, lb.lt_free_bets,
        {usd('lb.lt_settled_cash')} AS lt_settled_cash, {usd('lb.lt_settled_free')} AS lt_settled_free, ld.lt_deposits,
        {usd('ld.lt_deposit_cents')} AS lt_deposit_amount, COALESCE(lw.lt_withdrawals, 0) AS lt_withdrawals,
        {usd('COALESCE(lw.lt_withdrawal_cents, 0)')} AS lt_withdrawal_amount,
        {share('lb.lt_settled_cash', 'ld.lt_deposit_cents')} AS "LT Settled:Deposit", {usd('g.ggr_cents')} AS lt_ggr_cash, {_PROFILE}
        FROM {{depositors}} d
        LEFT JOIN {{oc_bets}} b ON b.patron_id = d.patron_id AND b.transaction_period = d.transaction_period
        LEFT JOIN {{oc_lt_bets}} lb ON lb.patron_id = d.patron_id
        LEFT JOIN {{oc_taken}} w ON w.patron_id = d.patron_id AND w.transaction_period = d.transaction_period
        LEFT JOIN {{oc_lt_taken}} lw ON lw.patron_id = d.patron_id LEFT JOIN {{oc_lt_given}} ld ON ld.patron_id = d.patron_id
        LEFT JOIN {{payment}} p ON p.patron_id = d.patron_id LEFT JOIN {{oc_ggr}} g ON g.patron_id = d.patron_id
        {joins} WHERE {where}"""


checks(
    r11_non_earning_occupation=occupation("", "", within("d.transaction_period", L0, L1)),
    r12_non_earning_rolling=occupation(
        f"""s.n AS r6_deposits, {usd('s.cents')} AS r6_deposit_amount, t.n AS r12_deposits, {usd('t.cents')} AS r12_deposit_amount,""",
        "LEFT JOIN {over_six} s ON s.patron_id = d.patron_id LEFT JOIN {over_twelve} t ON t.patron_id = d.patron_id",
        "s.cents IS NOT NULL OR t.cents IS NOT NULL",
    ),
)

# the same report from a state carried to the start of the period
checks(r03_player_activity_carried=CHECKS["r03_player_activity"])
# and with the ids of free bets from a kept index
checks(r01_results_detail_indexed=CHECKS["r01_results_detail"], r05_ggr_by_product_indexed=CHECKS["r05_ggr_by_product"])
