"""Schemas of the input tables: UTC times without zone, integer cents, text ids."""

from __future__ import annotations

from pyspark.sql import types as T

_TYPES = {
    "s": T.StringType(),
    "l": T.LongType(),
    "i": T.IntegerType(),
    "t": T.TimestampNTZType(),
    "d": T.DateType(),
    "b": T.BooleanType(),
    "p": T.DecimalType(20, 4),
}


def _table(**groups: str) -> T.StructType:
    fields = []
    for code, names in groups.items():
        fields += [T.StructField(name, _TYPES[code]) for name in names.split()]
    return T.StructType(fields)


SCHEMAS: dict[str, T.StructType] = {
    # one row per ledger posting leg
    "accounting": _table(
        s="ledger_transaction_id patron_transaction_id p_id parent_id a_patron_id p_patron_id bet_history_id "
        "p_bet_id p_vegas_bet_id a_type p_type t_type gaming_state adjustment_reason adjustment_type",
        l="debit_cents credit_cents",
        t="t_changed_at",
    ),
    "bets": _table(
        s="id patron_id type status outcome free_bet_id gaming_state",
        l="bet_amount_cents payout_amount_cents",
        t="placed_at closed_at",
        b="regraded",
    ),
    "bets_history": _table(
        s="id patron_id type status outcome free_bet_id promo_engine_free_bet_id",
        p="price",
        l="bet_amount_cents win_amount_cents payout_amount_cents",
        t="placed_at closed_at _changed_at updated_at",
    ),
    "bet_states": _table(
        s="bet_history_id state previous_state free_bet_id promo_engine_free_bet_id",
        i="previous_ordinal",
        t="new_timestamp new_previous_timestamp",
    ),
    "legs": _table(
        s="vegas_bet_id market market_classification event market_selection_name", i="num_legs num_live_legs"
    ),
    "patron_transactions": _table(s="id patron_id", t="_changed_at"),
    "casino_wagers": _table(
        s="patron_transaction_id promo_engine_free_round_award_id gaming_state metadata", l="amount_cents", t="_changed_at"
    ),
    "casino_payouts": _table(
        s="patron_transaction_id promo_engine_free_round_award_id gaming_state", l="amount_cents", t="_changed_at"
    ),
    "casino_wager_rollbacks": _table(s="patron_transaction_id", t="_changed_at"),
    "wager_and_game_info": _table(
        s="patron_transaction_id patron_id parent_id type game_id game_name game_category casino_session_id "
        "promo_engine_free_round_award_id",
        l="amount_cents",
        t="transaction_timestamp_utc",
    ),
    "rollback_payout_info": _table(s="patron_transaction_id game_id"),
    "games": _table(s="id name game_provider category game_provider_game_category"),
    "wallet_transactions": _table(
        s="id game_provider game_provider_game_round_id game_provider_transaction_id parent_wallet_transaction_id "
        "remote_wallet_transaction_id game_session_id free_round_award_id identity_user_id",
        l="amount",
        t="_changed_at updated_at",
    ),
    "wallet_transaction_jackpots": _table(
        s="wallet_transaction_id jackpot_id type", l="amount_units amount_nanos", t="inserted_at _changed_at updated_at"
    ),
    "jackpots": _table(s="id display_name", t="_changed_at updated_at"),
    "users": _table(
        s="patron_id customer_id username first_name last_name gender employment_status job_title employer_name",
        d="birthdate",
        b="is_tester",
        t="inserted_at registration_completed_at last_login_at",
    ),
    "account_users": _table(
        s="id first_name last_name", d="birthdate", t="inserted_at last_login_at registration_completed_at"
    ),
    "kyc_verifications": _table(
        s="user_id status document_type document_reference_number", d="document_expiration_date"
    ),
    "emails": _table(s="user_id email"),
    "addresses": _table(s="user_id line_1 line_2 city region postal_code"),
    "phone_numbers": _table(s="user_id number"),
    "break_status": _table(s="patron_id BreakStart BreakEnd"),
    "self_exclusion_status": _table(s="patron_id SEStart SEEnd"),
    "bonus_transactions": _table(s="user_id transaction_type", l="transaction_amount", t="transaction_timestamp_utc"),
    "user_award_bonus_cash": _table(s="id user_id", l="amount_cents", t="expires_at"),
    "user_bonus_cash_transactions": _table(
        s="user_award_bonus_cash_id transaction_type", l="amount_cents", t="t_changed_at"
    ),
    "user_award_free_bets": _table(s="id user_id award_free_bet_id", t="awarded_at updated_at"),
    "user_award_free_wagers": _table(s="id user_id award_free_wager_id", t="awarded_at updated_at"),
    "award_free_bets": _table(s="id promotion_id", l="amount_cents"),
    "award_free_wagers": _table(s="id promotion_id", l="amount_cents"),
    "promotions": _table(s="id name promotion_type", t="updated_at"),
    "payment_deposits": _table(
        s="deposit_id provider_id customer_id type last_digits state", l="amount_requested_cents"
    ),
    "payment_providers": _table(s="id name merchant_id"),
    "payment_merchants": _table(s="id name"),
    "payment_customers": _table(s="id user_id"),
    "payment_users": _table(s="id patron_id"),
}
