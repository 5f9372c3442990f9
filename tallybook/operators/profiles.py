"""Player enrichment: payments, wide joins, status, account and bet sheets."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallybook.functions.money import total
from tallybook.functions.periods import bucket, to_local
from tallybook.operators.snapshots import latest_asof

# --- fixed values -----------------------------------------------------------------------------
ACCEPTED_KYC = ("success", "approved")
NO_INFO = "No Info"
UNSENT_STATE = "created"
# ----------------------------------------------------------------------------------------------


def _bare(col: str) -> Column:
    return F.coalesce(F.btrim(F.col(col), F.lit('"')), F.lit(NO_INFO))


def payment_profile(
    deposits: DataFrame,
    providers: DataFrame,
    merchants: DataFrame,
    customers: DataFrame,
    payment_users: DataFrame,
    users: DataFrame,
    *,
    tz: str,
    players: DataFrame | None = None,
) -> DataFrame:
    """Deposits, merchants, providers and cards a player has paid with.

    ``players`` restricts the profile to a driver set. Distinct values are found in two steps from one tagged
    pass, so a player with a million cards is spread over the tasks and no set is held in a row.
    """
    rows = (
        deposits.where(F.col("state") != UNSENT_STATE)
        .join(
            providers.select(F.col("id").alias("provider_id"), F.col("name").alias("provider"), "merchant_id"),
            "provider_id",
        )
        .join(merchants.select(F.col("id").alias("merchant_id"), F.col("name").alias("merchant")), "merchant_id")
        .join(customers.select(F.col("id").alias("customer_id"), "user_id"), "customer_id")
        .join(payment_users.select(F.col("id").alias("user_id"), "patron_id"), "user_id")
    )
    if players is not None:
        rows = rows.join(players, "patron_id", "left_semi")
    rows = rows.join(users.select("patron_id", "username", "registration_completed_at", "last_login_at"), "patron_id")
    card = F.concat(_bare("type"), F.lit("-"), _bare("last_digits"))
    kinds = {"deposits": F.col("deposit_id").cast("string"), "merchants": F.col("merchant"), "providers": F.col("provider"), "payment_cards": card}
    tags = F.array(*[F.struct(F.lit(k).alias("kind"), v.alias("value")) for k, v in kinds.items()])
    tagged = rows.select("patron_id", "username", "registration_completed_at", "last_login_at", "amount_requested_cents", F.inline(tags))
    # first every value of a player once, spread over the tasks by value; then the values are counted
    player = ["username", "patron_id", "registration_completed_at", "last_login_at"]
    amount = F.sum(F.when(F.col("kind") == "deposits", F.col("amount_requested_cents")))
    once = tagged.groupBy(*player, "kind", "value").agg(amount.alias("amount_cents"))
    return once.groupBy(
        "username",
        "patron_id",
        bucket(to_local("registration_completed_at", tz), "second").alias("kyc_date"),
        bucket(to_local("last_login_at", tz), "second").alias("last_login_at"),
    ).agg(
        F.sum("amount_cents").alias("amount_cents"),
        *[F.count(F.when(F.col("kind") == k, F.col("value"))).alias(k) for k in kinds],
    )


def enrich(
    driver: DataFrame,
    frames: Sequence[tuple[DataFrame, Sequence[str]]],
    fills: Mapping[str, int] | None = None,
) -> DataFrame:
    """Left-join per-player frames to a driver and fill what is missing."""
    wide = driver
    for frame, on in frames:
        wide = wide.join(frame, list(on), "left")
    for name, value in (fills or {}).items():
        wide = wide.withColumn(name, F.coalesce(name, F.lit(value)))
    return wide


def ratio(top: str, bottom: str) -> Column:
    """Quotient of two cent amounts, unknown where the divisor is 0 or missing."""
    a = F.col(top).cast("decimal(20,0)")
    b = F.nullif(F.col(bottom), F.lit(0)).cast("decimal(20,0)")
    return (a / b).cast("decimal(38,6)")


def status_flags(players: DataFrame, status: DataFrame, start: str, end: str, flag: str) -> DataFrame:
    """Flag "1" where a status has an end; start and end come out as text, empty if missing."""
    marks = status.select("patron_id", start, end)
    return players.join(marks, "patron_id", "left").withColumns(
        {
            flag: F.when(F.col(end).isNull(), "0").otherwise("1"),
            start: F.coalesce(start, F.lit("")),
            end: F.coalesce(end, F.lit("")),
        }
    )


def account_sheet(
    users: DataFrame,
    kyc: DataFrame,
    emails: DataFrame,
    addresses: DataFrame,
    phones: DataFrame,
    ids: DataFrame,
) -> DataFrame:
    """Verified account details of the listed players."""
    wanted = users.where(F.col("registration_completed_at").isNotNull()).join(
        ids.select("id"), "id", "left_semi"
    )
    verified = kyc.where(F.col("status").isin(*ACCEPTED_KYC) & F.col("document_type").isNotNull()).select(
        F.col("user_id").alias("id"), "document_type", "document_expiration_date", "document_reference_number"
    )

    def attach(rows: DataFrame, extra: DataFrame, *cols: Column | str) -> DataFrame:
        return rows.join(extra.select(F.col("user_id").alias("id"), *cols), "id", "left")

    rows = wanted.select("id", "first_name", "last_name", "birthdate", "inserted_at", "last_login_at").join(verified, "id")
    rows = attach(rows, emails, "email")
    rows = attach(
        rows,
        addresses,
        F.initcap("line_1").alias("line_1"),
        "line_2",
        F.initcap("city").alias("city"),
        "region",
        "postal_code",
    )
    rows = attach(rows, phones, F.col("number").alias("phone_number"))
    return rows.groupBy(
        "id",
        "first_name",
        "last_name",
        F.col("birthdate").cast("date").alias("birthdate"),
        "email",
        "line_1",
        "line_2",
        "city",
        "region",
        "postal_code",
        "phone_number",
        "document_type",
        "document_expiration_date",
        "document_reference_number",
    ).agg(
        F.min(F.col("inserted_at").cast("date")).alias("account_created"),
        F.max(F.col("last_login_at").cast("date")).alias("last_log_in"),
    )


def bet_history(
    history: DataFrame, users: DataFrame, ids: DataFrame, cutoff: datetime
) -> DataFrame:
    """Bets of the listed players as they stood at the cutoff, ordered.

    Only bets that ever belonged to a listed player are versioned; whose they are at the cutoff
    is decided by the version found.
    """
    listed = ids.select("patron_id").distinct()
    candidates = history.join(listed, "patron_id", "left_semi").select("id").distinct()
    versions = history.join(candidates, "id", "left_semi")
    current = latest_asof(versions, ["id"], ["_changed_at", "updated_at"], cutoff)
    current = current.join(listed, "patron_id", "left_semi")
    names = users.select("patron_id", "first_name", "last_name")
    return (
        current.join(names, "patron_id", "left")
        .orderBy("patron_id", "id", "_changed_at")
        .select(
            "first_name",
            "last_name",
            "patron_id",
            "id",
            "type",
            "price",
            "bet_amount_cents",
            "win_amount_cents",
            "payout_amount_cents",
            F.coalesce("free_bet_id", "promo_engine_free_bet_id").alias("free_bet_id"),
            "status",
            "outcome",
            "placed_at",
            "closed_at",
        )
    )
