"""Jackpot model, contributions, payouts and net adjustments."""

from __future__ import annotations

from collections.abc import Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallybook.functions.money import EXACT, dollars, exact_sum, units_and_nanos

# --- fixed values -----------------------------------------------------------------------------
ROUNDING_FLOOR = Decimal("0.01")
# ----------------------------------------------------------------------------------------------

WALLET_ATTRS = (
    "game_provider",
    "game_provider_game_round_id",
    "game_provider_transaction_id",
    "parent_wallet_transaction_id",
    "remote_wallet_transaction_id",
    "game_session_id",
    "free_round_award_id",
)
#: The attributes that reports read of the model.
REPORT_ATTRS = ("remote_wallet_transaction_id", "free_round_award_id")
OTHERS = "_other_attrs"


def wallets_with(wallet: DataFrame, attrs: Sequence[str]) -> DataFrame:
    """The wallets with some of their attributes; the others become one hash, which tells rows apart as they do.

    It is 64 bits wide and matters only between equal versions of one wallet.
    """
    others = [a for a in WALLET_ATTRS if a not in attrs]
    told_apart = F.xxhash64(*others, *[F.isnull(a) for a in others]).alias(OTHERS)
    return wallet.select(*[c for c in wallet.columns if c not in others], told_apart)


def jackpot_model(
    wallet: DataFrame,
    links: DataFrame,
    jackpots: DataFrame,
    *,
    carry_change: bool = True,
    carry_patron: bool = False,
    attrs: Sequence[str] = WALLET_ATTRS,
) -> DataFrame:
    """Jackpot part and remaining payout of every wallet transaction linked to a jackpot.

    The exact amount is units plus nanos. Only wins count the wallet amount; what is left of it
    is 0 when it differs from the jackpot by less than a cent. Each jackpot of a transaction is
    set against the wallet amount on its own. With fewer ``attrs`` the wallets are those of ``wallets_with``;
    the rows are the same ones.
    """
    attrs = [*attrs, *([OTHERS] if OTHERS in wallet.columns else [])]
    won = F.when(F.col("type") == "win", dollars("amount")).otherwise(F.lit(0)).cast("decimal(20,2)")
    links_in = links.select(
        "wallet_transaction_id",
        "jackpot_id",
        "type",
        "inserted_at",
        "updated_at",
        units_and_nanos("amount_units", "amount_nanos").alias("amount_precision"),
        *(["_changed_at"] if carry_change else []),
    )
    wallet_in = wallet.select(
        F.col("id").alias("wallet_transaction_id"),
        "amount",
        *attrs,
        *([F.col("identity_user_id").alias("patron_id")] if carry_patron else []),
    )
    names = jackpots.select(F.col("id").alias("jackpot_id"), "display_name")
    rows = links_in.join(wallet_in, "wallet_transaction_id").join(names, "jackpot_id").withColumn("wallet_amount", won)
    keys = [
        *(["_changed_at"] if carry_change else []),
        *(["patron_id"] if carry_patron else []),
        "wallet_transaction_id",
        "type",
        *attrs,
        "jackpot_id",
        "display_name",
        "amount_precision",
        "wallet_amount",
        "inserted_at",
        "updated_at",
    ]
    grouped = rows.groupBy(*keys).agg(exact_sum("amount_precision").alias("_jackpot"))
    rest = (F.col("wallet_amount") - F.col("_jackpot")).cast(EXACT)
    small = (rest < F.lit(ROUNDING_FLOOR)) & (rest > F.lit(-ROUNDING_FLOOR))
    return grouped.withColumns(
        {"casino_payout_normal": F.when(small, F.lit(0).cast(EXACT)).otherwise(rest), "casino_payout_precise": rest}
    ).drop("_jackpot", OTHERS)


def of_type(jackpots: DataFrame, kind: str, *, free: bool | None = None) -> DataFrame:
    """Jackpot rows of one kind as (ref_id, award_id, amount_precision); ``free`` picks the round type."""
    rows = jackpots.where(F.col("type") == kind)
    if free is not None:
        award = F.col("free_round_award_id")
        rows = rows.where(award.isNotNull() if free else award.isNull())
    return rows.select(
        F.col("remote_wallet_transaction_id").alias("ref_id"),
        F.col("free_round_award_id").alias("jackpot_award_id"),
        "amount_precision",
    )


def jackpot_contributions(wagers: DataFrame, jackpots: DataFrame, by: Sequence[str | Column]) -> DataFrame:
    """Contributions attached to the wagers that made them, summed by keys."""
    joined = wagers.join(of_type(jackpots, "contribution"), "ref_id")
    return joined.groupBy(*by).agg(exact_sum("amount_precision").alias("amount"))


def jackpot_payouts(
    payouts: DataFrame, jackpots: DataFrame, keys: Sequence[str], *, free: bool | None
) -> DataFrame:
    """Jackpots won on the given payouts; equal wins of one transaction count once."""
    joined = payouts.join(of_type(jackpots, "win", free=free), "ref_id")
    return joined.select(*keys, F.col("amount_precision").cast(EXACT).alias("amount")).distinct()


def net_adjustments(contributions: DataFrame, wins: DataFrame, by: Sequence[str]) -> DataFrame:
    """Contributions less wins by keys."""
    signed = contributions.select(*by, "amount").unionByName(wins.select(*by, (-F.col("amount")).alias("amount")))
    return signed.groupBy(*by).agg(exact_sum("amount").alias("amount"))
