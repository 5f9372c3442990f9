"""Shared models and the small reports: jackpots (R08), used free wagers (R07), markets (R09),
account sheet (R13), bet history (R14)."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime, timedelta

from pyspark.sql import DataFrame

from tallybook.functions.periods import ReportWindow
from tallybook.operators import jackpots as jp
from tallybook.operators import markets, profiles, promos
from tallybook.operators.snapshots import latest_asof
from tallybook.sources.catalog import Catalog

# --- fixed values -----------------------------------------------------------------------------
WALLET_GRACE = timedelta(minutes=2)
# ----------------------------------------------------------------------------------------------


def jackpots_from_history(
    tables: Catalog,
    cutoff: datetime,
    *,
    jackpots: DataFrame | None = None,
    attrs: Sequence[str] = jp.WALLET_ATTRS,
) -> DataFrame:
    """Jackpot model over version history (R08): wallets and links have two minutes of grace.

    Names come from the snapshot given, else from the history up to the cutoff. With fewer ``attrs`` the rows are
    the same ones, and the wallets' history travels without what is left out.
    """
    wallets = tables.wallet_transactions
    if tuple(attrs) != jp.WALLET_ATTRS:
        wallets = jp.wallets_with(wallets, attrs)
    names = jackpots if jackpots is not None else latest_asof(tables.jackpots, ["id"], cutoff=cutoff)
    return jp.jackpot_model(
        latest_asof(wallets, ["id"], cutoff=cutoff, grace=WALLET_GRACE),
        latest_asof(
            tables.wallet_transaction_jackpots,
            ["wallet_transaction_id", "jackpot_id"],
            cutoff=cutoff,
            grace=WALLET_GRACE,
        ),
        names,
        attrs=attrs,
    )


def stored_jackpots(tables: Catalog, cutoff: datetime) -> DataFrame:
    """The jackpot model at a cutoff, with what reports read of it, made once for all that are given this catalog."""
    return tables.once(("jackpots", cutoff), lambda: jackpots_from_history(tables, cutoff, attrs=jp.REPORT_ATTRS))


def jackpots_from_current(tables: Catalog, cutoff: datetime) -> DataFrame:
    """Jackpot model over current tables with a single clock, carrying the player.

    The names are joined from the table as it is, not from its latest rows.
    """
    clock = ["updated_at"]
    return jp.jackpot_model(
        latest_asof(tables.wallet_transactions, ["id"], clock, cutoff, WALLET_GRACE),
        latest_asof(
            tables.wallet_transaction_jackpots, ["wallet_transaction_id", "jackpot_id"], clock, cutoff, WALLET_GRACE
        ),
        tables.jackpots,
        carry_change=False,
        carry_patron=True,
    )


def used_free_wagers(
    tables: Catalog, window: ReportWindow, run_at: datetime, *, model: DataFrame | None = None
) -> DataFrame:
    """Free bets and free rounds settled in the period (R07); ``model`` is the jackpot model if there is one."""
    rounds = promos.free_round_lifecycle(
        tables.wager_and_game_info,
        tables.patron_transactions,
        tables.casino_wagers,
        tables.casino_payouts,
        tables.casino_wager_rollbacks,
        model if model is not None else jackpots_from_history(tables, window.end_utc, attrs=jp.REPORT_ATTRS),
        window,
    )
    settled = promos.settled_free_bets(tables.bets).unionByName(rounds)
    awards = promos.free_wager_awards(
        tables.user_award_free_bets,
        tables.award_free_bets,
        tables.user_award_free_wagers,
        tables.award_free_wagers,
        tz=window.tz,
    )
    programmes = promos.award_programmes(tables.promotions, tables.award_free_bets, tables.award_free_wagers)
    return promos.used_free_wagers(settled, tables.users, awards, programmes, window, run_at=run_at)


def bet_and_market_info(tables: Catalog) -> DataFrame:
    """Bet and market dimension over one source set."""
    return markets.bet_and_market_info(tables.bets, tables.legs)


def account_sheet(tables: Catalog, ids: DataFrame) -> DataFrame:
    """Account sheet of the listed players."""
    return profiles.account_sheet(
        tables.account_users,
        tables.kyc_verifications,
        tables.emails,
        tables.addresses,
        tables.phone_numbers,
        ids,
    )


def bet_history(tables: Catalog, ids: DataFrame, cutoff: datetime) -> DataFrame:
    """Bet history of the listed players at the cutoff."""
    return profiles.bet_history(tables.bets_history, tables.users, ids, cutoff)


