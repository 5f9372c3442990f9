"""Casino flows: wagers, rollbacks, free rounds, payouts, game metadata."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallybook.functions.periods import ReportWindow, bucket, in_window, to_local
from tallybook.operators.ledger import (
    CASINO_ROLLBACKS,
    CASINO_WAGERS,
    CUSTOMER_LIABILITY,
    ONTARIO,
    matched,
    net_movement,
)

# --- fixed values -----------------------------------------------------------------------------
REMODELLED_SUFFIX = "_R3"
# ----------------------------------------------------------------------------------------------


def with_game(rows: DataFrame, wager_info: DataFrame, attrs: Sequence[str], amount: str = "cents") -> DataFrame:
    """Attach game attributes by patron transaction; a transaction without a game stays.

    Game rows that repeat, with the same attributes, become one that the amount is multiplied by: the sums
    are those of a plain join, and a transaction is still one row per set of attributes, so counting rows
    counts it once.
    """
    games = wager_info.where(F.col("patron_transaction_id").isNotNull())
    # laid out by transaction, the grouping and the join share one exchange
    games = games.select(F.col("patron_transaction_id").alias("_tx"), *attrs).repartition("_tx")
    games = games.groupBy("_tx", *attrs).agg(F.count(F.lit(1)).alias("_copies"))
    joined = rows.join(games, F.col("ref_id") == F.col("_tx"), "left")
    return joined.withColumn(amount, F.col(amount) * F.coalesce("_copies", F.lit(1))).drop("_tx", "_copies")


def transfer_to_casino(
    ledger: DataFrame,
    wager_info: DataFrame,
    window: ReportWindow,
    *,
    tz: str,
    extra: Sequence[str] = (),
    game: Sequence[str] = ("game_category", "game_id"),
) -> DataFrame:
    """Cash wagers per transaction with their game."""
    rows = in_window(ledger, "t_changed_at", window)
    wagers = matched(rows, CASINO_WAGERS, [to_local("posted_at", tz).alias("ts"), "patron_id", "ref_id", *extra], extra)
    if not game:
        return wagers
    columns = ["ts", "patron_id", "ref_id", *extra, *game, "cents"]
    return with_game(wagers, wager_info, game).select(*columns)


def casino_rollbacks(
    rollbacks: DataFrame,
    wager_info: DataFrame,
    window: ReportWindow,
    *,
    tz: str,
    patron_transactions: DataFrame | None = None,
    promo: bool | None = None,
) -> DataFrame:
    """Rolled-back wagers, cash and free told apart by ``is_promo`` (B20, rollback rows).

    The time is that of the patron transaction; without that table it is the rollback's own.
    """
    info = wager_info.where(F.col("type") == "rollback").select(
        "patron_transaction_id",
        "patron_id",
        F.col("game_category").alias("category"),
        F.col("promo_engine_free_round_award_id").isNotNull().alias("is_promo"),
        "amount_cents",
    )
    if promo is not None:
        info = info.where(F.col("is_promo") == promo)
    if patron_transactions is None:
        timed = in_window(rollbacks, "_changed_at", window).select("patron_transaction_id", "_changed_at")
    else:
        clocks = in_window(patron_transactions, "_changed_at", window).select(
            F.col("id").alias("patron_transaction_id"), "_changed_at"
        )
        timed = rollbacks.select("patron_transaction_id").join(clocks, "patron_transaction_id")
    return timed.join(info, "patron_transaction_id").groupBy(
        to_local("_changed_at", tz).alias("ts"),
        "patron_id",
        F.col("patron_transaction_id").alias("ref_id"),
        "category",
        "is_promo",
    ).agg(F.sum("amount_cents").alias("cents"))


def matched_rollbacks(
    ledger: DataFrame, *, by: Sequence[str | Column], credits: DataFrame | None = None
) -> DataFrame:
    """Rollbacks as matched ledger legs (B20, ledger form); ``credits`` where only debits are cut to a window."""
    return matched(ledger, CASINO_ROLLBACKS, by, credits=credits)


def free_rounds_wagered(
    wagers: DataFrame,
    patron_transactions: DataFrame,
    window: ReportWindow,
    *,
    tz: str,
    wager_info: DataFrame | None = None,
) -> DataFrame:
    """Stakes of free rounds, with the game category where game info is given."""
    rounds = wagers.where(F.col("promo_engine_free_round_award_id").isNotNull()).select(
        F.col("patron_transaction_id").alias("ref_id"), "amount_cents"
    )
    clocks = in_window(patron_transactions, "_changed_at", window).select(
        F.col("id").alias("ref_id"), "patron_id", to_local("_changed_at", tz).alias("ts")
    )
    rows = rounds.join(clocks, "ref_id")
    keys = ["ts", "patron_id", "ref_id"]
    if wager_info is not None:
        rows = with_game(rows, wager_info, ["game_category"], "amount_cents").withColumnRenamed("game_category", "category")
        keys.append("category")
    return rows.groupBy(*keys).agg(F.sum("amount_cents").alias("cents"))


def label_payouts(ledger: DataFrame, payouts: DataFrame) -> DataFrame:
    """Casino payout postings on the customer side with the free-round award they belong to."""
    rows = ledger.where((F.col("p_type") == "casino_payout") & (F.col("a_type") == CUSTOMER_LIABILITY))
    awards = payouts.select(
        F.col("patron_transaction_id").alias("_tx"), F.col("promo_engine_free_round_award_id").alias("award_id")
    )
    return rows.join(awards, F.col("patron_transaction_id") == F.col("_tx"), "left").drop("_tx")


def casino_payouts(
    ledger: DataFrame,
    payouts: DataFrame,
    window: ReportWindow,
    *,
    tz: str,
    cash_only: bool = True,
    extra: Sequence[str] = (),
) -> DataFrame:
    """Net customer movement of casino payouts; free rounds left out or labelled."""
    rows = label_payouts(in_window(ledger, "t_changed_at", window), payouts)
    if cash_only:
        rows = rows.where(F.col("award_id").isNull())
    keys = [to_local("t_changed_at", tz).alias("ts"), F.col("a_patron_id").alias("patron_id"), F.col("p_id").alias("ref_id")]
    return net_movement(rows, [*keys, *([] if cash_only else ["award_id"]), *extra])


def free_round_payouts(
    payouts: DataFrame, patron_transactions: DataFrame, window: ReportWindow, *, tz: str
) -> DataFrame:
    """Non-zero payouts of free rounds from the payout table."""
    paid = payouts.where(F.col("promo_engine_free_round_award_id").isNotNull() & (F.col("amount_cents") != 0))
    clocks = in_window(patron_transactions, "_changed_at", window).select(
        F.col("id").alias("ref_id"), "patron_id", to_local("_changed_at", tz).alias("ts")
    )
    rows = paid.select(F.col("patron_transaction_id").alias("ref_id"), "amount_cents").join(clocks, "ref_id")
    return rows.groupBy("ts", "patron_id", "ref_id").agg(F.sum("amount_cents").alias("cents"))


def game_payouts(
    wager_info: DataFrame,
    patron_transactions: DataFrame,
    payouts: DataFrame,
    games: DataFrame,
    players: DataFrame,
    window: ReportWindow,
    *,
    state: str = ONTARIO,
) -> DataFrame:
    """Cash payouts per transaction with the game they were won in (B61, game level)."""
    info = wager_info.where(F.col("promo_engine_free_round_award_id").isNull()).select(
        F.col("patron_transaction_id").alias("ref_id"), "patron_id", "game_id", "amount_cents"
    )
    paid = payouts.where(F.col("gaming_state") == state).select(F.col("patron_transaction_id").alias("ref_id"))
    clocks = in_window(patron_transactions, "_changed_at", window).select(F.col("id").alias("ref_id"), "_changed_at")
    catalogue = games.select(
        F.col("id").alias("game_id"),
        F.col("name").alias("game_name"),
        "game_provider",
        F.col("category").alias("game_category"),
    )
    rows = info.join(paid, "ref_id").join(clocks, "ref_id")
    # a semi join would be moved below the other joins and send every wager by player, not only what was paid
    rows = rows.join(players.select("patron_id").distinct(), "patron_id")
    return rows.join(catalogue, "game_id").groupBy(
        "_changed_at", "ref_id", "game_name", "game_provider", "game_category"
    ).agg(F.sum("amount_cents").alias("cents"))


def game_metadata(wagers: DataFrame, *, strip_suffix: bool = True) -> DataFrame:
    """Game name, category and provider read from the wager's JSON metadata."""
    name = F.get_json_object("metadata", "$.game_name")
    if strip_suffix:
        name = strip_game_suffix(name)
    return wagers.withColumns(
        {
            "game_name": name,
            "game_category": F.get_json_object("metadata", "$.game_category"),
            "game_provider": F.get_json_object("metadata", "$.game_provider"),
        }
    )


def strip_game_suffix(name: Column) -> Column:
    return F.replace(name, F.lit(REMODELLED_SUFFIX), F.lit(""))


def cash_rounds(
    wagers: DataFrame,
    patron_transactions: DataFrame,
    players: DataFrame,
    window: ReportWindow,
    *,
    state: str = ONTARIO,
) -> DataFrame:
    """Non-zero cash rounds from the wager table, one row per transaction and game."""
    rounds = wagers.where(
        F.col("promo_engine_free_round_award_id").isNull()
        & (F.col("amount_cents") != 0)
        & (F.col("gaming_state") == state)
    )
    rounds = game_metadata(rounds, strip_suffix=False).withColumnRenamed("patron_transaction_id", "ref_id")
    rounds = rounds.select("ref_id", "amount_cents", "game_name", "game_provider", "game_category")
    clocks = in_window(patron_transactions, "_changed_at", window).select(
        F.col("id").alias("ref_id"), "patron_id", "_changed_at"
    )
    rows = rounds.join(clocks, "ref_id").join(players, "patron_id", "left_semi")
    return rows.groupBy("_changed_at", "ref_id", "game_name", "game_provider", "game_category").agg(
        F.sum("amount_cents").alias("cents")
    )


def by_game_day(rows: DataFrame, *, tz: str) -> DataFrame:
    """Transaction rows rolled up to gaming day and game."""
    return rows.groupBy(
        bucket(to_local("_changed_at", tz), "day").alias("gaming_day"), "game_name", "game_provider", "game_category"
    ).agg(F.sum("cents").alias("cents"))
