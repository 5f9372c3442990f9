"""Revenue roll-ups: results detail, per-player GGR, game activity."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallybook.functions.labels import (
    account_designation,
    bet_type_a,
    bet_type_b,
    event_text,
    game_segment,
    provider_segment,
)
from tallybook.functions.money import DOLLARS, EXACT, dollars, exact_dollars, exact_sum
from tallybook.functions.periods import ReportWindow, bucket, to_local
from tallybook.lineage import compute_once
from tallybook.operators.ledger import ONTARIO, spread_key
from tallybook.operators.measures import stack_measures, union_measures

CENTS = "bigint"
SPORTS_MEASURES = {"placed": CENTS, "paid": CENTS, "voided": CENTS, "resettled": CENTS}
CASINO_MEASURES = {
    "placed": CENTS,
    "rolled_back": CENTS,
    "paid": CENTS,
    "jackpot_contribution": EXACT,
    "jackpot_win": EXACT,
}


def sports_stack(placed: DataFrame, voided: DataFrame, resettled: DataFrame, paid: DataFrame) -> DataFrame:
    """Stakes, voids, resettlements and payouts per (ts, bet, player)."""
    return stack_measures(
        [
            (placed, {"placed": "cents"}),
            (voided, {"voided": "cents"}),
            (resettled, {"resettled": "cents"}),
            (paid, {"paid": "cents"}),
        ],
        ["ts", "bet_id", "patron_id"],
        SPORTS_MEASURES,
    )


def casino_stack(
    wagers: DataFrame, free_rounds: DataFrame, rollbacks: DataFrame, payouts: DataFrame,
    contributions: DataFrame | None = None, wins: DataFrame | None = None,
) -> DataFrame:
    """Casino rows of the results detail, one per source row.

    Every frame holds (gaming_state, ts, wager_id, ref_id, patron_id) and its amount.
    """
    sources: list[tuple[DataFrame, Mapping[str, Column | str]]] = [
        (wagers, {"placed": "cents"}),
        (free_rounds, {"placed": "cents"}),
        (rollbacks, {"rolled_back": "cents"}),
        (payouts, {"paid": "cents"}),
    ]
    if contributions is not None:
        sources.append((contributions, {"jackpot_contribution": "amount"}))
    if wins is not None:
        sources.append((wins, {"jackpot_win": "amount"}))
    return union_measures(sources, ["gaming_state", "ts", "wager_id", "ref_id", "patron_id"], CASINO_MEASURES)


def results_detail(
    sports: DataFrame,
    market: DataFrame,
    casino: DataFrame,
    wager_info: DataFrame,
    users: DataFrame,
    window: ReportWindow,
    *,
    jackpots: bool,
    ordered: bool = False,
) -> DataFrame:
    """Revenue per wager, sports and casino.

    With jackpots the rows are summed per wager; without them casino rows stay one per movement.
    No row is dropped for being zero: the resettlement amount is never missing, which is what
    the reference's filter asks. ``ordered`` sorts by the first eleven columns, missing values last; a
    global sort reads its input twice, so it is left to the caller.
    """
    tz = window.tz
    accounts = users.select("patron_id", account_designation("is_tester").alias("Account Designation"))

    dims = market.select(
        F.col("bet_id").alias("_bet"), "event_type", "bet_type", "market_type", "event_description", "event_timestamp",
        "selection",
    )
    bets = sports.where(window.holds_local("ts")).withColumn("_key", spread_key(F.col("bet_id"), "patron_id", "ts"))
    bets = bets.join(dims, F.col("_key") == F.col("_bet"), "left").join(accounts, "patron_id")
    sports_rows = bets.select(
        F.lit(ONTARIO).alias("Gaming State"),
        F.col("ts").cast("date").alias("Gaming Date"),
        F.lit("Sports").alias("Product"),
        bucket("ts", "second").alias("Transaction Time"),
        F.col("bet_id").alias("Wager ID"),
        F.lit(None).cast("string").alias("Patron Transaction ID"),
        F.col("patron_id").alias("Account Number"),
        "Account Designation",
        F.col("event_type").alias("Wager Type"),
        F.col("bet_type").alias("Wager Description"),
        event_text(
            F.col("event_description"), F.col("bet_type"), F.col("market_type"), any_case=jackpots
        ).alias("Event Description"),
        bucket(to_local("event_timestamp", tz), "second").alias("Event Date"),
        F.col("selection").alias("Selection"),
        F.col("placed").alias("_placed"),
        (-F.col("paid")).alias("_paid"),
        (-F.col("voided")).alias("_voided"),
        F.col("resettled").alias("_resettled"),
        F.lit(0).cast(CENTS).alias("_rolled_back"),
        F.lit(0).cast(EXACT).alias("_contribution"),
        F.lit(0).cast(EXACT).alias("_win"),
    )

    games = wager_info.select(F.col("patron_transaction_id").alias("_tx"), "game_category", "game_name")
    spins = casino.where(window.holds_local("ts")).withColumn("_key", spread_key(F.col("ref_id"), "patron_id", "ts"))
    spins = spins.join(games, F.col("_key") == F.col("_tx"), "left").join(accounts, "patron_id")

    def or_zero(name: str, kind: str) -> Column:
        return F.coalesce(name, F.lit(0).cast(kind))

    casino_rows = spins.select(
        F.col("gaming_state").alias("Gaming State"),
        F.col("ts").cast("date").alias("Gaming Date"),
        F.lit("Casino").alias("Product"),
        bucket("ts", "second").alias("Transaction Time"),
        F.col("wager_id").alias("Wager ID"),
        F.col("_tx").alias("Patron Transaction ID"),
        F.col("patron_id").alias("Account Number"),
        "Account Designation",
        game_segment("game_category").alias("Wager Type"),
        F.lit("Casino Wager").alias("Wager Description"),
        F.col("game_name").alias("Event Description"),
        F.lit(None).cast("timestamp_ntz").alias("Event Date"),
        F.lit(None).cast("string").alias("Selection"),
        or_zero("placed", CENTS).alias("_placed"),
        (-or_zero("paid", CENTS)).alias("_paid"),
        F.lit(0).cast(CENTS).alias("_voided"),
        F.lit(0).cast(CENTS).alias("_resettled"),
        (-or_zero("rolled_back", CENTS)).alias("_rolled_back"),
        (-or_zero("jackpot_contribution", EXACT)).cast(EXACT).alias("_contribution"),
        or_zero("jackpot_win", EXACT).alias("_win"),
    )

    keys = casino_rows.columns[:13]
    cents = ["_placed", "_paid", "_voided", "_resettled", "_rolled_back"]
    exact = ["_contribution", "_win"]

    def summed(rows: DataFrame) -> DataFrame:
        return rows.groupBy(*keys).agg(
            *[F.sum(c).alias(c) for c in cents], *[exact_sum(c).alias(c) for c in exact]
        )

    if jackpots:
        rows = summed(sports_rows.unionByName(casino_rows))
    else:
        rows = summed(sports_rows).unionByName(casino_rows)
    all_cents = F.col("_placed") + F.col("_paid") + F.col("_voided") + F.col("_resettled") + F.col("_rolled_back")
    columns = [
        *[F.col(k) for k in keys],
        dollars("_placed").alias("Wager Placed Amount"),
        dollars("_paid").alias("Wager Paid Amount"),
        dollars("_voided").alias("Void Wager Amount"),
        # bets are no longer cancelled; the column is still reported
        F.lit(0).cast(DOLLARS).alias("Cancelled Wager Amount"),
        dollars("_resettled").alias("Resettled Wager Adjustment"),
        dollars("_rolled_back").alias("Rollback Wager Amount"),
    ]
    if jackpots:
        gross = exact_dollars(all_cents) + F.col("_contribution") + F.col("_win")
        columns += [
            F.col("_contribution").alias("Jackpot Contributions and Reseeds"),
            F.col("_win").alias("Jackpot Win Payouts"),
            gross.cast(EXACT).alias("Gross Revenue"),
        ]
    else:
        columns.append(dollars(all_cents).alias("Gross Revenue"))
    out = rows.select(*columns)
    return out.orderBy(*[F.col(k).asc_nulls_last() for k in keys[:11]]) if ordered else out


def player_ggr(
    stack: DataFrame, market: DataFrame, players: DataFrame | None, window: ReportWindow | None = None
) -> DataFrame:
    """Placed - paid - voided + resettled per player, in cents.

    ``stack`` is summed per second, bet and player. A bet described by several market rows
    counts once for each, and a player once for each driver row; both are applied as weights on
    sums already made per (player, bet). A player with nothing but zero rows is left out.
    """
    rows = stack if window is None else stack.where(window.holds_local("ts"))
    moved = F.lit(False)
    for measure in SPORTS_MEASURES:
        moved |= F.col(measure) != 0
    amount = F.col("placed") - F.col("paid") - F.col("voided") + F.col("resettled")
    per_bet = rows.where(moved).groupBy("patron_id", "bet_id").agg(F.sum(amount).alias("cents"))
    described = market.groupBy(F.col("bet_id").alias("_bet")).agg(F.count(F.lit(1)).alias("_rows"))
    keyed = per_bet.withColumn("_key", spread_key(F.col("bet_id"), "patron_id"))
    weighted = keyed.join(described, F.col("_key") == F.col("_bet"), "left")
    weight = F.coalesce("_rows", F.lit(1))
    if players is not None:
        weighted = weighted.join(players.select("patron_id", "times"), "patron_id")
        weight = weight * F.col("times")
    return weighted.groupBy("patron_id").agg(F.sum(F.col("cents") * weight).alias("ggr_cents"))


GAME_KEYS = ["ProductCode", "ProductSegment", "Game", "BetTypeA", "BetTypeB"]
GAME_MEASURES = {
    "num_wagers": CENTS,
    "wagers_game": CENTS,
    "unsettled_wagers": CENTS,
    "win_game": CENTS,
    "win_jackpot": EXACT,
    "promo_wagers_game": CENTS,
    "promo_unsettled_wagers": CENTS,
    "withdrawable_win": CENTS,
    "withdrawable_jackpot": EXACT,
}


def game_activity(
    stack: DataFrame,
    wager_info: DataFrame,
    market: DataFrame,
    sessions: DataFrame,
    games: DataFrame,
    players: DataFrame,
    window: ReportWindow,
    site: str,
) -> DataFrame:
    """Wagers, wins and players per product, segment and game.

    ``stack`` holds one row per (ts, player, bet, transaction) and source. Bets take the market
    dimension and casino rows the game dimension, so neither join meets the other's missing key. The stack is
    summed per (player, bet, transaction) and stored first, so its sources are worked out once for both.
    """
    rows = stack.where(window.holds_local("ts")).join(players, "patron_id", "left_semi")
    rows = compute_once(
        rows.groupBy("patron_id", "bet_id", "ref_id").agg(
            *[F.sum(m).cast(kind).alias(m) for m, kind in GAME_MEASURES.items()], F.max(F.col("num_wagers") > 0).alias("_active")
        )
    )
    on_game = wager_info.select(F.col("patron_transaction_id").alias("_tx"), "game_id")
    named = games.select(F.col("id").alias("_game"), F.col("name").alias("_name"), "game_provider_game_category")
    played = sessions.join(named, F.col("game_id") == F.col("_game"), "left").select(
        F.col("game_id").alias("_played"),
        F.col("_name"),
        F.when(F.col("_game").isNotNull(), F.col("game_provider_game_category")).alias("_category"),
        "num_game_sessions",
        "total_gameplay_duration",
    )
    spins = rows.where(F.col("bet_id").isNull()).withColumn("_key", spread_key(F.col("ref_id"), "patron_id"))
    spins = spins.join(on_game, F.col("_key") == F.col("_tx"), "left")
    spins = spins.withColumn("_game_key", spread_key(F.col("game_id"), "patron_id", "ref_id"))
    spins = spins.join(played, F.col("_game_key") == F.col("_played"), "left")
    nothing = F.lit(None).cast("string")
    casino = spins.select(
        "patron_id",
        "_active",
        *GAME_MEASURES,
        F.lit("Casino").alias("ProductCode"),
        provider_segment("_category").alias("ProductSegment"),
        F.col("_name").alias("Game"),
        nothing.alias("BetTypeA"),
        nothing.alias("BetTypeB"),
        "num_game_sessions",
        "total_gameplay_duration",
    )
    dims = market.select(F.col("bet_id").alias("_bet"), "event_type", "num_legs", "num_live_legs")
    bets = rows.where(F.col("bet_id").isNotNull()).join(dims, F.col("bet_id") == F.col("_bet"), "left")
    none = F.lit(None).cast("bigint")
    sports = bets.select(
        "patron_id",
        "_active",
        *GAME_MEASURES,
        F.lit("Betting").alias("ProductCode"),
        F.lit("Sports").alias("ProductSegment"),
        F.col("event_type").alias("Game"),
        bet_type_a("num_legs").alias("BetTypeA"),
        bet_type_b("num_live_legs", "num_legs").alias("BetTypeB"),
        none.alias("num_game_sessions"),
        none.alias("total_gameplay_duration"),
    )
    keys = GAME_KEYS
    # per player first: the distinct count becomes a plain count
    per_player = casino.unionByName(sports).groupBy(*keys, "patron_id").agg(
        *[F.sum(m).alias(m) for m in GAME_MEASURES],
        F.max("_active").alias("_active"),
        F.max("num_game_sessions").alias("num_game_sessions"),
        F.max("total_gameplay_duration").alias("total_gameplay_duration"),
    )
    sums = per_player.groupBy(*keys).agg(
        *[F.coalesce(F.sum(m), F.lit(0)).cast(kind).alias(m) for m, kind in GAME_MEASURES.items()],
        F.count(F.when(F.col("_active"), F.col("patron_id"))).alias("#ofUniquePlayers"),
        F.max("num_game_sessions").alias("#ofGameSessions"),
        F.max("total_gameplay_duration").alias("TotalGameplayDuration"),
    )

    def rounded(cents: str, exact: str) -> Column:
        return (exact_dollars(cents) + F.col(exact)).cast(DOLLARS)

    win = rounded("win_game", "win_jackpot")
    return sums.select(
        F.date_format(F.lit(window.start.date()), "yyyyMMdd").alias("GamingDay"),
        F.lit(site).alias("GamingSiteID"),
        *keys,
        "#ofGameSessions",
        "TotalGameplayDuration",
        "#ofUniquePlayers",
        F.col("num_wagers").alias("#ofWagers"),
        dollars("wagers_game").alias("WagersGame"),
        dollars("unsettled_wagers").alias("UnsettledWagers"),
        win.alias("WinGame"),
        F.lit(0).cast(DOLLARS).alias("Fees"),
        (dollars("wagers_game") - win).cast(DOLLARS).alias("NonAdjustedGGR"),
        dollars("promo_wagers_game").alias("PromoWagersGame"),
        dollars("promo_unsettled_wagers").alias("PromoUnsettledWagers"),
        F.lit(0).cast(DOLLARS).alias("PromoWinGame"),
        rounded("withdrawable_win", "withdrawable_jackpot").alias("WithdrawableWin"),
    )
