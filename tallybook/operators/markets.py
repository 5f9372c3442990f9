"""Bet and market dimension."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# --- fixed values -----------------------------------------------------------------------------
EVENT_FIELDS = "name string, start_time string, sport string, competition string"
PARLAY_TYPES = ("parlay", "parlay_plus")
MARKET_CLASSES = {
    "main": "Straight Wager",
    "player_prop": "Future Wager",
    "game_prop": "Future Wager",
    "future": "Future Wager",
    "promo": "Future Wager",
}
# ----------------------------------------------------------------------------------------------


def _unescaped(text: Column) -> Column:
    """A pipe that was escaped with a backslash is not valid JSON; take the backslash away."""
    return F.replace(text, F.lit("\\|"), F.lit("|"))


def _field(text: Column, name: str) -> Column:
    return F.get_json_object(_unescaped(text), f"$.{name}")


def _market_class(code: Column) -> Column:
    chain = None
    for key, label in MARKET_CLASSES.items():
        chain = F.when(code == key, label) if chain is None else chain.when(code == key, label)
    return chain


def bet_and_market_info(bets: DataFrame, legs: DataFrame) -> DataFrame:
    """One row per straight leg and per parlay, described by market, league and event.

    The bet id is the leg's: a bet without legs yields a row with no id.
    """
    leg_cols = legs.select(
        "vegas_bet_id", "market", "market_classification", "event", "market_selection_name", "num_legs", "num_live_legs"
    )
    singles = bets.where(F.col("type") == "straight").select("id")
    # the event is parsed once for its four fields; two of them are JSON texts themselves
    straights = (
        singles.join(leg_cols, F.col("id") == F.col("vegas_bet_id"), "left")
        .withColumn("_event", F.from_json(_unescaped(F.col("event")), EVENT_FIELDS))
        .select(
            F.col("vegas_bet_id").alias("bet_id"),
            _field(F.col("market"), "name").alias("market_type"),
            _market_class(F.col("market_classification")).alias("bet_type"),
            F.upper(_field(F.col("_event.competition"), "name")).alias("league"),
            F.initcap(_field(F.col("_event.sport"), "name")).alias("event_type"),
            F.col("_event.name").alias("event_description"),
            F.col("_event.start_time").try_cast("timestamp_ntz").alias("event_timestamp"),
            F.col("market_selection_name").alias("selection"),
            "num_legs",
            "num_live_legs",
        )
        .distinct()
    )
    combined = bets.where(F.col("type").isin(*PARLAY_TYPES)).select("id", "type")
    per_bet = leg_cols.groupBy("vegas_bet_id").agg(
        F.max("num_legs").alias("num_legs"), F.max("num_live_legs").alias("num_live_legs")
    )
    # bets without legs all share the missing id, so the maxima are taken once more after the join
    parlays = (
        combined.join(per_bet, F.col("id") == F.col("vegas_bet_id"), "left")
        .groupBy("vegas_bet_id", "type")
        .agg(F.max("num_legs").alias("num_legs"), F.max("num_live_legs").alias("num_live_legs"))
        .select(
            F.col("vegas_bet_id").alias("bet_id"),
            *[F.col("type").alias(c) for c in ("market_type", "bet_type", "league", "event_type")],
            F.lit(None).cast("string").alias("event_description"),
            F.lit(None).cast("timestamp_ntz").alias("event_timestamp"),
            F.lit(None).cast("string").alias("selection"),
            "num_legs",
            "num_live_legs",
        )
    )
    return straights.unionByName(parlays)
