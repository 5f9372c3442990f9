"""The ledger cut to what a report's flows read (R03, R04), or to its players (R10-R12), read once for all of them.

Every flow of a driven report starts from the postings of the driver's players. They are taken in one narrow
pass and stored. What a flow needs beyond them, the house's legs of the players' transactions and the ids of
free bets, is reached by transaction id in one more pass.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallybook.lineage import compute_once
from tallybook.operators.ledger import FREE_BET_TYPE, LegPair

#: Columns that some flow reads.
POSTING = (
    "ledger_transaction_id",
    "patron_transaction_id",
    "a_patron_id",
    "bet_history_id",
    "p_bet_id",
    "p_vegas_bet_id",
    "a_type",
    "p_type",
    "t_type",
    "adjustment_reason",
    "adjustment_type",
    "debit_cents",
    "credit_cents",
    "t_changed_at",
)
#: Keys over which free-bet postings are spread, since all of them are wanted.
SPREAD = 1024


def flow_postings(ledger: DataFrame, ids: Mapping[str, Column], others: Column, columns: Sequence[str]) -> DataFrame:
    """The postings that some flow reads, in the columns flows read; stored.

    ``ids`` says of each id column which postings it is read of; in others it stays empty. It must not name a
    column that a flow chooses its postings by. ``others`` are postings read without an id.
    """
    rows = ledger.where(reduce(Column.__or__, ids.values(), others))
    return compute_once(rows.select(*[F.when(read, F.col(c)).alias(c) for c, read in ids.items()], *columns))


def player_postings(ledger: DataFrame, players: DataFrame, wanted: Mapping[str, Column]) -> DataFrame:
    """The players' postings of any wanted kind, in the columns flows read; stored.

    ``wanted`` says of each id column which kinds of postings are read by it; in others it stays empty, which
    is most of what a copy costs. ``players`` has one row per player, so rows are neither lost nor repeated.
    """
    own = players.select(F.col("patron_id").alias("a_patron_id"))
    rows = ledger.where(reduce(Column.__or__, wanted.values())).join(own, "a_patron_id", "left_semi")
    return compute_once(rows.select(*[F.when(wanted[c], F.col(c)).alias(c) if c in wanted else c for c in POSTING]))


def reached_postings(ledger: DataFrame, mine: DataFrame, pairs: Sequence[LegPair], *, free_bets: bool = False) -> DataFrame:
    """Credit legs of the transactions that the players' debit legs belong to, whoever they name; stored.

    With ``free_bets`` the postings that name free bets come along, all of them, since a credit leg may be of
    a bet the player has no posting of. A row is either a leg or a free bet's, so it is there once.
    """
    debit, credit = F.lit(False), F.lit(False)
    for pair in pairs:
        debit |= pair.is_leg("debit")
        credit |= pair.is_leg("credit")
    leg = credit & (F.col("credit_cents") > 0)
    free = (F.col("p_type") == FREE_BET_TYPE) if free_bets else F.lit(False)
    key = F.when(leg, F.col("ledger_transaction_id")).when(
        free, F.concat(F.lit("\x00"), F.pmod(F.xxhash64("p_vegas_bet_id", "p_bet_id"), F.lit(SPREAD)).cast("string"))
    )
    own = mine.where(debit & (F.col("debit_cents") > 0)).select(F.col("ledger_transaction_id").alias("_key")).distinct()
    if free_bets:
        spread = ledger.sparkSession.range(SPREAD).select(F.concat(F.lit("\x00"), F.col("id").cast("string")).alias("_key"))
        own = own.union(spread)
    rows = ledger.where(leg | free).select(*POSTING, key.alias("_key"))
    return compute_once(rows.join(own, "_key", "left_semi").drop("_key"))
