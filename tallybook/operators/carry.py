"""Balances carried forward: a stored state per player and the postings since.

A balance of all time needs all postings only once. From then on a state holds what every player's flows add
up to, and a period adds its own days. The last days before a state's moment stay open: they are read again
with the next period, so postings that arrive late for them are in. Older late postings are handed in.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime, timedelta

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallybook.functions.periods import TORONTO, ReportWindow, bucket, in_window, moment, to_local
from tallybook.lineage import compute_once
from tallybook.operators.balances import PLAYTHROUGH_TYPES, for_every, late_unlocks
from tallybook.operators.ledger import CUSTOMER_LIABILITY, bonus_release

# --- fixed values -----------------------------------------------------------------------------
CASH, RELEASED, BONUS = "cash", "released", "bonus"
# ----------------------------------------------------------------------------------------------

#: Days before a state's moment that are read again with the next period.
GRACE = timedelta(days=7)


@dataclass(frozen=True)
class Carried:
    """Net cents of every flow and player, of all postings before ``upto`` (local midnight).

    ``nets`` has (flow, patron_id, day, cents): one row without a day for all days before ``open_from``, one
    for each later day.
    """

    nets: DataFrame
    upto: datetime
    open_from: datetime
    tz: str = TORONTO

    def balance(self, flow: str, at: datetime | None = None) -> DataFrame:
        """(patron_id, cents) of a flow at a local midnight, the state's own moment unless given."""
        if at is not None and not self.open_from <= at <= self.upto:
            raise ValueError(f"the state knows balances from {self.open_from} to {self.upto}")
        rows = self.nets.where(F.col("flow") == flow)
        if at is not None:
            rows = rows.where(F.col("day").isNull() | (F.col("day") < moment(at)))
        return rows.groupBy("patron_id").agg(F.sum("cents").alias("cents"))

    def since(self, moves: DataFrame, flow: str) -> DataFrame:
        """(patron_id, cents) of a flow with everything posted later, however late: a balance without an end."""
        later = moves.where(F.col("flow") == flow).where(~ReportWindow(self.upto, self.upto, self.tz).started_utc("posted_at"))
        both = self.balance(flow).unionByName(later.select("patron_id", "cents"))
        return both.groupBy("patron_id").agg(F.sum("cents").alias("cents"))


def ledger_moves(ledger: DataFrame, *, state: str | None = None) -> DataFrame:
    """(flow, patron_id, posted_at, cents) of what cash and released bonuses add up from, in one pass.

    Cash is taken of one gaming state, releases of all.
    """
    cash = F.col("a_type") == CUSTOMER_LIABILITY
    if state is not None:
        cash &= F.col("gaming_state") == state
    tags = F.array(F.when(cash, F.lit(CASH)), F.when(bonus_release(), F.lit(RELEASED)))
    return ledger.where(cash | bonus_release()).select(
        F.explode(F.array_compact(tags)).alias("flow"),
        F.col("a_patron_id").alias("patron_id"),
        F.col("t_changed_at").alias("posted_at"),
        (F.col("credit_cents") - F.col("debit_cents")).alias("cents"),
    )


def bonus_moves(transactions: DataFrame) -> DataFrame:
    """The same of bonus transactions that count towards the balance."""
    return transactions.where(~F.col("transaction_type").isin(*PLAYTHROUGH_TYPES)).select(
        F.lit(BONUS).alias("flow"),
        F.col("user_id").alias("patron_id"),
        F.col("transaction_timestamp_utc").alias("posted_at"),
        F.col("transaction_amount").cast("bigint").alias("cents"),
    )


def carry(
    moves: DataFrame,
    upto: datetime,
    *,
    before: Carried | None = None,
    late: DataFrame | None = None,
    grace: timedelta = GRACE,
    tz: str = TORONTO,
) -> Carried:
    """The state at a local midnight: that of an earlier one and the moves since, or all moves before it.

    With ``before`` only moves from its open days on are read, so a table laid out by day is read by day.
    ``late`` are moves of closed days that arrived after ``before`` was made; they are given once. The sums
    are combined per task before the shuffle by player, so a player with very many postings is a row a task
    and day.
    """
    if before is not None and (before.upto > upto or before.tz != tz):
        raise ValueError("a state is carried forward, in its own zone")
    open_from = upto - grace if before is None else max(upto - grace, before.open_from)
    floor = datetime.min if before is None else before.open_from
    if before is None:
        fresh = moves.where(ReportWindow(upto, upto, tz).started_utc("posted_at"))
    else:
        fresh = in_window(moves, "posted_at", ReportWindow(floor, upto, tz))
    day = bucket(to_local("posted_at", tz), "day")
    parts = fresh.select("flow", "patron_id", F.when(day >= moment(open_from), day).alias("day"), "cents")
    if before is not None:
        held = before.nets.where(F.col("day").isNull() | (F.col("day") < moment(floor)))
        parts = parts.unionByName(held.select("flow", "patron_id", F.lit(None).cast("timestamp_ntz").alias("day"), "cents"))
    if late is not None:
        closed = late.where(ReportWindow(floor, floor, tz).started_utc("posted_at"))
        parts = parts.unionByName(closed.select("flow", "patron_id", F.lit(None).cast("timestamp_ntz").alias("day"), "cents"))
    nets = parts.groupBy("flow", "patron_id", "day").agg(F.sum("cents").cast("bigint").alias("cents"))
    return Carried(compute_once(nets), upto, open_from, tz)


def save(carried: Carried, folder: str) -> None:
    """Keep a state under its moment; states of other moments stay."""
    rows = carried.nets.select("*", moment(carried.open_from).alias("open_from"), F.lit(carried.tz).alias("tz"))
    rows.write.mode("overwrite").parquet(f"{folder}/upto={carried.upto:%Y-%m-%d}")


def load(spark: SparkSession, folder: str, upto: datetime) -> Carried | None:
    """The newest state at or before a moment, or None where there is none yet."""
    schema = "flow string, patron_id string, day timestamp_ntz, cents bigint, open_from timestamp_ntz, tz string, upto date"
    try:
        kept = spark.read.schema(schema).parquet(folder)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
    newest = kept.where(F.col("upto") <= F.lit(upto.date())).agg(F.max(F.struct("upto", "open_from", "tz")).alias("x")).first().x
    if newest is None:
        return None
    nets = kept.where(F.col("upto") == F.lit(newest.upto)).drop("open_from", "tz", "upto")
    return Carried(nets, datetime.combine(newest.upto, datetime.min.time()), newest.open_from, newest.tz)


def carried_cash(carried: Carried, moves: DataFrame, users_at_start: DataFrame, users_at_end: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Opening balance at the state's moment and closing balance without an end, for every user."""
    return for_every(users_at_start, carried.balance(CASH)), for_every(users_at_end, carried.since(moves, CASH))


def _gone(carried: Carried, users: DataFrame, at: datetime) -> DataFrame:
    known = users.select("patron_id").distinct()
    rows = carried.balance(RELEASED, at).join(known, "patron_id", "left_semi")
    return rows.select("patron_id", (-F.col("cents")).alias("cents"))


def carried_opening_bonus(
    carried: Carried, users_at_start: DataFrame, programs: DataFrame, unlocks: DataFrame, window: ReportWindow
) -> DataFrame:
    """Bonus balance at the start, one row per player and part (B33), from a state that knows that moment."""
    users = users_at_start.select("patron_id").distinct()
    late = late_unlocks(programs, unlocks, window).withColumnRenamed("user_id", "patron_id")
    late = late.join(users, "patron_id", "left_semi").groupBy("patron_id").agg(F.sum("cents").alias("cents"))
    booked = for_every(users, carried.balance(BONUS, window.start))
    return booked.unionByName(_gone(carried, users, window.start)).unionByName(late)


def carried_closing_bonus(carried: Carried, users_at_end: DataFrame, window: ReportWindow) -> DataFrame:
    """Bonus balance at the end, one row per player and part (B34), from a state that knows that moment."""
    users = users_at_end.select("patron_id").distinct()
    return for_every(users, carried.balance(BONUS, window.end)).unionByName(_gone(carried, users, window.end))
