"""A kept index of bets that were posted as free bets.

Reports leave out or pick the postings of such bets, whenever the free bet was posted. The index holds what
the ledger has said so far, so a report reads the ledger from the index's moment on only.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime, timedelta

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallybook.functions.periods import ReportWindow, in_window, moment
from tallybook.lineage import compute_once
from tallybook.operators.ledger import FREE_BET_TYPE, bet_id

#: Time before an index's moment that is read again with the next refresh, for postings that arrive late.
GRACE = timedelta(days=7)
_KEYS = ("bet_id", "patron_id", "gaming_state")
#: A moment after every posting.
_EVER = datetime(9999, 1, 1)


def _posted(ledger: DataFrame, since: datetime | None, upto: datetime | None) -> DataFrame:
    """Distinct (bet_id, patron_id, gaming_state) of free-bet postings of a time, in UTC."""
    rows = ledger.where(F.col("p_type") == FREE_BET_TYPE)
    if since is not None:
        rows = in_window(rows, "t_changed_at", ReportWindow(since, upto or _EVER, "UTC"))
    elif upto is not None:
        rows = rows.where(F.col("t_changed_at") < moment(upto))
    return rows.select(bet_id().alias("bet_id"), F.col("a_patron_id").alias("patron_id"), "gaming_state").distinct()


@dataclass(frozen=True)
class FreeBetIndex:
    """Free bets by player and gaming state, of all postings before ``upto`` (UTC)."""

    ids: DataFrame
    upto: datetime
    grace: timedelta = GRACE

    def bets(self, ledger: DataFrame | None = None, *, state: str | None = None, players: DataFrame | None = None) -> DataFrame:
        """Distinct bet_id, of one state and of some players if wanted.

        With ``ledger`` the postings since the index was made are in as well, so the set is that of the whole
        ledger; read are only the free-bet postings after the index's moment, less the grace.
        """
        rows = self.ids
        if ledger is not None:
            rows = rows.unionByName(_posted(ledger, self.upto - self.grace, None))
        if state is not None:
            rows = rows.where(F.col("gaming_state") == state)
        if players is not None:
            rows = rows.join(players.select("patron_id"), "patron_id", "left_semi")
        return rows.select("bet_id").distinct()

    def among(self, rows: DataFrame, key: str, **of) -> DataFrame:
        """The free bets among the bets of some rows, typically those of a report's window.

        As a semi join of the kept ids with the rows' bets: where the rows are few, the planner filters the
        ids by a Bloom filter of them at the scan, and what comes back is no larger than the rows.
        """
        asked = rows.select(F.col(key).alias("bet_id")).distinct()
        return self.bets(**of).join(asked, "bet_id", "left_semi")


def refresh(ledger: DataFrame, upto: datetime, before: FreeBetIndex | None = None, *, grace: timedelta = GRACE) -> tuple[FreeBetIndex, DataFrame]:
    """The index up to a moment (UTC) and the rows it has that ``before`` lacks.

    With ``before`` only postings from its moment on, less its grace, are read.
    """
    if before is None:
        new = compute_once(_posted(ledger, None, upto))
        return FreeBetIndex(new, upto, grace), new
    if upto < before.upto:
        raise ValueError("an index is carried forward")
    found = _posted(ledger, before.upto - before.grace, upto)
    same = F.lit(True)
    held = before.ids.select(*[F.col(k).alias(f"_{k}") for k in _KEYS])
    for k in _KEYS:
        same &= F.col(k).eqNullSafe(F.col(f"_{k}"))
    new = compute_once(found.join(held, same, "left_anti"))
    return FreeBetIndex(before.ids.unionByName(new), upto, grace), new


def save(index: FreeBetIndex, new: DataFrame, folder: str) -> None:
    """Keep what a refresh has added, under its moment; earlier additions stay as they are."""
    new.withColumn("grace_days", F.lit(index.grace.days)).write.mode("overwrite").parquet(f"{folder}/upto={index.upto:%Y-%m-%d %H}")


def load(spark: SparkSession, folder: str) -> FreeBetIndex | None:
    """The index from all additions kept, or None where there is none yet."""
    schema = "bet_id string, patron_id string, gaming_state string, grace_days int, upto string"
    try:
        kept = spark.read.schema(schema).parquet(folder)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
    newest = kept.agg(F.max(F.struct("upto", "grace_days")).alias("x")).first().x
    if newest is None:
        return None
    return FreeBetIndex(kept.select(*_KEYS), datetime.strptime(newest.upto, "%Y-%m-%d %H"), timedelta(days=newest.grace_days))
