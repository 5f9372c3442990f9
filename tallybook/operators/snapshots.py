"""As-of snapshots from append-only version history."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import datetime, timedelta

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallybook.functions.periods import moment
from tallybook.lineage import compute_once


def _newest(df: DataFrame, keys: Sequence[str], clocks: Sequence[str]) -> DataFrame:
    """The rows of every key with the greatest clocks, ties included, later clocks missing or not."""
    newest_first = Window.partitionBy(*keys).orderBy(*[F.col(c).desc_nulls_last() for c in clocks])
    ranked = df.withColumn("_version_rank", F.rank().over(newest_first))
    return ranked.where(F.col("_version_rank") == 1).drop("_version_rank")


def _bounded(df: DataFrame, keys: Sequence[str], first: str, bound: datetime | None, since: datetime | None = None) -> DataFrame:
    present = F.col(first).isNotNull()
    for key in keys:
        present &= F.col(key).isNotNull()
    df = df.where(present)
    df = df if bound is None else df.where(F.col(first) < moment(bound))
    return df if since is None else df.where(F.col(first) >= moment(since))


def _complete(df: DataFrame, clocks: Sequence[str]) -> DataFrame:
    for clock in clocks[1:]:
        df = df.where(F.col(clock).isNotNull())
    return df


def latest_asof(
    df: DataFrame,
    keys: Sequence[str],
    clocks: Sequence[str] = ("_changed_at", "updated_at"),
    cutoff: datetime | None = None,
    grace: timedelta = timedelta(0),
) -> DataFrame:
    """Newest version of every key before ``cutoff + grace``.

    Newest means the greatest first clock, then the greatest of the following ones. Exact ties
    all survive. A key whose newest rows lack a later clock is dropped, not rolled back to an
    older version. One scan and one shuffle: the rank limit runs before the exchange, so a key
    with very many versions ships only its newest row per task.
    """
    bound = None if cutoff is None else cutoff + grace
    return _complete(_newest(_bounded(df, keys, clocks[0], bound), keys, clocks), clocks)


@dataclass(frozen=True)
class Snapshot:
    """A kept snapshot: the newest rows of every key before ``bound``, also those that lack a later clock.

    The latter hide their key, and must go on hiding it until a newer version comes.
    """

    rows: DataFrame
    keys: tuple[str, ...]
    clocks: tuple[str, ...]
    bound: datetime

    def visible(self) -> DataFrame:
        """What ``latest_asof`` gives for the same cutoff."""
        return _complete(self.rows, self.clocks)


def take_snapshot(
    df: DataFrame,
    keys: Sequence[str],
    clocks: Sequence[str] = ("_changed_at", "updated_at"),
    *,
    cutoff: datetime,
    grace: timedelta = timedelta(0),
) -> Snapshot:
    """A snapshot from the whole history, stored to be carried on."""
    bound = cutoff + grace
    return Snapshot(compute_once(_newest(_bounded(df, keys, clocks[0], bound), keys, clocks)), tuple(keys), tuple(clocks), bound)


def advance_snapshot(
    snapshot: Snapshot, df: DataFrame, *, cutoff: datetime, grace: timedelta = timedelta(0), late: DataFrame | None = None
) -> Snapshot:
    """The snapshot of a later cutoff from an earlier one and the versions after it.

    Only versions from the earlier bound on are read. Keys without one are taken over as they are; the others
    are ranked anew, old rows against new, so ties survive and a missing clock hides its key as in the full
    ranking. ``late`` are versions from before the earlier bound that arrived after it was made.
    """
    bound, keys, clocks = cutoff + grace, snapshot.keys, snapshot.clocks
    if bound < snapshot.bound:
        raise ValueError("a snapshot is carried forward")
    delta = _bounded(df, keys, clocks[0], bound, snapshot.bound)
    if late is not None:
        delta = delta.unionByName(_bounded(late, keys, clocks[0], snapshot.bound))
    # of the versions between, one set of newest rows a key can matter
    delta = compute_once(_newest(delta, keys, clocks))
    touched = delta.select(*keys).distinct()
    same = snapshot.rows.join(touched, list(keys), "left_anti")
    contested = snapshot.rows.join(touched, list(keys), "left_semi").unionByName(delta)
    rows = same.unionByName(_newest(contested, keys, clocks).select(*same.columns))
    return Snapshot(compute_once(rows), keys, clocks, bound)


def latest_attrs(df: DataFrame, key: str, order: str, attrs: Sequence[str]) -> DataFrame:
    """One row per key with the attributes of its newest row.

    A row without an order value counts as the newest, as a descending sort with NULLs first
    has it; equal order values are settled by the greater attributes. Aggregated map-side, so
    no key is ever gathered whole.
    """
    newest = F.max(F.struct(F.col(order).isNull().alias("_open"), F.col(order), *attrs))
    picked = df.groupBy(key).agg(newest.alias("_newest"))
    return picked.select(key, *[F.col(f"_newest.{a}").alias(a) for a in attrs])


def latest_settlement(used: DataFrame, keys: Sequence[str], settled: str) -> DataFrame:
    """Rows of a derived report that carry the latest settlement time of their key."""
    return latest_asof(used, keys, clocks=[settled])
