"""Double-entry ledger operators (B06-B10, B15-B18, B28-B32, B50 build on these).

Money stays in integer cents; times come out in local wall-clock time.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallybook.functions.periods import ReportWindow, in_window, to_local

# --- fixed values: accounts, posting types, codes ---------------------------------------------
CUSTOMER_LIABILITY = "customer_liability"
UNSETTLED_BETS = "sportsbook_unsettled_bets"
SPORTS_HOUSE_WINS = "sportsbook_house_wins"
CASINO_HOUSE_WINS = "casino_house_wins"
CLEARING_WITHDRAWALS = "clearing_withdrawals"
SPORTS_PAYOUT_TYPES = ("sportsbook_cash_out_bet", "sportsbook_payout", "sportsbook_bet_lost")
AMENDMENT_TYPES = ("amendment", "amendment_rg")
CANCELLED_WITHDRAWAL_TYPES = ("withdrawal_cancellation", "withdrawal_decline")
BONUS_RELEASE_TYPES = ("bonus_offer_payout", "bonus_offer_revoked", "cash_deposit")
FREE_BET_TYPE = "sportsbook_free_bet"
WIRE_REASON = "9998"
AML_WIRE_REASONS = ("9998", "9990")
WIRE_DEPOSIT = '"cash_deposit"'
WIRE_WITHDRAWAL = '"cash_withdrawal"'
ONTARIO = "CA-ON"
# ----------------------------------------------------------------------------------------------


def bet_id() -> Column:
    return F.coalesce(F.col("p_vegas_bet_id"), F.col("p_bet_id"))


def in_state(ledger: DataFrame, state: str | None) -> DataFrame:
    return ledger if state is None else ledger.where(F.col("gaming_state") == state)


def real_players(users: DataFrame) -> DataFrame:
    """Ids of accounts known not to be testers; an unknown flag is not enough."""
    return users.where(F.col("is_tester") == F.lit(False)).select("patron_id").distinct()


def only(df: DataFrame, ids: DataFrame, key: str, id_col: str) -> DataFrame:
    """Rows whose key is in the id set."""
    return df.join(ids, df[key] == ids[id_col], "left_semi")


def exclude(df: DataFrame, ids: DataFrame, key: str, id_col: str) -> DataFrame:
    """Rows whose key is not in the id set; a row without a key stays.

    Rows without a key get one from all their columns that matches nothing, so they spread over the tasks.
    """
    own = F.concat(F.lit("\x00"), F.xxhash64(*df.columns).cast("string"))
    keyed = df.withColumn("_excluded", F.coalesce(F.col(key), own))
    out = ids.select(F.col(id_col).alias("_excluded_id"))
    return keyed.join(out, F.col("_excluded") == F.col("_excluded_id"), "left_anti").drop("_excluded")


def spread_key(key: Column, *fallback: str) -> Column:
    """A join key for outer joins: rows without one get a key of their own that matches nothing.

    Left to themselves they would all hash to the same task.
    """
    return F.coalesce(key, F.concat(F.lit("\x00"), *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in fallback]))


def flag_promo(ledger: DataFrame, ids: DataFrame) -> DataFrame:
    """Add ``is_promo``: the posting's bet is in the id set.

    One join serves both the exclusion and the inclusion. Postings without a bet get a key of
    their own, so they spread over the tasks instead of meeting on NULL.
    """
    known = ids.select(F.col("bet_id").alias("_promo_bet")).distinct()
    keyed = ledger.withColumn("_bet_key", spread_key(bet_id(), "ledger_transaction_id"))
    joined = keyed.join(known, F.col("_bet_key") == F.col("_promo_bet"), "left")
    return joined.withColumn("is_promo", F.col("_promo_bet").isNotNull()).drop("_bet_key", "_promo_bet")


def free_bet_ids(ledger: DataFrame, p_type: str = FREE_BET_TYPE) -> DataFrame:
    """Bets that were posted as free bets (B10, ledger form)."""
    return ledger.where(F.col("p_type") == p_type).select(bet_id().alias("bet_id")).distinct()


def free_bet_ids_posted(
    bets: DataFrame, ledger: DataFrame, window: ReportWindow, state: str | None = None
) -> DataFrame:
    """Free bets with a posting in the window (B10, bet form)."""
    free = bets.where(F.col("free_bet_id").isNotNull()).select(F.col("id").alias("bet_id"))
    posted = in_state(in_window(ledger, "t_changed_at", window), state).select(bet_id().alias("_posted"))
    return free.join(posted, F.col("bet_id") == F.col("_posted"), "left_semi").distinct()


@dataclass(frozen=True)
class LegPair:
    """Which postings are the debit and the credit leg of one kind of transfer."""

    types: Sequence[str]
    debit_account: str
    credit_accounts: Sequence[str]
    type_column: str = "p_type"
    ref: str | None = "bet"
    also: Sequence[str] = ()  # further columns that tell two legs apart

    def ref_column(self) -> Column:
        if self.ref is None:
            return F.lit(None).cast("string")
        return bet_id() if self.ref == "bet" else F.col(self.ref)

    def is_leg(self, side: str) -> Column:
        accounts = [self.debit_account] if side == "debit" else list(self.credit_accounts)
        return F.col(self.type_column).isin(*self.types) & F.col("a_type").isin(*accounts)


SPORTS_BETS = LegPair(("sportsbook_bet",), CUSTOMER_LIABILITY, (UNSETTLED_BETS,))
SPORTS_AND_CASINO_BETS = LegPair(
    ("sportsbook_bet", "casino_wager"), CUSTOMER_LIABILITY, (UNSETTLED_BETS, CASINO_HOUSE_WINS)
)
SPORTS_BETS_BY_TX_TYPE = LegPair(
    ("sportsbook_bet",), CUSTOMER_LIABILITY, (UNSETTLED_BETS,), type_column="t_type", ref=None
)
CASINO_WAGERS = LegPair(("casino_wager",), CUSTOMER_LIABILITY, (CASINO_HOUSE_WINS,), ref="p_id")
CASINO_ROLLBACKS = LegPair(
    ("casino_rollback",), CASINO_HOUSE_WINS, (CUSTOMER_LIABILITY,), ref="patron_transaction_id", also=("p_id",)
)
CASINO_ROLLBACKS_BY_ID = LegPair(("casino_rollback",), CASINO_HOUSE_WINS, (CUSTOMER_LIABILITY,), ref="p_id")
WITHDRAWALS = LegPair(
    ("withdrawal",), CUSTOMER_LIABILITY, (CLEARING_WITHDRAWALS,), type_column="t_type", ref="patron_transaction_id"
)
CANCELLED_WITHDRAWALS = LegPair(
    CANCELLED_WITHDRAWAL_TYPES, CLEARING_WITHDRAWALS, (CUSTOMER_LIABILITY,), ref="patron_transaction_id"
)


def ledger_legs(ledger: DataFrame, pair: LegPair, side: str, extra: Sequence[str] = ()) -> DataFrame:
    """Distinct postings of one side of a pair with a positive amount."""
    chosen = ledger.where(pair.is_leg(side) & (F.col(f"{side}_cents") > 0))
    return chosen.select(
        "ledger_transaction_id",
        F.col("a_patron_id").alias("patron_id"),
        F.col("a_type").alias("account"),
        F.col(f"{side}_cents").alias("cents"),
        F.col("t_changed_at").alias("posted_at"),
        pair.ref_column().alias("ref_id"),
        *pair.also,
        *extra,
    ).distinct()


def match_legs(debits: DataFrame, credits: DataFrame, by: Sequence[str | Column]) -> DataFrame:
    """Debit legs matched to credit legs of the same transaction and amount, summed by keys.

    Equal amounts inside one transaction match many-to-many. The pairs are never spelled out:
    every debit is weighted by how many credits it meets, which gives the same sums from a join
    with at most one row per (transaction, amount) on the credit side.
    """
    keys = ["ledger_transaction_id", "cents"]
    partners = credits.groupBy(*keys).agg(F.count(F.lit(1)).alias("_partners"))
    matched = debits.join(partners, keys, "inner")
    return matched.groupBy(*by).agg(F.sum(F.col("cents") * F.col("_partners")).alias("cents"))


def paired_legs(
    ledger: DataFrame, pairs: Mapping[str, LegPair], extra: Sequence[str] = (), credits: DataFrame | None = None
) -> DataFrame:
    """Distinct legs of both sides of every pair with a positive amount, side by side with their partners.

    One pass over the ledger and one exchange by ledger transaction serve the distinct here and the matching
    later, whatever the number of pairs. ``credits`` is given where the credit legs come from another frame
    than the debit legs. A leg without a transaction matches nothing and is left out, so it can't gather in one
    task. Returns (flow, is_debit, ref_id, ledger_transaction_id, patron_id, account, cents, posted_at, the
    ``also`` columns of the pairs, *extra).
    """
    also = list(dict.fromkeys(c for pair in pairs.values() for c in pair.also))

    def of(rows: DataFrame, sides: Sequence[str]) -> DataFrame:
        hits, anything = [], F.lit(False)
        for flow, pair in pairs.items():
            told_apart = [(F.col(c) if c in pair.also else F.lit(None).cast("string")).alias(c) for c in also]
            for side in sides:
                holds = pair.is_leg(side) & (F.col(f"{side}_cents") > 0)
                anything |= holds
                hit = F.struct(
                    F.lit(flow).alias("flow"),
                    F.lit(side == "debit").alias("is_debit"),
                    pair.ref_column().alias("ref_id"),
                    F.col(f"{side}_cents").alias("cents"),
                    *told_apart,
                )
                hits.append(F.when(holds, hit))
        own = ("ledger_transaction_id", "a_patron_id", "a_type", "t_changed_at", *extra)
        rows = rows.where(anything & F.col("ledger_transaction_id").isNotNull())
        return rows.select(F.explode(F.array_compact(F.array(*hits))).alias("_hit"), *own).select(
            "_hit.*",
            "ledger_transaction_id",
            F.col("a_patron_id").alias("patron_id"),
            F.col("a_type").alias("account"),
            F.col("t_changed_at").alias("posted_at"),
            *extra,
        )

    legs = of(ledger, ("debit", "credit")) if credits is None else of(ledger, ("debit",)).union(of(credits, ("credit",)))
    return legs.repartition("ledger_transaction_id").distinct()


def match_pairs(legs: DataFrame, by: Sequence[str | Column], summed: bool = True) -> DataFrame:
    """Paired legs matched within transaction and amount, the debits summed by keys.

    Equal amounts match many-to-many; every debit is weighted by the credits it meets. The legs are already
    together, so nothing is exchanged before the sums; with ``summed`` off nothing is at all, and every matched
    debit is a row.
    """
    together = Window.partitionBy("flow", "ledger_transaction_id", "cents")
    met = legs.withColumn("_partners", F.sum(F.when(F.col("is_debit"), 0).otherwise(1)).over(together))
    matched = met.where(F.col("is_debit") & (F.col("_partners") > 0))
    amount = F.col("cents") * F.col("_partners")
    return matched.groupBy(*by).agg(F.sum(amount).alias("cents")) if summed else matched.select(*by, amount.alias("cents"))


def matched(
    ledger: DataFrame,
    pair: LegPair,
    by: Sequence[str | Column],
    extra: Sequence[str] = (),
    credits: DataFrame | None = None,
    summed: bool = True,
) -> DataFrame:
    """Matched transfers of one kind, summed by keys (B06 and B07 in one pass)."""
    return match_pairs(paired_legs(ledger, {"": pair}, extra, credits), by, summed)


def matched_transfers(
    ledger: DataFrame, pairs: Mapping[str, LegPair], tz: str, keep: Sequence[str] = ()
) -> DataFrame:
    """Several kinds of matched transfers from one pass over the ledger.

    ``ledger`` is already cut to the wanted window and players; ``keep`` names ``also`` columns
    to report. Returns (flow, ts, patron_id, ref_id, *keep, cents).
    """
    return match_pairs(paired_legs(ledger, pairs), ["flow", to_local("posted_at", tz).alias("ts"), "patron_id", "ref_id", *keep])


def net_movement(rows: DataFrame, by: Sequence[str | Column], *, flip: bool = False) -> DataFrame:
    """(sum of credits - sum of debits) by keys, in cents; ``flip`` reverses the sign."""
    net = F.sum("debit_cents") - F.sum("credit_cents") if flip else F.sum("credit_cents") - F.sum("debit_cents")
    return rows.groupBy(*by).agg(net.alias("cents"))


@dataclass(frozen=True)
class Flow:
    """A named net movement of the ledger: which postings, which reference id, which sign."""

    name: str
    holds: Column
    ref: Column | None = None
    flip: bool = False


def ledger_flows(ledger: DataFrame, flows: Sequence[Flow], tz: str, extra: Sequence[str] = ()) -> DataFrame:
    """Many net movements from one scan and one shuffle.

    Each posting is tagged with the flows it belongs to and all of them are summed together.
    Returns (flow, ts, patron_id, ref_id, *extra, cents).
    """
    anything = F.lit(False)
    tags = []
    for flow in flows:
        anything |= flow.holds
        ref = flow.ref if flow.ref is not None else F.lit(None).cast("string")
        sign = F.lit(-1 if flow.flip else 1)
        tags.append(
            F.when(
                flow.holds,
                F.struct(F.lit(flow.name).alias("flow"), ref.alias("ref_id"), sign.alias("sign")),
            )
        )
    tagged = ledger.where(anything).withColumn("_tag", F.explode(F.array_compact(F.array(*tags))))
    amount = F.col("_tag.sign") * (F.col("credit_cents") - F.col("debit_cents"))
    return tagged.groupBy(
        F.col("_tag.flow").alias("flow"),
        to_local("t_changed_at", tz).alias("ts"),
        F.col("a_patron_id").alias("patron_id"),
        F.col("_tag.ref_id").alias("ref_id"),
        *extra,
    ).agg(F.sum(amount).alias("cents"))


def is_any(flows: Sequence[Flow]) -> Column:
    """The posting belongs to one of the flows."""
    return reduce(Column.__or__, [flow.holds for flow in flows])


def as_moves(rows: DataFrame, *more: str | Column, tz: str) -> DataFrame:
    """Postings as (ts, patron_id, *more, cents) for a measure stack, not summed.

    Sums of a stack need none before them, so a flow that is only added up has no shuffle of its own.
    """
    net = F.coalesce("credit_cents", F.lit(0)) - F.coalesce("debit_cents", F.lit(0))
    return rows.select(
        to_local("t_changed_at", tz).alias("ts"), F.col("a_patron_id").alias("patron_id"), *more, net.alias("cents")
    )


# --- the movements the reports name -----------------------------------------------------------


def on_customer(*p_types: str) -> Column:
    return F.col("p_type").isin(*p_types) & (F.col("a_type") == CUSTOMER_LIABILITY)


def wire(kind: str, reasons: Sequence[str] = (WIRE_REASON,)) -> Column:
    return (
        on_customer(*AMENDMENT_TYPES)
        & F.col("adjustment_reason").isin(*reasons)
        & (F.col("adjustment_type") == kind)
    )


def cash_adjustment() -> Column:
    """Amendments other than wires; a missing reason counts as other."""
    reason = F.col("adjustment_reason")
    return on_customer(*AMENDMENT_TYPES) & ((reason != WIRE_REASON) | reason.isNull())


def bonus_release() -> Column:
    return on_customer(*BONUS_RELEASE_TYPES)


def deposit_flows() -> list[Flow]:
    """Deposits, wires coded as amendments and transfers in from another region."""
    return [
        Flow("deposit", on_customer("deposit")),
        Flow("wire_deposit", wire(WIRE_DEPOSIT)),
        Flow("region_in", on_customer("region_transfer_in")),
    ]


def withdrawal_flows() -> list[Flow]:
    """Wires and transfers out; ordinary withdrawals are matched legs."""
    return [
        Flow("wire_withdrawal", wire(WIRE_WITHDRAWAL), flip=True),
        Flow("region_out", on_customer("region_transfer_out"), flip=True),
    ]
