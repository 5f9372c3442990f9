"""Derived labels."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values -----------------------------------------------------------------------------
NON_EARNING = ("retired", "homemaker", "student", "unemployed")
GENDER_CODES = {"male": "M", "female": "F"}
OTHER_GENDER = "X"
GAME_SEGMENTS = {"live": "Live Dealer", "roulette": "Table"}
PROVIDER_SEGMENTS = {"live": "Live Dealer", "roulette": "Table", "S": "Slots", "V": "VideoPoker"}
# ----------------------------------------------------------------------------------------------


def _lookup(col: Column, table: dict[str, str], otherwise: Column) -> Column:
    chain = None
    for key, label in table.items():
        chain = F.when(col == key, label) if chain is None else chain.when(col == key, label)
    return chain.otherwise(otherwise)


def capitalised(col: Column) -> Column:
    """First letter upper, the rest lower, without looking at word breaks."""
    return F.concat(F.upper(F.substring(col, 1, 1)), F.lower(col.substr(F.lit(2), F.length(col))))


def game_segment(category: Column | str) -> Column:
    c = F.col(category) if isinstance(category, str) else category
    return _lookup(c, GAME_SEGMENTS, capitalised(c))


def provider_segment(category: Column | str) -> Column:
    c = F.col(category) if isinstance(category, str) else category
    return _lookup(c, PROVIDER_SEGMENTS, capitalised(c))


def account_designation(is_tester: Column | str) -> Column:
    c = F.col(is_tester) if isinstance(is_tester, str) else is_tester
    return F.when(c, "Test").otherwise("Real")


def gender_code(gender: Column | str) -> Column:
    c = F.col(gender) if isinstance(gender, str) else gender
    return _lookup(c, GENDER_CODES, F.lit(OTHER_GENDER))


def age_years(birthdate: Column | str, as_of: Column) -> Column:
    """Whole days divided by 365, remainder dropped."""
    c = F.col(birthdate) if isinstance(birthdate, str) else birthdate
    return F.call_function("div", F.datediff(as_of, c), F.lit(365))


def postal_prefix(code: Column | str) -> Column:
    return F.substring(code, 1, 3)


def is_non_earning(status: Column | str) -> Column:
    c = F.col(status) if isinstance(status, str) else status
    return F.coalesce(c.isin(*NON_EARNING), F.lit(False))


def bet_type_a(num_legs: Column | str) -> Column:
    c = F.col(num_legs) if isinstance(num_legs, str) else num_legs
    return F.when(c == 1, "Fixed Odds Single").when(c > 1, "Fixed Odds Combo")


def bet_type_b(num_live_legs: Column | str, num_legs: Column | str) -> Column:
    live = F.col(num_live_legs) if isinstance(num_live_legs, str) else num_live_legs
    legs = F.col(num_legs) if isinstance(num_legs, str) else num_legs
    return F.when(live == 0, "Pre Event").when(live == legs, "Live Action").otherwise("Both")


def event_text(
    event_description: Column, bet_type: Column, market_type: Column, *, any_case: bool = True
) -> Column:
    """Event description, or the market where it is missing on anything but a parlay.

    One report spells the parlay names in capitals no bet type has, so there a parlay takes its
    market too; ``any_case=False`` is that reading.
    """
    missing = (event_description == "") | event_description.isNull()
    if any_case:
        single = ~F.lower(bet_type).isin("parlay", "parlay_plus")
    else:
        single = ~bet_type.isin("Parlay", "Parlay_plus")
    return F.when(missing & single, market_type).otherwise(event_description)
