"""Money: integer cents inside, decimals at the edge."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

DOLLARS = "decimal(38,2)"
# nine decimals for jackpot amounts; 30 digits leaves room to add without losing scale
EXACT = "decimal(30,9)"


ONE_CENT = Decimal("0.01")


def _c(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def dollars(cents: Column | str) -> Column:
    """Cents to dollars, exact; multiplying is several times cheaper than dividing."""
    return (_c(cents).cast("decimal(20,0)") * F.lit(ONE_CENT)).cast(DOLLARS)


def exact_dollars(cents: Column | str) -> Column:
    """Cents to dollars on the nine-decimal scale, to be mixed with jackpot amounts."""
    return dollars(cents).cast("decimal(28,2)").cast(EXACT)


def units_and_nanos(units: Column | str, nanos: Column | str) -> Column:
    """units + nanos / 10^9 as an exact decimal."""
    whole = _c(units).cast("decimal(19,0)")
    fraction = _c(nanos).cast("decimal(18,0)") * F.lit(Decimal("0.000000001"))
    return (whole + fraction).cast("decimal(28,9)")


def exact_sum(col: Column | str) -> Column:
    return F.sum(_c(col)).cast(EXACT)


def total(cents: Column | str) -> Column:
    """Sum of cents with NULL read as 0."""
    return F.coalesce(F.sum(_c(cents)), F.lit(0).cast("bigint"))
