import os
import sys
from datetime import datetime

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tallybook.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session(8, shuffle_partitions=4)
    yield session
    session.stop()


def at(text: str) -> datetime:
    return datetime.fromisoformat(text)


LEDGER_DEFAULTS = {
    "ledger_transaction_id": "L1",
    "patron_transaction_id": "T1",
    "p_id": "T1",
    "parent_id": None,
    "a_patron_id": "p1",
    "p_patron_id": "p1",
    "bet_history_id": None,
    "p_bet_id": None,
    "p_vegas_bet_id": None,
    "a_type": "customer_liability",
    "p_type": "sportsbook_bet",
    "t_type": "sportsbook_bet",
    "gaming_state": "CA-ON",
    "adjustment_reason": None,
    "adjustment_type": None,
    "debit_cents": 0,
    "credit_cents": 0,
    "t_changed_at": datetime(2023, 1, 10, 12),
}


def table(spark, name: str, rows: list[dict], **defaults):
    """A frame with the declared schema of a table; columns a row leaves out take the defaults."""
    from tallybook.sources.schemas import SCHEMAS

    schema = SCHEMAS[name]
    base = {field.name: None for field in schema}
    if name == "accounting":
        base |= LEDGER_DEFAULTS
    base |= defaults
    data = []
    for row in rows:
        full = base | row
        assert set(full) == set(base), set(full) ^ set(base)
        data.append(tuple(full[field.name] for field in schema))
    return spark.createDataFrame(data, schema)


def ledger(spark, *rows: dict):
    return table(spark, "accounting", list(rows))


def collected(df, *columns):
    """Rows as a sorted list of tuples."""
    chosen = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in chosen.collect()), key=str)
