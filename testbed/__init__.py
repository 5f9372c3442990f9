"""Queries over the shared test tables: ledger-shaped views of them, and SQL to check against."""
