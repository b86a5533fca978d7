"""The registered queries, each with the SQL that must give the same rows."""

from ledgerline.catalog.registry import ORACLE, QUERIES

from ledgerline.catalog import cost, events, operators, serving, stored  # noqa: F401  (they register)

__all__ = ["ORACLE", "QUERIES"]
