"""Registered queries and, next to each, the SQL that states its result."""

from __future__ import annotations

from novalake.queries import lake, landing, operators, silver_tables

GROUPS = (silver_tables, operators, landing, lake)


def all_queries():
    return {name: fn for group in GROUPS for name, fn in group.QUERIES.items()}


def all_oracles():
    return {name: sql for group in GROUPS for name, sql in group.ORACLE.items()}
