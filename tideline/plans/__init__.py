"""Registered queries over the given tables, with the SQL that should give the same rows."""

from __future__ import annotations

from tideline.plans import aggregates, envelopes, loads, metrics, scans, states, streams

_GROUPS = (scans, envelopes, states, aggregates, metrics, loads, streams)


def all_queries() -> dict:
    return {name: query for group in _GROUPS for name, query in group.QUERIES.items()}


def all_oracles() -> dict[str, str]:
    return {name: sql for group in _GROUPS for name, sql in group.ORACLE.items()}
