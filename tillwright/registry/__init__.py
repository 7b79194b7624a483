"""All registered queries: name, Spark callable, oracle SQL."""

from __future__ import annotations

from tillwright.registry import alerts, checks, lake, reports, slots, tables, versions
from tillwright.registry.entry import Query


def all_queries() -> dict[str, Query]:
    found: dict[str, Query] = {}
    for module in (reports, slots, checks, lake, tables, versions, alerts):
        for query in module.QUERIES:
            if query.name in found:
                raise ValueError(f"query {query.name} is registered twice")
            found[query.name] = query
    return found
