"""Predicates on the slot columns. They reach the scan as partition filters."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F


def _is_one_of(left: str, values: Iterable[str | None]) -> Column:
    """``left IN (...)`` as one expression: a backfill may list 60,000 slots, and
    ``Column.isin`` would make one JVM call for each. Null never matches."""
    known = sorted({str(v) for v in values if v is not None})
    if not known:
        return F.lit(False)
    quoted = ", ".join("'" + v.replace("\\", "\\\\").replace("'", "\\'") + "'" for v in known)
    return F.expr(f"{left} IN ({quoted})")


def in_dates(dates: Iterable[str | None]) -> Column:
    return _is_one_of("CAST(date AS STRING)", dates)


def in_lists(dates: Iterable[str | None], hours: Iterable[str | None]) -> Column:
    """Every listed date with every listed hour: the cross product of both lists."""
    return in_dates(dates) & _is_one_of("hour", hours)


def in_slots(slots: Iterable[tuple[str, str]]) -> Column:
    """Exactly the given ``(date, hour)`` pairs.

    The dates are named once more on their own: a metastore understands that
    part and hands out the partitions of those dates alone.
    """
    pairs = list(slots)
    exact = _is_one_of("concat(CAST(date AS STRING), '/', hour)", (f"{d}/{h}" for d, h in pairs))
    return in_dates(d for d, _ in pairs) & exact
