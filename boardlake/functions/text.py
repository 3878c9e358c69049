"""Member-name match predicates."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MATCHES = ("contains", "like")


def member_match(col: Column | str, value: str, match: str = "contains") -> Column:
    """Case-sensitive substring test on the joined member names.

    ``contains`` matches the value literally, anywhere (also across two
    names).  ``like`` wraps it in ``%...%``: ``_`` and ``%`` inside the value
    act as wildcards.
    """
    c = F.col(col) if isinstance(col, str) else col
    if match == "contains":
        return c.contains(F.lit(value))
    if match == "like":
        return c.like(f"%{value}%")
    raise ValueError(f"match must be one of {MATCHES}, got {match!r}")
