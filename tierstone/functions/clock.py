"""Reference time of the time-dependent plans.

`as_of=None` means the moment the query starts. With a given time, plans also
leave out what happened after it, so that a rerun for a past moment gives what a
run at that moment would have given.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F


def now(as_of: datetime | None = None) -> Column:
    return F.current_timestamp() if as_of is None else F.lit(as_of.isoformat(" ")).cast("timestamp")


def today(as_of: datetime | None = None) -> Column:
    return F.to_date(now(as_of))


def hours_before(hours: int, as_of: datetime | None = None) -> Column:
    return now(as_of) - F.expr(f"INTERVAL {int(hours)} HOURS")


def not_after(moment: Column, as_of: datetime | None = None, by_day: bool = False) -> Column:
    """Whether a time, or with `by_day` a date, is not later than `as_of`, if that is given."""
    if as_of is None:
        return F.lit(True)
    return moment <= (today(as_of) if by_day else now(as_of))
