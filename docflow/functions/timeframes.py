"""Collection names that carry the time frame of a document.

A frame is closed on the right by default: an event exactly on a boundary belongs to the frame
that ends there. Only the very start of a day (or the start date of multi-day frames) opens its
own frame. Everything is integer millisecond arithmetic inside whole-stage codegen.
"""

from __future__ import annotations

import re
from datetime import date, datetime

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


UNIT_MS = {
    "MILLISECONDS": 1,
    "SECONDS": 1_000,
    "MINUTES": 60_000,
    "HOURS": 3_600_000,
    "DAYS": 86_400_000,
}


class TimeFrame:
    """Frame length, zone and naming pattern of a family of collections.

    ``start_date`` (local midnight in ``zone``) anchors frames longer than one day; shorter
    frames restart at every local midnight.
    """

    def __init__(
        self,
        base: str,
        unit: str = "HOURS",
        length: int = 1,
        pattern: str = "yyyy-MM-dd-HH",
        zone: str = "UTC",
        start_date: date | str | None = None,
        closed: str = "right",
    ):
        if unit not in UNIT_MS:
            raise ValueError(f"unknown time unit {unit!r}; one of {sorted(UNIT_MS)}")
        if length < 1:
            raise ValueError("a frame must last at least one unit")
        if closed not in ("right", "left"):
            raise ValueError("closed is 'right' or 'left'")
        multi_day = unit == "DAYS" and length > 1
        if multi_day and start_date is None:
            raise ValueError("frames of several days need a start_date")
        self.base, self.pattern, self.zone, self.closed = base, pattern, zone, closed
        self.frame_ms = UNIT_MS[unit] * length
        self.start_date = None
        if multi_day:
            text = start_date if isinstance(start_date, str) else start_date.isoformat()
            self.start_date = datetime.fromisoformat(text[:10]).date()

    def sorts_by_time(self) -> bool:
        """Whether names sort in time order, which a "newest N" alias depends on."""
        letters = re.sub(r"'[^']*'", "", self.pattern)
        runs = [m.group(0) for m in re.finditer(r"([A-Za-z])\1*", letters)]
        order = ["y", "M", "d", "H", "m", "s", "S"]
        ranks = [order.index(r[0]) if r[0] in order else -1 for r in runs]
        fixed_width = all(len(r) >= 2 and not (r[0] == "M" and len(r) > 2) for r in runs)
        return -1 not in ranks and fixed_width and ranks == sorted(ranks) and ranks[:1] == [0]

    def frame_start(self, ts: Column) -> Column:
        """Start of the frame holding ``ts`` (TIMESTAMP in, TIMESTAMP out)."""
        if self.start_date is not None:
            origin = self._to_utc(F.lit(self.start_date.isoformat()).cast("timestamp"))
        else:
            origin = self._to_utc(F.date_trunc("DAY", self._to_local(ts)))
        ahead = F.unix_millis(ts) - F.unix_millis(origin)
        if self.closed == "right":
            ahead = ahead - F.lit(1)
        # Before the origin there is no earlier frame: such documents join the first one.
        frames = F.greatest(F.lit(0), F.call_function("div", ahead, F.lit(self.frame_ms)))
        start = F.timestamp_millis(F.unix_millis(origin) + frames * F.lit(self.frame_ms))
        return F.when(ts.isNotNull(), start)

    def collection(self, ts: Column) -> Column:
        """``base`` followed by the formatted frame start; NULL when ``ts`` is NULL."""
        stamp = F.date_format(self._to_local(self.frame_start(ts)), self.pattern)
        return F.concat(F.lit(self.base), stamp)

    def _to_local(self, ts: Column) -> Column:
        return ts if self.zone == "UTC" else F.from_utc_timestamp(ts, self.zone)

    def _to_utc(self, ts: Column) -> Column:
        return ts if self.zone == "UTC" else F.to_utc_timestamp(ts, self.zone)


def as_timestamp(value: Column, data_type: T.DataType, formats: tuple[str, ...] = ()) -> Column:
    """Read a time value of any accepted type; NULL when it cannot be read.

    Strings are tried against ``formats`` in order and then as ISO text; BIGINT is epoch
    milliseconds. A 32-bit integer is not epoch milliseconds: like any other type it is read
    from its text, which fails for a bare number.
    """
    if isinstance(data_type, (T.TimestampType, T.TimestampNTZType, T.DateType)):
        return value.cast("timestamp")
    if isinstance(data_type, T.LongType):
        return F.timestamp_millis(value)
    text = value.cast("string")
    attempts = [F.try_to_timestamp(text, F.lit(f)) for f in formats]
    # Bare digits would otherwise be taken for a year.
    iso = F.when(~text.rlike(r"^\s*[+-]?\d+\s*$"), text.try_cast("timestamp"))
    return F.coalesce(*attempts, iso)
