"""Event-time windows anchored at the newest event, without a driver round trip."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

Instant = Column | datetime | str


@dataclass(frozen=True)
class EventClock:
    """`anchor` ends the look-back windows; `as_of` is the moment recency is measured to."""

    anchor: Column
    as_of: Column
    explicit: bool = False

    def cutoff(self, days: int) -> Column:
        return self.anchor - F.make_dt_interval(days=F.lit(days))

    def within(self, days: int) -> Column:
        """True for events in the last `days`, the cutoff itself included."""
        return F.col("ts") >= self.cutoff(days)

    def history(self, events: DataFrame) -> DataFrame:
        """All events known at the anchor. An anchor taken from the data excludes nothing."""
        if not self.explicit:
            return events
        known = events.filter(F.col("ts") <= self.anchor)
        if "event_date" in events.columns:  # later partitions are not read
            known = known.filter(F.col("event_date") <= F.to_date(self.anchor))
        return known

    def recent(self, events: DataFrame, days: int) -> DataFrame:
        """Events of the window; on a date-partitioned table this prunes partitions as well."""
        recent = self.history(events).filter(self.within(days))
        if "event_date" in events.columns:
            recent = recent.filter(F.col("event_date") >= F.to_date(self.cutoff(days)))
        return recent


def _instant(value: Instant) -> Column:
    return value if isinstance(value, Column) else F.lit(value).cast("timestamp")


def newest_event(events: DataFrame, date_partitioned: bool = False) -> DataFrame:
    """One row `max_ts`; running it fails if there are no events.

    On a table partitioned by event_date the newest day comes from the partition
    values alone, so only that day's `ts` is read.
    """
    if not isinstance(events.schema["ts"].dataType, T.TimestampType):
        raise TypeError(f"ts must be a timestamp, not {events.schema['ts'].dataType.simpleString()}")
    if date_partitioned:
        last_day = events.agg(F.max("event_date")).scalar()
        events = events.filter(F.col("event_date") == last_day)
    none_found = F.raise_error(F.lit("no events: windows cannot be anchored")).cast("timestamp")
    return events.agg(F.coalesce(F.max("ts"), none_found).alias("max_ts"))


def event_clock(
    events: DataFrame,
    anchor: Instant | None = None,
    as_of: Instant | None = None,
    date_partitioned: bool = False,
) -> EventClock:
    """Clock over `events`.

    By default both moments are the newest event time, so results repeat. Pass
    `as_of=F.current_timestamp()` for wall-clock recency, or `anchor` to backfill
    a past day as if later events had not happened.
    """
    if anchor is None:
        at = newest_event(events, date_partitioned).scalar()
    else:
        at = _instant(anchor)
    return EventClock(at, at if as_of is None else _instant(as_of), explicit=anchor is not None)


def window_bounds(events: DataFrame, long_days: int = 30, short_days: int = 7) -> DataFrame:
    """One row: newest event time and the two cutoffs."""
    newest = newest_event(events)
    clock = EventClock(F.col("max_ts"), F.col("max_ts"))
    return newest.select(
        "max_ts",
        clock.cutoff(long_days).alias("cutoff_long"),
        clock.cutoff(short_days).alias("cutoff_short"),
    )
