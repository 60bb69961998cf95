"""Column expressions shared by the feature operators."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def is_type(event_type: str) -> Column:
    return F.col("event_type") == event_type


def hour_in(band: tuple[int, int]) -> Column:
    return F.hour("ts").between(*band)


def share_of(condition: Column) -> Column:
    """Share of a group's rows that meet `condition`."""
    return F.count_if(condition) / F.count("*")


def ratio_or_zero(part: Column, whole: Column) -> Column:
    return F.when(whole > 0, part / whole).otherwise(F.lit(0.0))


def last_time(event_type: str, where: Column | None = None) -> Column:
    """Latest `ts` of one event type within the group, NULL if there is none."""
    condition = is_type(event_type)
    return F.max(F.when(condition if where is None else condition & where, F.col("ts")))


def seconds_between(earlier: str, later: Column) -> Column:
    return F.unix_timestamp(later) - F.unix_timestamp(earlier)


def price_stats(prefix: str) -> list[Column]:
    return [
        F.avg("price").alias(f"{prefix}_avg_price_30d"),
        F.stddev("price").alias(f"{prefix}_price_std_30d"),
        F.max("price").alias(f"{prefix}_max_price_30d"),
        F.min("price").alias(f"{prefix}_min_price_30d"),
    ]


def first_category(path: str = "category_path") -> Column:
    return F.try_element_at(F.col(path), F.lit(1))
