"""Raw events to clean events, and the contract report."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cartwheel.schemas import DEVICES, EVENT_FIELDS, EVENT_IDENTITY, EVENT_TYPES, PAGES, REQUIRED_FIELDS


def drop_broken(raw: DataFrame) -> DataFrame:
    return raw.filter(F.col("user_id").isNotNull())


def normalize_ts(raw: DataFrame) -> DataFrame:
    """Epoch milliseconds become a timestamp; any other type passes through."""
    if "ts" not in raw.columns:
        raise ValueError("raw events have no ts column")
    if isinstance(raw.schema["ts"].dataType, T.IntegralType):
        return raw.withColumn("ts", F.timestamp_millis(F.col("ts").cast("bigint")))
    return raw


def typed_projection(raw: DataFrame) -> DataFrame:
    """The ten event columns in their clean types; a value that does not parse becomes NULL."""
    missing = [name for name in EVENT_FIELDS if name not in raw.columns]
    if missing:
        raise ValueError(f"raw events lack columns: {', '.join(missing)}")
    return raw.select(*[F.col(name).try_cast(dtype).alias(name) for name, dtype in EVENT_FIELDS.items()])


def drop_null_keys_price(events: DataFrame) -> DataFrame:
    # one predicate per column, so that each can reach the scan
    for name in REQUIRED_FIELDS:
        events = events.filter(F.col(name).isNotNull())
    return events.filter(F.col("price") > 0)


def sanitize_categoricals(events: DataFrame) -> DataFrame:
    """Lower-case event type, device and page, then keep permitted values only."""
    allowed = {"event_type": EVENT_TYPES, "device": DEVICES, "page": PAGES}
    lowered = events.withColumns({name: F.lower(name) for name in allowed})
    for name, values in allowed.items():
        lowered = lowered.filter(F.col(name).isin(values))
    return lowered


def date_hour(events: DataFrame) -> DataFrame:
    return events.withColumns({"event_date": F.to_date("ts"), "event_hour": F.hour("ts")})


def dedupe_events(events: DataFrame) -> DataFrame:
    """One row per event identity; copies that differ elsewhere keep the smallest (referrer, category_path).

    An aggregate rather than a window: copies collapse before the shuffle, so an
    event repeated a billion times costs one row per map task.
    """
    rest = ["referrer", "category_path"]
    rest += [c for c in events.columns if c not in EVENT_IDENTITY and c not in rest]
    kept = events.groupBy(*EVENT_IDENTITY).agg(F.min(F.struct(*rest)).alias("_rest"))
    return kept.select(*[c if c in EVENT_IDENTITY else F.col(f"_rest.{c}").alias(c) for c in events.columns])


def clean_rows(raw: DataFrame) -> DataFrame:
    """Row-wise part of the cleaning: no shuffle, usable on streams."""
    return (
        raw.transform(drop_broken)
        .transform(normalize_ts)
        .transform(typed_projection)
        .transform(drop_null_keys_price)
        .transform(sanitize_categoricals)
    )


def silver_events(raw: DataFrame) -> DataFrame:
    """The clean event table. Date and hour follow from `ts`, so they are derived after the shuffle."""
    return raw.transform(clean_rows).transform(dedupe_events).transform(date_hour)


def _violations() -> dict[str, Column]:
    """Per contract rule, a column that is true where the rule is broken."""

    def outside(name: str, values: list[str]) -> Column:
        return ~F.coalesce(F.col(name).isin(values), F.lit(False))

    return {
        "user_id_present": F.col("user_id").isNull(),
        "session_id_present": F.col("session_id").isNull(),
        "item_id_present": F.col("item_id").isNull(),
        "event_type_known": outside("event_type", EVENT_TYPES),
        "price_positive": ~F.coalesce(F.col("price") > 0, F.lit(False)),
        "category_path_present": F.col("category_path").isNull(),
        "device_known": outside("device", DEVICES),
        "page_known": outside("page", PAGES),
        "ts_present": F.col("ts").isNull(),
    }


def event_contract_report(raw: DataFrame) -> DataFrame:
    """One row per rule: rows checked and rows that break it, in a single pass."""
    rules = _violations()
    counts = raw.agg(F.count("*").alias("checked"), *[F.count_if(broken).alias(name) for name, broken in rules.items()])
    per_rule = [F.struct(F.lit(name).alias("rule"), F.col(name).alias("violations")) for name in rules]
    return counts.select("checked", F.inline(F.array(*per_rule)))


def broken_rules() -> Column:
    """Names of the contract rules that a row breaks."""
    return F.array_compact(F.array(*[F.when(c, F.lit(name)) for name, c in _violations().items()]))


def split_by_contract(raw: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows that keep the contract, quarantined rows with the rules they break)."""
    judged = raw.withColumn("broken_rules", broken_rules())
    return judged.filter(F.size("broken_rules") == 0).drop("broken_rules"), judged.filter(F.size("broken_rules") > 0)
