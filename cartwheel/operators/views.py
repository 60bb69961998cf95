"""Feature views over dated snapshots: typed columns, online materialisation, training joins."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cartwheel.functions.skew import range_slices, running
from cartwheel.schemas import Feature, FeatureView
from cartwheel.sources.online import online_rows


def duplicate_keys(table: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    """Join keys that occur more than once; none in a sound feature table."""
    return table.groupBy(*keys).agg(F.count("*").alias("rows")).filter(F.col("rows") > 1)


def feature_view(table: DataFrame, view: FeatureView) -> DataFrame:
    """The view's columns in their declared types. Fields a table lacks are NULL; the date stays if there is one."""
    fields = [
        (F.col(f.name) if f.name in table.columns else F.lit(None)).cast(f.dtype).alias(f.name) for f in view.fields
    ]
    date = ["date"] if "date" in table.columns else []
    return table.select(*view.join_keys, *fields, *date)


def latest_per_entity(snapshots: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    """The newest dated row per entity; an entity has at most one row per day."""
    newest = snapshots.groupBy(*keys).agg(F.max("date").alias("date"))
    rest = [c for c in snapshots.columns if c not in (*keys, "date")]
    return snapshots.join(newest, [*keys, "date"]).select(*keys, "date", *rest)


def materialize(
    snapshots: DataFrame,
    view: FeatureView,
    start: datetime | Column,
    end: datetime | Column,
    prefix: str | None = None,
) -> DataFrame:
    """One online row per entity from the newest snapshot with start <= date < end.

    The row is stamped with its snapshot date and lives for the view's TTL from there.
    """
    at = F.to_timestamp("date")
    in_range = snapshots.filter((at >= F.lit(start)) & (at < F.lit(end)))
    rows = latest_per_entity(in_range, view.join_keys)
    stamped = rows.withColumn("rt_updated_at_ms", F.unix_millis(F.to_timestamp("date"))).drop("date")
    return online_rows(stamped, list(view.join_keys), prefix or f"{view.name}:", ttl_sec=view.ttl_days * 86400)


def point_in_time_join(
    labels: DataFrame, snapshots: DataFrame, keys: tuple[str, ...], ttl_days: int, label_ts: str = "label_ts"
) -> DataFrame:
    """Each label row with the newest snapshot not after it and at most `ttl_days` before it, else NULLs.

    Snapshots are daily, so a label can match the midnights of its TTL and no
    others. The days are looked up for each distinct (entity, day span) by an
    equi-join on (entity, day) among the days that have one; however many labels an entity has, it contributes
    at most two spans per day. Features are fetched once the day is known.
    """
    first_midnight = F.date_trunc("day", F.col(label_ts) - F.make_dt_interval(days=F.lit(ttl_days)))
    exact = first_midnight == F.col(label_ts) - F.make_dt_interval(days=F.lit(ttl_days))
    spans = labels.withColumns(
        {
            "_last": F.to_date(label_ts),
            "_first": F.when(exact, F.to_date(first_midnight)).otherwise(F.date_add(F.to_date(first_midnight), 1)),
        }
    )
    by = [*keys, "_first", "_last"]
    dated = snapshots.withColumn("_day", F.to_date("date")).drop("date")
    # only days that have a snapshot can match: a list as long as there are snapshots, not as the TTL has days
    known = dated.agg(F.array_sort(F.collect_set("_day"))).scalar()
    in_span = F.filter("_known", lambda day: day.between(F.col("_first"), F.col("_last")))
    days = spans.select(*by).distinct().withColumn("_known", known).withColumn("_day", F.explode(in_span)).drop("_known")
    matched = (
        days.join(dated.select(*keys, "_day"), [*keys, "_day"])
        .groupBy(*by)
        .agg(F.max("_day").alias("_day"))
    )
    return (
        spans.join(matched, by, "left")
        .join(dated, [*keys, "_day"], "left")
        .withColumnRenamed("_day", "feature_date")
        .drop("_first", "_last")
    )


def as_of_join(
    labels: DataFrame,
    features: DataFrame,
    keys: tuple[str, ...],
    ttl_sec: float,
    label_ts: str = "label_ts",
    feature_ts: str = "feature_ts",
) -> DataFrame:
    """Each label row with its entity's newest feature row not after it and at most `ttl_sec` before it, else NULLs; to the microsecond.

    Labels and features are put in one order of (entity, time) and each label takes
    the last feature before it. The order is cut into slices, so that an entity with any
    share of the rows spreads over many tasks; what a slice ends with is carried to
    the next. Of several feature rows of one moment the greatest counts. Labels without an entity or a time match nothing.
    """
    values = [c for c in features.columns if c not in keys]
    asked = labels.select(*keys, F.col(label_ts).alias("_at"), F.lit(1).alias("_kind"), F.struct(*labels.columns).alias("_label"))
    known = features.filter(F.col(feature_ts).isNotNull())
    for key in keys:
        known = known.filter(F.col(key).isNotNull())
    known = known.select(
        *keys, F.col(feature_ts).alias("_at"), F.lit(0).alias("_kind"), F.struct(F.col(feature_ts).alias("_since"), *values).alias("_feature")
    )
    both = asked.unionByName(known, allowMissingColumns=True)
    order = ["_at", "_kind"]
    filled = running(range_slices(both, list(keys), order, "as-of-slices"), list(keys), order, maxima={"_last": F.col("_feature")}).filter("_kind = 1")
    fresh = F.col("_last._since") >= F.col("_at") - F.make_dt_interval(secs=F.lit(ttl_sec))
    return filled.withColumn("_last", F.when(fresh, F.col("_last"))).select("_label.*", *[F.col(f"_last.{c}").alias(c) for c in values])


def catalog_profile(table: DataFrame, catalog: list[Feature]) -> DataFrame:
    """One row per declared feature: present, typed as declared, row and null counts, numeric range. One pass."""
    actual = {f.name: f.dataType for f in table.schema.fields}
    rows = []
    for feature in catalog:
        dtype = actual.get(feature.name)
        value = F.col(feature.name) if dtype is not None else F.lit(None)
        number = value.cast("double") if isinstance(dtype, T.NumericType) else F.lit(None).cast("double")
        nulls = F.count_if(value.isNull()) if dtype is not None else F.lit(None).cast("bigint")
        rows.append(
            F.struct(
                F.lit(feature.name).alias("feature"),
                F.lit(feature.family).alias("family"),
                F.lit(feature.dtype).alias("declared_dtype"),
                F.lit(dtype is not None).alias("present"),
                F.lit(dtype is not None and dtype.simpleString() == feature.dtype).alias("dtype_matches"),
                nulls.alias("null_count"),
                F.min(number).alias("min_value"),
                F.max(number).alias("max_value"),
            )
        )
    return table.agg(F.count("*").alias("row_count"), F.array(*rows).alias("_rows")).select("row_count", F.inline("_rows"))
