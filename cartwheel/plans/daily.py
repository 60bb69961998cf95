"""The daily jobs, table to table: silver, then user and item features, then pairs, then online rows."""

from __future__ import annotations

from datetime import date as Date
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cartwheel.functions.windows import EventClock, Instant, event_clock
from cartwheel.operators.cleaning import silver_events
from cartwheel.operators.entities import silver_items, silver_items_with_catalog, silver_users
from cartwheel.operators.items import item_features
from cartwheel.operators.pairs import cross_features
from cartwheel.operators.states import (
    day_states,
    in_days,
    item_features_from_states,
    item_lives,
    item_sketches,
    user_features_from_states,
    user_lives,
    user_sketches,
)
from cartwheel.operators.text import embed, item_documents
from cartwheel.operators.users import user_category_docs, user_features
from cartwheel.operators.views import feature_view, materialize
from cartwheel.schemas import CROSS_VIEW, ITEM_VIEW, USER_VIEW, WINDOW_DAYS, FeatureView
from cartwheel.sources.online import online_upsert
from cartwheel.sources.tables import (
    bronze_scan,
    feature_source,
    table_exists,
    table_scan,
    write_day_states,
    write_entity_table,
    write_gold_snapshot,
    write_silver_events,
)

STATES = ("sessions", "categories", "pairs", "items")
VIEWS = {"gold/user_features": USER_VIEW, "gold/item_features": ITEM_VIEW, "gold/cross_features": CROSS_VIEW}


class DailyJobs:
    """One warehouse folder and one snapshot date; each method is a job that can be rerun on its own.

    `date` names the snapshot. With `anchor` set, events after it are ignored, so
    a past day can be rebuilt as it was.
    """

    def __init__(
        self,
        spark: SparkSession,
        root: str,
        date: str,
        anchor: Instant | None = None,
        as_of: Instant | None = None,
        fmt: str = "parquet",
    ):
        self.spark, self.root, self.date, self.fmt = spark, root.rstrip("/"), date, fmt
        self.anchor, self.as_of = anchor, as_of

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def read(self, name: str) -> DataFrame:
        return table_scan(self.spark, self.path(name), self.fmt)

    def snapshot(self, name: str) -> DataFrame:
        return self.read(name).filter(F.col("date").cast("string") == self.date).drop("date")

    def clock(self, events: DataFrame) -> EventClock:
        return event_clock(events, self.anchor, self.as_of, date_partitioned=True)

    def silver_events(self, bronze_path: str, replace_all: bool = False, schema: T.StructType | None = None) -> None:
        """Clean events of a bronze folder, which may be that of one day: other days stay unless `replace_all`.

        Name the files' `schema` where it is known; else their footers are sampled.
        """
        events = silver_events(bronze_scan(self.spark, bronze_path, schema))
        write_silver_events(events, self.path("silver/events"), self.fmt, replace_all)

    def silver_entities(self, catalog: DataFrame | None = None) -> None:
        events = self.read("silver/events")
        if self.anchor is not None:  # a past day knows neither later prices nor later categories
            events = self.clock(events).history(events)
        items = silver_items(events)
        if catalog is not None:
            items = silver_items_with_catalog(items, catalog)
        write_entity_table(silver_users(events), self.path("silver/users"), self.fmt)
        write_entity_table(items, self.path("silver/items"), self.fmt)

    def _write_gold(self, features: DataFrame, name: str) -> None:
        write_gold_snapshot(features, self.path(name), self.date, self.fmt)

    def gold_users(self, with_embeddings: bool = True) -> None:
        events = self.read("silver/events")
        clock = self.clock(events)
        embeddings = None
        if with_embeddings:
            embeddings = embed(user_category_docs(events, clock), "user_id", "user_behavior_emb")
        self._write_gold(user_features(events, clock, embeddings), "gold/user_features")

    def gold_items(self, with_embeddings: bool = True, declared_only: bool = False) -> None:
        events, items = self.read("silver/events"), self.read("silver/items")
        embeddings = embed(item_documents(items), "item_id", "item_behavior_emb") if with_embeddings else None
        features = item_features(events, items, self.clock(events), embeddings, declared_only=declared_only)
        self._write_gold(features, "gold/item_features")

    # ---- the same snapshots from daily states: a day's run reads one day of events ----

    @property
    def day(self) -> Date:
        return Date.fromisoformat(self.date)

    def states(self, *names: str) -> dict[str, DataFrame]:
        return {name: self.read(f"state/{name}") for name in names}

    def lives(self, name: str, before: bool = False) -> DataFrame:
        """First and last times as of this date, or as of the newest earlier one."""
        table = self.read(f"state/{name}").withColumn("date", F.col("date").cast("string"))
        date = table.filter(F.col("date") < self.date).agg(F.max("date")).first()[0] if before else self.date
        return table.filter(F.col("date") == date).drop("date")

    def day_states(self, first: str | None = None, sketches: bool = False, only: tuple[str, ...] = STATES) -> None:
        """Add this date's states to those of earlier days; with `first`, start anew with all days from there on.

        Users need sessions, categories and pairs, items need items and pairs: `only` names those to write.
        Reads this date's events, the session states of the window before, and the last
        lives. Dates run in order; one that is run again replaces its own states, and those after it are to be run again too.
        """
        begin = Date.fromisoformat(first) if first else self.day
        days = (self.day - begin).days + 1
        events = in_days(self.read("silver/events"), self.day, days)
        known = None if first or "sessions" not in only else in_days(self.read("state/sessions"), begin - timedelta(days=1), WINDOW_DAYS)
        for name, rows in day_states(events, known).items():
            if name in only:
                write_day_states(rows, self.path(f"state/{name}"), self.fmt)
        new = {name: in_days(rows, self.day, days) for name, rows in self.states(*only).items()}
        if sketches:
            write_day_states(user_sketches(new["pairs"], new["sessions"]), self.path("state/user_sketches"), self.fmt)
            write_day_states(item_sketches(new["pairs"]), self.path("state/item_sketches"), self.fmt)
        for name, build, of in (("user_lives", user_lives, "sessions"), ("item_lives", item_lives, "items")):
            if of in only:
                self._write_gold(build(new[of], None if first else self.lives(name, before=True)), f"state/{name}")

    def gold_users_from_states(self, as_of: Column | None = None, approximate: bool = False, name: str = "gold/user_features") -> None:
        states = self.states("sessions", "categories", "user_sketches" if approximate else "pairs")
        features = user_features_from_states(states, self.lives("user_lives"), self.day, as_of, approximate=approximate)
        self._write_gold(features, name)

    def gold_items_from_states(self, as_of: Column | None = None, declared_only: bool = False, approximate: bool = False) -> None:
        states = self.states("items", "item_sketches" if approximate else "pairs")
        features = item_features_from_states(
            states, self.lives("item_lives"), self.read("silver/items"), self.day, as_of, declared_only=declared_only, approximate=approximate
        )
        self._write_gold(features, "gold/item_features")

    def gold_pairs(self, pairs: DataFrame | None = None) -> None:
        events = self.read("silver/events")
        users, items = self.snapshot("gold/user_features"), self.snapshot("gold/item_features")
        self._write_gold(cross_features(events, users, items, self.clock(events), pairs), "gold/cross_features")

    def publish(self, name: str, start: Instant, end: Instant, batch_id: int) -> None:
        """Materialise one view's snapshots in [start, end) to its online log."""
        view: FeatureView = VIEWS[name]
        source = feature_source(self.spark, self.path(name), self.fmt).drop("event_timestamp")
        rows = materialize(feature_view(source, view), view, start, end)
        online_upsert(rows, self.path(f"online/{view.name}"), batch_id, writer=f"{view.name}-{self.date}")

    def published_until(self, name: str) -> datetime | None:
        """The end of the last complete incremental publication of a view."""
        path = self.path(f"online/_published/{VIEWS[name].name}")
        if not table_exists(self.spark, path):
            return None
        self.spark.catalog.refreshByPath(path)
        newest = self.spark.read.schema("until string").parquet(path).agg(F.max("until")).first()[0]
        return newest and datetime.fromisoformat(newest)

    def publish_incremental(self, name: str, end: datetime) -> None:
        """Materialise the snapshots since the last publication, or those of the view's lifetime before `end` at first.

        Where the last one ended is written down once the rows are there: a run that stops before that is
        repeated whole and replaces its own batch.
        """
        view = VIEWS[name]
        start = self.published_until(name) or end - timedelta(days=view.ttl_days)
        if start >= end:
            return
        self.publish(name, start, end, batch_id=int(end.timestamp()))
        until = self.spark.range(1).select(F.lit(end.isoformat()).alias("until"))
        until.write.mode("append").parquet(self.path(f"online/_published/{view.name}"))

    def run(self, bronze_path: str, catalog: DataFrame | None = None) -> None:
        self.silver_events(bronze_path)
        self.silver_entities(catalog)
        self.gold_users()
        self.gold_items()
        self.gold_pairs()
