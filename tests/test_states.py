"""Windows merged from daily states against windows counted from events."""

import glob
import random
from datetime import date, timedelta

import pytest
from conftest import DAY, NEWEST, event
from pyspark.sql import functions as F

from cartwheel.operators import cleaning, entities, items, states, users
from cartwheel.plans.daily import DailyJobs
from cartwheel.scratch import new_path
from cartwheel.sources import tables

LAST = date(2024, 1, 31)


def history(n=900, days=36, seed=4):
    """Sessions that pause for days, cross the window's border or last for all of it; a hot user, odd prices, empty paths."""
    rng = random.Random(seed)
    rows = []
    for _ in range(n):
        user = rng.choice(["hot"] * 5 + ["a", "b", "c", None])
        rows.append(
            event(
                user_id=user,
                session_id=rng.choice([f"{user}-always", f"{user}-{rng.randrange(12)}"]),
                item_id=rng.choice([f"i{rng.randrange(9)}", "i0", "i0"]),
                event_type=rng.choice(["view", "view", "add_to_cart", "purchase"]),
                price=rng.choice([0.1, 0.1, 7.7, float(rng.randrange(1, 900)) / 7]),
                category_path=rng.choice([["A", "B"], ["B"], ["C"], None, []]),
                device=rng.choice(["web", "ios", "android"]),
                ts=NEWEST - rng.randrange(days * DAY // 1000) * 1000,
            )
        )
    return [*rows, event(user_id="once", session_id="x", price=0.1, ts=NEWEST + 1), *[event(user_id="same", price=0.1, ts=NEWEST - k * DAY) for k in range(3)]]


def rows_of(df, key):
    """Rows by key, doubles rounded."""
    return {r[key]: {c: round(v, 7) if isinstance(v, float) else v for c, v in r.asDict().items()} for r in df.drop("date").collect()}


@pytest.fixture(scope="module")
def lake(spark, events_of):
    root = new_path(spark, "states-lake")
    events = cleaning.silver_events(events_of(*history()))
    tables.write_silver_events(events, f"{root}/silver/events")
    tables.write_entity_table(entities.silver_items(events), f"{root}/silver/items")
    start = LAST - timedelta(days=40)
    DailyJobs(spark, root, str(LAST - timedelta(days=2))).day_states(first=str(start), sketches=True)
    for age in (1, 0):
        DailyJobs(spark, root, str(LAST - timedelta(days=age))).day_states(sketches=True)
    return root


def test_increments_equal_a_rebuild(spark, lake):
    events, silver_items = tables.table_scan(spark, f"{lake}/silver/events"), tables.table_scan(spark, f"{lake}/silver/items")
    for age in (0, 1):
        day = LAST - timedelta(days=age)
        jobs, clock = DailyJobs(spark, lake, str(day)), states.day_clock(day)
        jobs.gold_users_from_states()
        jobs.gold_items_from_states(declared_only=True)
        found = rows_of(jobs.snapshot("gold/user_features"), "user_id")
        assert found == rows_of(users.user_features(events, clock), "user_id") and "hot" in found and len(found) >= 4
        found = rows_of(jobs.snapshot("gold/item_features"), "item_id")
        assert found == rows_of(items.item_features(events, silver_items, clock, declared_only=True), "item_id")


def test_a_rerun_changes_nothing(spark, lake):
    jobs = DailyJobs(spark, lake, str(LAST))
    before = {name: jobs.read(f"state/{name}").count() for name in ("sessions", "categories", "pairs", "items", "user_lives", "item_lives")}
    jobs.day_states(sketches=True)
    assert before == {name: jobs.read(f"state/{name}").count() for name in before}


def test_a_days_run_reads_that_day_alone(spark, events_of):
    """The files of all other days are broken: reading any would fail."""
    root = new_path(spark, "states-broken")
    events = cleaning.silver_events(events_of(*history(200, 5)))
    tables.write_silver_events(events, f"{root}/silver/events")
    tables.write_entity_table(entities.silver_items(events), f"{root}/silver/items")
    DailyJobs(spark, root, str(LAST - timedelta(days=1))).day_states(first=str(LAST - timedelta(days=9)))
    for path in glob.glob(f"{root}/silver/events/event_date=*/**/*.parquet", recursive=True):
        if f"event_date={LAST}" not in path:
            with open(path, "wb") as file:
                file.write(b"broken")
    jobs = DailyJobs(spark, root, str(LAST))
    # the file schema is known, as it would be from a catalogue: inferring it could open any file
    schema = events.schema
    jobs.read = lambda name: spark.read.schema(schema).parquet(jobs.path(name)) if name == "silver/events" else tables.table_scan(spark, jobs.path(name))
    jobs.day_states()
    jobs.gold_users_from_states()
    jobs.gold_items_from_states()
    assert jobs.snapshot("gold/user_features").count() > 3 and jobs.snapshot("gold/item_features").count() > 3
    with pytest.raises(Exception, match="broken|Parquet|footer"):
        users.user_volume(jobs.read("silver/events"), states.day_clock(LAST)).collect()


def test_sketches_keep_their_bounds(spark):
    """Thirty days of ten thousand items, users and sessions; estimates within four standard errors, medians within 1.7 % of ranks."""
    error = 4 * 1.04 / 2 ** (states.HLL_BITS / 2)
    n = 120_000
    events = spark.range(n).select(
        F.date_sub(F.lit(LAST), (F.col("id") % 30).cast("int")).alias("event_date"),
        F.when(F.col("id") % 3 == 0, F.concat(F.lit("u"), F.col("id") % 9973)).otherwise("hot").alias("user_id"),
        F.concat(F.lit("i"), F.when(F.col("id") % 3 == 1, 0).otherwise(F.col("id") % 10007)).alias("item_id"),
        F.concat(F.lit("s"), F.floor(F.sqrt(F.col("id") * 40.0))).alias("session_id"),
        F.lit("view").alias("event_type"),
        F.lit(1.0).alias("price"),
        F.lit(None).cast("array<string>").alias("category_path"),
        F.lit("web").alias("device"),
        (F.lit(LAST).cast("timestamp") - F.make_dt_interval(days=(F.col("id") % 30).cast("int"))).alias("ts"),
    )
    root = new_path(spark, "states-sketch")
    pairs, sessions = states.pair_states(events), states.session_states(events)
    tables.write_day_states(states.user_sketches(pairs, sessions), f"{root}/users")
    tables.write_day_states(states.item_sketches(pairs), f"{root}/items")
    hot = events.filter("user_id = 'hot'")
    exact = hot.agg(F.count_distinct("item_id").alias("items"), F.count_distinct(F.when(F.col("event_date") > F.date_sub(F.lit(LAST), 7), F.col("session_id"))).alias("sessions")).first()
    found = states._sketched_users(tables.table_scan(spark, f"{root}/users"), LAST, 30, 7).filter("user_id = 'hot'").first()
    assert exact["items"] > 6_000 and abs(found.user_distinct_items_viewed_30d / exact["items"] - 1) < error
    assert abs(found.user_sessions_7d / exact["sessions"] - 1) < error
    lengths = sorted(r.n for r in hot.groupBy("event_date", "session_id").agg(F.count("*").alias("n")).collect())
    median = found.user_median_session_length_events_30d
    assert sum(x < median for x in lengths) <= 0.517 * len(lengths) and sum(x <= median for x in lengths) >= 0.483 * len(lengths)
    viewers = tables.table_scan(spark, f"{root}/items").filter("item_id = 'i0'").agg(F.hll_sketch_estimate(F.hll_union_agg("viewers")).alias("n")).first().n
    assert abs(viewers / events.filter("item_id = 'i0'").agg(F.count_distinct("user_id")).first()[0] - 1) < error


def test_approximate_features_have_the_same_columns(spark, lake):
    jobs = DailyJobs(spark, lake, str(LAST))
    jobs.gold_users_from_states()
    exact = {r.user_id: r for r in jobs.snapshot("gold/user_features").collect()}
    jobs.gold_users_from_states(approximate=True)
    found = {r.user_id: r for r in jobs.snapshot("gold/user_features").collect()}
    assert found.keys() == exact.keys()
    for user, r in found.items():
        assert set(r.asDict()) == set(exact[user].asDict())
        assert abs(r.user_distinct_items_viewed_30d - exact[user].user_distinct_items_viewed_30d) <= 1
        assert (r.user_total_events_30d, r.user_events_last_session) == (exact[user].user_total_events_30d, exact[user].user_events_last_session)
    jobs.gold_items_from_states(approximate=True)
    assert jobs.snapshot("gold/item_features").filter("item_distinct_users_viewed_30d > 0").count() > 3
