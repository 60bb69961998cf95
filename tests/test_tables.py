import random
from datetime import datetime, timedelta
from pathlib import Path
from urllib.parse import urlparse

import pytest
from conftest import SF
from pyspark.sql import functions as F

from cartwheel import scratch
from cartwheel.operators import views
from cartwheel.plans.daily import DailyJobs
from cartwheel.plans.retail_tables import catalog, raw_events
from cartwheel.schemas import CROSS_VIEW, ITEM_VIEW, USER_CATALOG, USER_VIEW, FeatureView
from cartwheel.scratch import new_path
from cartwheel.sources import online, tables


def test_a_snapshot_replaces_its_own_date_only(spark):
    path = new_path(spark, "gold")
    tables.write_gold_snapshot(spark.range(3), path, "2024-01-01")
    tables.write_gold_snapshot(spark.range(5), path, "2024-01-02")
    tables.write_gold_snapshot(spark.range(1), path, "2024-01-01")
    counts = {str(r.date): r["count"] for r in tables.table_scan(spark, path).groupBy("date").count().collect()}
    assert counts == {"2024-01-01": 1, "2024-01-02": 5}


@pytest.fixture(scope="module")
def warehouse(spark):
    root = new_path(spark, "warehouse")
    raw_events(spark, SF).write.parquet(f"{root}/bronze/topic/part-a")
    jobs = DailyJobs(spark, root, "2024-01-30")
    jobs.run(f"{root}/bronze", catalog(spark, SF).select("item_id", "title", "brand"))
    return jobs


def test_daily_jobs_fill_every_view(warehouse):
    users, items, pairs = (warehouse.snapshot(f"gold/{n}_features") for n in ("user", "item", "cross"))
    assert users.count() == 15 and items.count() <= 100 and pairs.count() > 500
    for table, view in ((users, USER_VIEW), (items, ITEM_VIEW), (pairs, CROSS_VIEW)):
        assert {f.name for f in view.fields} <= set(table.columns)
        assert views.duplicate_keys(table, view.join_keys).isEmpty()
    similarity = pairs.agg(F.count("ui_user_item_similarity_emb")).first()[0]
    assert similarity == pairs.count()


def test_rerunning_a_job_changes_nothing(warehouse):
    before = warehouse.snapshot("gold/cross_features").count()
    warehouse.gold_pairs()
    assert warehouse.snapshot("gold/cross_features").count() == before


def test_published_rows(warehouse, spark):
    warehouse.publish("gold/user_features", datetime(2024, 1, 1), datetime(2024, 1, 31), 1)
    log = online.online_log(spark, warehouse.path("online/user_features"))
    assert log.count() == 15
    assert log.first().ttl_sec == 30 * 86400
    warehouse.publish("gold/user_features", datetime(2024, 1, 1), datetime(2024, 1, 30), 2)
    assert online.online_log(spark, warehouse.path("online/user_features")).count() == 15


def test_publishing_goes_on_where_it_ended(warehouse, spark, monkeypatch):
    jobs = DailyJobs(spark, warehouse.root, "2024-01-30")
    path = jobs.path("online/item_features")
    assert jobs.published_until("gold/item_features") is None
    with monkeypatch.context() as patch:
        patch.setattr("cartwheel.plans.daily.online_upsert", lambda *a, **k: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            jobs.publish_incremental("gold/item_features", datetime(2024, 1, 31))
    assert jobs.published_until("gold/item_features") is None
    jobs.publish_incremental("gold/item_features", datetime(2024, 1, 31))
    first = online.online_log(spark, path).count()
    assert first > 50 and jobs.published_until("gold/item_features") == datetime(2024, 1, 31)
    jobs.publish_incremental("gold/item_features", datetime(2024, 1, 31))
    snapshot = jobs.snapshot("gold/item_features").limit(3)
    tables.write_gold_snapshot(snapshot, jobs.path("gold/item_features"), "2024-02-01")
    jobs.publish_incremental("gold/item_features", datetime(2024, 2, 2))
    assert online.online_log(spark, path).count() == first + 3


def test_backfill_ignores_later_events(warehouse, spark):
    past = DailyJobs(spark, warehouse.root, "2024-01-10", anchor="2024-01-10")
    past.gold_users(with_embeddings=False)
    newest = past.snapshot("gold/user_features").agg(F.max("last_ts")).first()[0]
    assert newest <= datetime(2024, 1, 10)
    assert warehouse.snapshot("gold/user_features").count() == 15


def test_view_fields_and_types():
    assert [len(v.fields) for v in (USER_VIEW, ITEM_VIEW, CROSS_VIEW)] == [40, 29, 13]
    assert [v.ttl_days for v in (USER_VIEW, ITEM_VIEW, CROSS_VIEW)] == [30, 30, 7]


def test_view_casts_and_fills(spark):
    table = spark.createDataFrame([("u1", 3, 0.5)], "user_id string, user_sessions_7d bigint, user_avg_price_30d double")
    view = views.feature_view(table, USER_VIEW)
    assert dict(view.dtypes)["user_sessions_7d"] == "int"
    assert view.first().user_top_category_1 is None


def test_catalog_profile(spark):
    table = spark.createDataFrame([("u1", 3, None), ("u2", 5, 1.0)], "user_id string, user_views_30d bigint, user_avg_price_30d double")
    profile = {r.feature: r for r in views.catalog_profile(table, USER_CATALOG).collect()}
    assert len(profile) == 40
    seen = profile["user_views_30d"]
    assert (seen.present, seen.dtype_matches, seen.null_count, seen.min_value, seen.max_value) == (True, True, 0, 3.0, 5.0)
    assert not profile["user_avg_price_30d"].dtype_matches and profile["user_avg_price_30d"].null_count == 1
    assert not profile["user_top_category_1"].present


SNAPSHOT = FeatureView("s", ("user_id",), 3, ())


def test_point_in_time_join_against_brute_force(spark):
    rng = random.Random(3)
    start = datetime(2024, 1, 1)
    dated = {
        (rng.choice(["hot", "a", "b"]), (start + timedelta(days=rng.randrange(20))).date(), n) for n in range(25)
    }
    dated = list({(u, d): (u, d, n) for u, d, n in dated}.values())
    # half of the labels belong to one user; some lie exactly at midnight
    labels = [
        (
            rng.choice(["hot", "hot", "a", "b", "c", None]),
            start + timedelta(days=rng.randrange(25), seconds=rng.choice([0, 0, 1, 40_000, 86_399])),
            n,
        )
        for n in range(200)
    ]
    snapshots = spark.createDataFrame(dated, "user_id string, date date, score int")
    asked = spark.createDataFrame(labels, "user_id string, label_ts timestamp_ntz, label int").withColumn("label_ts", F.col("label_ts").cast("timestamp"))

    def expected(user, at):
        found = [
            (d, n)
            for u, d, n in dated
            if u == user and at - timedelta(days=3) <= datetime(d.year, d.month, d.day) <= at
        ]
        return max(found) if found else (None, None)

    rows = views.point_in_time_join(asked, snapshots, ("user_id",), ttl_days=3).collect()
    assert len(rows) == len(labels)
    found = {r.label: (r.feature_date, r.score) for r in rows}
    assert found == {n: expected(u, at) for u, at, n in labels}


def test_materialize_takes_the_newest_date_in_range(spark):
    rows = [("a", "2024-01-01", 1), ("a", "2024-01-03", 3), ("a", "2024-01-05", 5), ("b", "2023-12-01", 0)]
    snapshots = spark.createDataFrame(rows, "user_id string, date string, score int")
    found = views.materialize(snapshots, SNAPSHOT, datetime(2024, 1, 1), datetime(2024, 1, 5)).collect()
    assert [(r.key, r.ttl_sec) for r in found] == [("s:a", 3 * 86400)]
    assert '"score":3' in found[0].value


def test_as_of_join_against_brute_force(spark):
    """Seconds matter; one entity has a third of all rows and spans many slices."""
    rng = random.Random(6)
    start = datetime(2024, 1, 1)
    who = lambda: rng.choice(["hot", "hot", "a", "b", "c", "d"])
    features = list({(u, t): (u, t, n) for u, t, n in ((who(), start + timedelta(seconds=rng.randrange(4000)), n) for n in range(400))}.values())
    features += [(None, start, -1), ("a", None, -2)]
    labels = [(rng.choice([who(), "never", None]), rng.choice([start + timedelta(seconds=rng.randrange(4200)), None]), n) for n in range(600)]
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled"), spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "17")
    try:
        known = spark.createDataFrame(features, "user_id string, feature_ts timestamp, score int")
        asked = spark.createDataFrame(labels, "user_id string, label_ts timestamp, label int")
        found = {r.label: (r.feature_ts, r.score) for r in views.as_of_join(asked, known, ("user_id",), ttl_sec=30).collect()}
        empty = views.as_of_join(asked, known.limit(0), ("user_id",), ttl_sec=30).collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before[0])
        spark.conf.set("spark.sql.shuffle.partitions", before[1])
    assert len(empty) == len(labels) and all(r.score is None for r in empty)
    for user, at, label in labels:
        held = [(t, n) for u, t, n in features if at and user and u == user and t and at - timedelta(seconds=30) <= t <= at]
        assert found[label] == (max(held) if held else (None, None))


def test_days_of_a_span_are_cut_before_they_are_exploded(spark):
    labels = spark.createDataFrame([("u", datetime(2024, 1, 5))], "user_id string, label_ts timestamp")
    snapshots = spark.createDataFrame([("u", f"2024-01-{d:02d}", d) for d in range(1, 28)], "user_id string, date string, score int")
    plan = views.point_in_time_join(labels, snapshots, ("user_id",), ttl_days=3)._jdf.queryExecution().optimizedPlan().toString()
    assert "Generate explode(filter(" in plan


def test_scratch_tables_free_what_they_replace(spark, tmp_path):
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, None)
    counted = spark.range(1000).groupBy((F.col("id") % 7).alias("k")).agg(F.count("*").alias("n"))
    first, second = scratch.write_table(counted, "freed-a"), scratch.write_table(counted, "freed-b")
    assert spark.conf.get(key, None) == before
    assert first.exceptAll(second).count() == 0 and first.agg(F.sum("n")).first()[0] == 1000
    counted.write.parquet(f"{tmp_path}/outside")
    outside = spark.read.parquet(f"{tmp_path}/outside")
    gone = {*first.inputFiles(), *second.inputFiles()}
    scratch.drop_table(first, second, outside)
    assert gone and not any(Path(urlparse(file).path).exists() for file in gone)
    assert outside.count() == 7
