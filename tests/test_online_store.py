"""The compacted online log against a plain reading of everything written."""

import random

import pytest
from test_streams import online_rows

from cartwheel.scratch import new_path
from cartwheel.sources import online

DAY_MS = 86_400_000


@pytest.fixture
def store(spark):
    return online.OnlineStore(spark, new_path(spark, "store"), buckets=3)


def plain(batches, as_of):
    """batches: {(writer, batch): [(user, score, stamp, ttl)]}."""
    best = {}
    for (writer, batch), rows in batches.items():
        for user, score, stamp, ttl in rows:
            best[user] = max(best.get(user, ()), (stamp, batch, writer, score, ttl))
    return {f"k:{u}": (stamp, score) for u, (stamp, _, _, score, ttl) in best.items() if stamp + ttl * 1000 > as_of}


def live(rows):
    return {r.key: (r.updated_at_ms, int(r.value.split('"score":')[1].split(",")[0])) for r in rows.collect()}


def put(spark, store, batches, writer, batch, rows):
    batches[writer, batch] = rows
    for ttl in {r[3] for r in rows}:
        assert len({r[3] for r in rows}) == 1
        store.upsert(online_rows(spark, [r[:3] for r in rows], ttl=ttl), batch, writer)


def test_write_compact_write_read(spark, store):
    rng, batches = random.Random(2), {}
    assert store.read(0).count() == 0 and store.generation() == 0
    for number in range(8):
        rows = [(f"u{rng.randrange(12)}", rng.randrange(1000), 1000 * (rng.randrange(60) + 5 * number)) for _ in range(9)]
        put(spark, store, batches, f"w{number % 3}", number // 2, [(*r, [20, 90][number % 2]) for r in rows])
        if number % 3 == 2:
            store.compact(as_of_ms=40_000)
            store.vacuum()
        for as_of in (40_000, 55_000):
            assert live(store.read(as_of)) == plain(batches, as_of)
    assert store.generation() == 2
    keys = spark.createDataFrame([("k:u1",), ("k:u7",), ("k:none",)], "key string")
    assert live(store.lookup(keys, 40_000)) == {k: v for k, v in plain(batches, 40_000).items() if k in ("k:u1", "k:u7")}


@pytest.mark.parametrize("step", ["covered", "pointer"])
def test_a_compaction_that_stops_half_way_loses_nothing(spark, store, monkeypatch, step):
    batches = {}
    put(spark, store, batches, "w", 0, [("a", 1, 1000, 60), ("b", 1, 1000, 60)])
    store.compact(as_of_ms=2000)
    put(spark, store, batches, "w", 1, [("a", 2, 3000, 60)])

    def stop(*_):
        raise RuntimeError("stopped")

    with monkeypatch.context() as patch:
        patch.setattr(store, "_point_to" if step == "pointer" else "_bucket", stop)
        with pytest.raises(RuntimeError):
            store.compact(as_of_ms=4000)
    assert store.generation() == 1 and live(store.read(4000)) == plain(batches, 4000)
    put(spark, store, batches, "w", 2, [("b", 3, 3500, 60)])
    assert store.compact(as_of_ms=4000) == 2
    store.vacuum()
    assert live(store.read(4000)) == plain(batches, 4000) == {"k:a": (3000, 2), "k:b": (3500, 3)}


def test_a_batch_that_arrives_during_a_compaction_stays(spark, store, monkeypatch):
    batches = {}
    put(spark, store, batches, "w", 0, [("a", 1, 1000, 60)])
    point = store._point_to

    def late(generation):
        put(spark, store, batches, "w", 1, [("a", 2, 2000, 60), ("c", 9, 1500, 60)])
        point(generation)

    monkeypatch.setattr(store, "_point_to", late)
    store.compact(as_of_ms=1000)
    assert live(store.read(3000)) == plain(batches, 3000)
    # a retried batch that the base already covers changes nothing
    store.upsert(online_rows(spark, [("a", 1, 1000)]), 0, "w")
    assert live(store.read(3000)) == plain(batches, 3000)


def test_an_expired_row_still_hides_an_older_one_that_comes_late(spark, store):
    batches = {}
    put(spark, store, batches, "w", 0, [("a", 1, 10_000, 1)])
    store.compact(as_of_ms=20_000)
    put(spark, store, batches, "w", 1, [("a", 2, 5_000, 3600)])
    assert live(store.read(20_000)) == plain(batches, 20_000) == {}
    store.compact(as_of_ms=20_000 + 30 * DAY_MS)
    assert store.log().count() == 0  # both have been over for longer than a batch may come late


def test_newest_times_are_hashed_and_payloads_are_not_sorted_for_them(spark, store):
    store.upsert(online_rows(spark, [("a", 1, 1000)]), 0)
    plan = online.online_read(online.online_log(spark, f"{store.path}/batches"), 0)._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate(keys=[key" in plan and plan.count("SortAggregate") <= 2
