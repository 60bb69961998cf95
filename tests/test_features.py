import random
from collections import Counter, defaultdict

import pytest
from conftest import DAY, NEWEST, SF, event
from pyspark.sql import Row
from pyspark.sql import functions as F

from cartwheel.functions.skew import range_slices, running
from cartwheel.functions.windows import event_clock
from cartwheel.operators import cleaning, entities, items, pairs, users
from cartwheel.plans.queries import QUERIES


def silver(events_of, *rows):
    events = cleaning.silver_events(events_of(*rows))
    return events, event_clock(events)


def by_key(df, key):
    return {r[key]: r for r in df.collect()}


def test_single_event_user_has_no_deviation_and_zero_rates(events_of):
    events, clock = silver(events_of, event(event_type="purchase"))
    user = users.user_features(events, clock).first()
    assert user.user_price_std_30d is None
    assert (user.user_view_to_cart_rate_30d, user.user_cart_to_purchase_rate_30d) == (0.0, 0.0)
    assert user.user_time_since_last_view_sec is None
    assert user.user_time_since_last_purchase_sec == 0
    assert (user.user_top_category_1, user.user_top_category_2) == ("Books", None)


def test_user_without_categories_counts_zero(events_of):
    events, clock = silver(events_of, event(category_path=None), event(user_id="u2", category_path=[]))
    found = by_key(users.user_features(events, clock), "user_id")
    assert {u: r.user_distinct_categories_viewed_30d for u, r in found.items()} == {"u1": 0, "u2": 0}
    assert found["u1"].user_top_category_1 is None


def test_equal_counts_rank_by_name(events_of):
    events, clock = silver(events_of, event(category_path=["C", "A", "B", "D"]))
    user = users.user_top_categories(events, clock).first()
    assert (user.user_top_category_1, user.user_top_category_2, user.user_top_category_3) == ("A", "B", "C")


def test_users_outside_the_window_are_absent_but_history_counts(events_of):
    events, clock = silver(
        events_of,
        event(),
        event(ts=NEWEST - 40 * DAY, session_id="s0", event_type="purchase"),
        event(user_id="gone", ts=NEWEST - 40 * DAY),
    )
    found = by_key(users.user_features(events, clock), "user_id")
    assert found.keys() == {"u1"}
    assert found["u1"].user_days_since_first_event == 40.0
    assert found["u1"].user_purchases_30d == 0
    assert found["u1"].user_time_since_last_purchase_sec == 40 * 86400
    assert found["u1"].user_avg_session_length_events_30d == 1.0


def test_no_recent_session_is_null_not_zero(events_of):
    events, clock = silver(events_of, event(), event(user_id="u2", ts=NEWEST - 8 * DAY))
    found = by_key(users.user_features(events, clock), "user_id")
    assert (found["u1"].user_sessions_7d, found["u2"].user_sessions_7d) == (1, None)


def test_sessions_ending_together_take_the_greatest_id(events_of):
    events, clock = silver(
        events_of, event(session_id="a"), event(session_id="b", ts=NEWEST - 5), event(session_id="b", item_id="i2")
    )
    assert users.user_last_session(events, clock).first().user_events_last_session == 2


def test_wall_clock_recency(events_of):
    events = cleaning.silver_events(events_of(event()))
    clock = event_clock(events, as_of=F.current_timestamp())
    assert users.user_recency(events, clock).first().user_time_since_last_event_sec > 0


def test_fused_features_equal_the_single_operators(spark):
    events = cleaning.silver_events(QUERIES["s1_bronze_scan"](spark, SF).withColumn("category_path", F.split("category_path", " > ")))
    clock = event_clock(events)
    fused = users.user_features(events, clock, days=10)
    single = [
        users.user_conversion(users.user_volume(events, clock, 10)),
        users.user_diversity(events, clock, 10),
        users.user_monetary(events, clock, 10),
        users.user_sessions(events, clock, 10),
        users.user_device_mix(events, clock, 10),
        users.user_temporal_mix(events, clock, 10),
        users.user_top_categories(events, clock, 10),
    ]
    wide = by_key(fused, "user_id")
    for part in single:
        rows = part.collect()
        assert len(rows) == len(wide)
        for row in rows:
            for name, value in row.asDict().items():
                assert wide[row.user_id][name] == (pytest.approx(value) if isinstance(value, float) else value)


def test_shares_counts_and_categories_are_consistent(spark):
    for row in QUERIES["u14_user_features_10d_window"](spark, SF).collect():
        shares = [v for k, v in row.asDict().items() if "_share_" in k]
        assert all(0.0 <= s <= 1.0 for s in shares)
        assert row.user_views_30d + row.user_add_to_cart_30d + row.user_purchases_30d == row.user_total_events_30d
        top = [row[f"user_top_category_{i}"] for i in (1, 2, 3)]
        assert len(set(top)) == 3


def test_item_never_viewed(events_of):
    events, clock = silver(events_of, event(event_type="purchase"), event(event_type="purchase", user_id="u2"))
    item = items.item_features(events, entities.silver_items(events), clock).first()
    assert (item.item_ctr_30d, item.item_distinct_users_viewed_30d, item.item_distinct_users_purchased_30d) == (0.0, 0, 2)
    assert item.item_time_since_last_view_sec is None


def test_item_depth_of_missing_and_empty_paths(events_of):
    events, _ = silver(events_of, event(category_path=None), event(item_id="i2", category_path=[]))
    depths = {r.item_id: r.item_category_depth for r in items.item_content(entities.silver_items(events)).collect()}
    assert depths == {"i1": None, "i2": 0}


def test_popularity_is_scaled_to_the_busiest_label(events_of):
    events, clock = silver(
        events_of,
        event(),
        event(user_id="u2"),
        event(item_id="i2", category_path=["Home"]),
        event(item_id="i3", category_path=None),
    )
    found = items.item_category_popularity(events, entities.silver_items(events), clock).collect()
    assert {r.item_id: r.item_category_popularity_30d for r in found} == {"i1": 1.0, "i2": 0.5, "i3": 0.0}


def random_rows(n, seed=7):
    rng = random.Random(seed)
    kinds = ["view", "add_to_cart", "purchase"]
    return [
        event(
            # one user and one session hold most rows; times repeat
            user_id=rng.choice(["hot"] * 6 + ["u1", "u2", "u3"]),
            session_id=rng.choice(["big"] * 6 + ["s1", "s2"]),
            item_id=f"i{rng.randrange(12)}",
            event_type=rng.choice(kinds),
            price=float(rng.randrange(1, 50)),
            ts=NEWEST - rng.randrange(40) * 1000,
            category_path=rng.choice([["A", "B"], ["B"], ["C"], None, []]),
        )
        for _ in range(n)
    ]


def expected_context(base):
    """ui_session_context by brute force."""
    sessions = defaultdict(list)
    for row in base:
        sessions[row.session_id].append((row.ts, row.item_id, row.event_type, row.user_id))
    met = defaultdict(lambda: [0, 0])
    for session, rows in sessions.items():
        for position, (_, item, _, user) in enumerate(sorted(rows), start=1):
            entry = met[(user, item, session)]
            entry[0] += 1
            entry[1] = max(entry[1], position)
    best = {}
    for (user, item, session), (count, position) in met.items():
        best[(user, item)] = max(best.get((user, item), (0, "", 0)), (count, session, position))
    return {pair: (position, count) for pair, (count, _, position) in best.items()}


@pytest.fixture
def many_slices(spark):
    """Slices are as many as shuffle partitions, however small."""
    before = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    spark.conf.set("spark.sql.shuffle.partitions", "13")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def test_positions_in_sessions_that_span_slices(events_of, many_slices):
    events, _ = silver(events_of, *random_rows(400))
    base = pairs.base_pairs(events)
    slices = pairs.session_slices(base)
    assert slices.filter("session_id = 'big'").select("_slice").distinct().count() > 5
    found = {(r.user_id, r.item_id): (r.ui_position_in_session, r.ui_session_event_count) for r in pairs.ui_session_context(slices).collect()}
    assert found == expected_context(base.collect())


def test_positions_in_a_hot_null_session(events_of, many_slices):
    """Rows without a session are one group like any other, and are split like it."""
    events, _ = silver(events_of, *random_rows(300, seed=8))
    base = pairs.base_pairs(events).withColumn("session_id", F.when(F.col("session_id") != "big", F.col("session_id")))
    slices = pairs.session_slices(base)
    assert slices.filter("session_id IS NULL").select("_slice").distinct().count() > 5
    rows = [r.asDict() for r in pairs.session_positions(slices).collect()]
    sessions = defaultdict(list)
    for r in rows:
        sessions[r["session_id"]].append((r["ts"], r["item_id"], r["event_type"], r["user_id"], r["pos"]))
    assert len(rows) == base.count() and None in sessions
    for members in sessions.values():
        assert [m[-1] for m in sorted(members)] == list(range(1, len(members) + 1))
    named = [Row(**{**r, "session_id": r["session_id"] or ""}) for r in rows]
    found = {(r.user_id, r.item_id): (r.ui_position_in_session, r.ui_session_event_count) for r in pairs.ui_session_context(slices).collect()}
    assert found == expected_context(named)
    latest = pairs.ui_session_context_spec(slices).collect()
    assert len(latest) == len(found) and max(r.ui_session_event_count for r in latest) == len(sessions[None])


def test_running_sums_and_checksums(spark, many_slices):
    rng = random.Random(3)
    rows = [(rng.choice([None, 1, 1, 1, 2]), k, rng.randrange(100)) for k in range(500)]
    slices = range_slices(spark.createDataFrame(rows, "g int, at int, x long"), ["g"], ["at"])
    out = running(slices, ["g"], ["at"], sums={"total": F.col("x"), "n": F.lit(1)}, xors={"check": F.col("x")}).collect()
    expected, state = {}, defaultdict(lambda: [0, 0, 0])
    for g, at, x in rows:
        s = state[g]
        s[:] = [s[0] + x, s[1] + 1, s[2] ^ x]
        expected[at] = tuple(s)
    assert {r.at: (r.total, r.n, r.check) for r in out} == expected and len(out) == len(rows)


def test_pair_features_for_seen_and_unseen_pairs(spark, events_of):
    events, clock = silver(events_of, *random_rows(300), event(user_id="new", item_id="i99", ts=NEWEST - 40 * DAY))
    user_side = users.user_features(events, clock)
    item_side = items.item_features(events, entities.silver_items(events), clock)
    wanted = spark.createDataFrame([("u1", f"i{n}") for n in range(12)] + [("nobody", "i1")], "user_id string, item_id string")
    counts = Counter((r.user_id, r.item_id) for r in pairs.base_pairs(events).collect())
    rows = pairs.cross_features(events, user_side, item_side, clock, wanted).collect()
    assert {r.item_id for r in rows} == {f"i{n}" for n in range(12)} and {r.user_id for r in rows} == {"u1"}
    for row in rows:
        co = [row.ui_user_item_co_views_30d, row.ui_user_item_co_carts_30d, row.ui_user_item_co_purchases_30d]
        if counts[("u1", row.item_id)]:
            assert sum(co) == counts[("u1", row.item_id)]
        else:
            assert co == [None] * 3
            assert (row.ui_user_item_exploration_score, row.ui_recency_bucket) == (1.0, 3)
            assert row.ui_position_in_session is None


def test_counts_outside_the_window_are_null_but_recency_stays(events_of):
    events, clock = silver(events_of, event(), event(item_id="i2"), event(user_id="u2", item_id="i2", ts=NEWEST - 40 * DAY), event(user_id="u2"))
    user_side = users.user_features(events, clock)
    item_side = items.item_features(events, entities.silver_items(events), clock)
    rows = {(r.user_id, r.item_id): r for r in pairs.cross_features(events, user_side, item_side, clock).collect()}
    old = rows[("u2", "i2")]
    assert old.ui_user_item_co_views_30d is None
    assert old.ui_time_since_user_last_interaction_with_item_sec == 40 * 86400
    assert rows[("u1", "i1")].ui_recency_bucket == 0


def test_category_flags(spark):
    schema = "user_id string, user_top_category_1 string, user_top_category_2 string, user_top_category_3 string"
    user_side = spark.createDataFrame([("u", "A", "B", None), ("v", None, None, None)], schema)
    item_side = spark.createDataFrame(
        [("first", ["A", "X"]), ("inside", ["X", "A"]), ("second", ["B"]), ("empty", []), ("none", None)],
        "item_id string, category_path array<string>",
    )
    wanted = spark.createDataFrame(
        [(u, i) for u in "uv" for i in ("first", "inside", "second", "empty", "none")], "user_id string, item_id string"
    )
    flags = {
        (r.user_id, r.item_id): (r.ui_same_category_flag, r.ui_same_top_category_flag)
        for r in pairs.ui_category_match(wanted, user_side, item_side).collect()
    }
    assert flags == {
        **{("v", i): (0, 0) for i in ("first", "inside", "second", "empty", "none")},
        ("u", "first"): (1, 1),
        ("u", "inside"): (1, 0),
        ("u", "second"): (0, 0),
        ("u", "empty"): (0, 0),
        ("u", "none"): (0, 0),
    }
    top3 = {
        (r.user_id, r.item_id): r.ui_same_category_flag
        for r in pairs.ui_category_match_top3(wanted, user_side, item_side).collect()
    }
    assert {k for k, v in top3.items() if v} == {("u", "first"), ("u", "inside"), ("u", "second")}


def test_affinities_sum_to_one_over_a_users_labels(events_of):
    events, clock = silver(events_of, *[e for e in random_rows(200) if e["category_path"]])
    listed = entities.silver_items(events)
    affinity = pairs.ui_category_affinity(pairs.observed_pairs(events), events, listed, clock)
    labelled = affinity.join(listed.select("item_id", F.element_at("category_path", 1).alias("label")), "item_id")
    per_user = labelled.select("user_id", "label", "ui_category_affinity_score").distinct()
    for row in per_user.groupBy("user_id").agg(F.sum("ui_category_affinity_score").alias("s")).collect():
        assert row.s == pytest.approx(1.0)
