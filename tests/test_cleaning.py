import pytest
from conftest import NEWEST, event
from pyspark.sql import functions as F

from cartwheel.functions.windows import event_clock, window_bounds
from cartwheel.operators import cleaning, entities


def test_bad_rows_are_dropped_and_categories_lowered(events_of):
    raw = events_of(
        event(event_type="VIEW", device="Web", page="PDP"),
        event(user_id=None),
        event(item_id=None),
        event(session_id=None),
        event(ts=None),
        event(price=0.0),
        event(price=-1.0),
        event(price=None),
        event(event_type="unknown"),
        event(event_type=None),
        event(device="tv"),
        event(device=None),
        event(page="search"),
    )
    kept = cleaning.silver_events(raw).collect()
    assert [(r.event_type, r.device, r.page, r.event_hour) for r in kept] == [("view", "web", "pdp", 0)]
    assert str(kept[0].event_date) == "2024-01-31"


def test_copies_collapse_and_the_smallest_referrer_stays(events_of):
    raw = events_of(
        event(referrer="campaign_2"),
        event(referrer="campaign_1", category_path=["B"]),
        event(referrer="campaign_1", category_path=["A"]),
        event(referrer="campaign_1", category_path=["A"]),
        event(item_id="i2", referrer="x"),
    )
    kept = {r.item_id: (r.referrer, r.category_path) for r in cleaning.silver_events(raw).collect()}
    assert kept == {"i1": ("campaign_1", ["A"]), "i2": ("x", ["Books"])}


def test_null_and_empty_category_paths_survive(events_of):
    raw = events_of(event(category_path=None), event(item_id="i2", category_path=[]))
    kept = {r.item_id: r.category_path for r in cleaning.silver_events(raw).collect()}
    assert kept == {"i1": None, "i2": []}


def test_missing_columns_are_named(events_of):
    raw = events_of(event())
    with pytest.raises(ValueError, match="ts"):
        cleaning.normalize_ts(raw.drop("ts"))
    with pytest.raises(ValueError, match="device, page"):
        cleaning.typed_projection(raw.drop("device", "page"))


def test_unparsable_values_become_null(events_of):
    raw = events_of(event()).withColumn("price", F.lit("cheap"))
    assert cleaning.typed_projection(cleaning.normalize_ts(raw)).first().price is None


def test_timestamps_pass_through(events_of):
    once = cleaning.normalize_ts(events_of(event(ts=NEWEST + 7)))
    assert cleaning.normalize_ts(once).select(F.unix_millis("ts")).first()[0] == NEWEST + 7


def test_contract_report_and_quarantine(events_of):
    raw = events_of(event(), event(price=0.0, device="Web"), event(category_path=None), event(event_type=None))
    report = {r.rule: r.violations for r in cleaning.event_contract_report(raw).collect()}
    assert {k: v for k, v in report.items() if v} == {
        "price_positive": 1,
        "device_known": 1,
        "category_path_present": 1,
        "event_type_known": 1,
    }
    valid, quarantine = cleaning.split_by_contract(raw)
    assert valid.count() == 1
    assert sorted(tuple(r.broken_rules) for r in quarantine.collect()) == [
        ("category_path_present",),
        ("event_type_known",),
        ("price_positive", "device_known"),
    ]


def test_no_events_is_an_error(events_of):
    nothing = cleaning.normalize_ts(events_of(event())).filter("1 = 0")
    with pytest.raises(Exception, match="no events"):
        window_bounds(nothing).collect()
    with pytest.raises(TypeError):
        event_clock(events_of(event()))


def test_cutoff_is_inclusive(events_of):
    day = 86_400_000
    raw = events_of(
        event(),
        event(item_id="on", ts=NEWEST - 30 * day),
        event(item_id="before", ts=NEWEST - 30 * day - 1),
    )
    events = cleaning.silver_events(raw)
    clock = event_clock(events)
    assert {r.item_id for r in clock.recent(events, 30).collect()} == {"i1", "on"}


def test_explicit_anchor_hides_later_events(events_of):
    events = cleaning.silver_events(events_of(event(), event(item_id="old", ts=NEWEST - 86_400_000)))
    clock = event_clock(events, anchor="2024-01-30 12:00:00")
    assert [r.item_id for r in clock.history(events).collect()] == ["old"]


def test_item_attributes_come_from_the_earliest_path(events_of):
    events = cleaning.silver_events(
        events_of(
            event(category_path=None, ts=NEWEST - 2, price=1.0),
            event(category_path=["Home"], ts=NEWEST - 1, price=2.0),
            event(category_path=["Books"], ts=NEWEST, price=6.0),
        )
    )
    item = entities.silver_items(events).first()
    assert (item.category_path, item.base_price, item.title) == (["Home"], 3.0, "Item i1")
    assert (item.description, item.brand) == ("Synthetic description for item i1", "generic_brand")
