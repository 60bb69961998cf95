"""What the plans must keep: pruned scans, pushed filters, no products, limits before shuffles."""

import pytest
from conftest import SF

from cartwheel.functions.windows import event_clock
from cartwheel.operators import cleaning, entities, items, pairs, users
from cartwheel.plans.retail_tables import raw_events
from cartwheel.scratch import new_path, write_table
from cartwheel.sources import tables


def plan(df) -> str:
    return df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")


@pytest.fixture(scope="module")
def events(spark):
    path = new_path(spark, "silver")
    tables.write_silver_events(cleaning.silver_events(raw_events(spark, SF)), path)
    return tables.table_scan(spark, path)


@pytest.fixture(scope="module")
def clock(events):
    return event_clock(events, date_partitioned=True)


def test_cleaning_filters_reach_the_scan(spark):
    raw = write_table(raw_events(spark, SF), "raw")
    text = plan(cleaning.silver_events(raw))
    pushed = next(line for line in text.splitlines() if "PushedFilters" in line)
    for condition in ("IsNotNull(user_id)", "IsNotNull(item_id)", "IsNotNull(ts)", "GreaterThan(price,0.0)"):
        assert condition in pushed


def test_scans_read_only_what_they_need(events, clock):
    text = plan(users.user_monetary(events, clock))
    schemas = {line for line in text.splitlines() if "ReadSchema" in line}
    assert any("struct<user_id:string,price:double,ts:timestamp>" in s for s in schemas)
    assert not any("category_path" in s or "referrer" in s for s in schemas)


def test_the_window_prunes_partitions_and_the_anchor_reads_one_day(events, clock):
    text = plan(users.user_monetary(events, clock))
    filters = [line for line in text.splitlines() if "PartitionFilters" in line]
    assert any("event_date" in line and ">=" in line for line in filters)
    assert any("event_date" in line and " = " in line for line in filters)


def test_top_categories_are_cut_before_the_shuffle(events, clock):
    assert plan(users.user_top_categories(events, clock)).count("WindowGroupLimit") >= 2


def test_no_plan_multiplies_rows(events, clock):
    listed = write_table(entities.silver_items(events), "items")
    user_side, item_side = users.user_features(events, clock), items.item_features(events, listed, clock, declared_only=True)
    for df in (
        user_side,
        item_side,
        pairs.cross_features(events, user_side, item_side, clock),
        pairs.ui_category_affinity(pairs.observed_pairs(events), events, listed, clock),
    ):
        text = plan(df)
        assert "CartesianProduct" not in text and "NestedLoop" not in text


def test_distinct_users_do_not_expand_rows(events, clock):
    assert "Expand" not in plan(items.item_distinct_users(events, clock))
