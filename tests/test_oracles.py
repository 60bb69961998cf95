"""Every registered query beside its SQL twin, over whole tables."""

import pytest
from compare import differences, duck
from conftest import SF

from __spark_entry__ import entry
from cartwheel.plans.oracle import ORACLES
from cartwheel.plans.queries import QUERIES

ROWS_ONLY = {"u13_user_embedding", "i9_item_embedding", "x6_ui_similarity_fitted", "x6_ui_similarity_shared_fit"}


@pytest.fixture(scope="module")
def con():
    return duck(SF)


def test_only_fitted_embeddings_lack_a_twin():
    assert QUERIES.keys() - ORACLES.keys() == ROWS_ONLY
    assert not ORACLES.keys() - QUERIES.keys()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_its_twin(spark, con, name):
    ours = QUERIES[name](spark, SF).toArrow()
    assert ours.num_rows > 0
    if name not in ROWS_ONLY:
        assert differences(ours, con.sql(ORACLES[name]).to_arrow_table()) is None


def test_entry_returns_features(spark):
    assert "user_total_events_30d" in entry(spark).columns
