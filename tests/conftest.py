import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path[:0] = [str(ROOT), str(ROOT / "tests")]

from cartwheel.session import build_session  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests",
        "local[8]",
        {
            "spark.sql.shuffle.partitions": "4",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "6g",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


EVENT_SCHEMA = (
    "user_id string, session_id string, item_id string, event_type string, price double, "
    "category_path array<string>, device string, page string, referrer string, ts bigint"
)
# 2024-01-31 00:00:00 UTC
NEWEST = 1706659200000
DAY = 86_400_000


def event(**changes):
    row = {
        "user_id": "u1",
        "session_id": "s1",
        "item_id": "i1",
        "event_type": "view",
        "price": 10.0,
        "category_path": ["Books"],
        "device": "web",
        "page": "home",
        "referrer": None,
        "ts": NEWEST,
    }
    return {**row, **changes}


@pytest.fixture(scope="session")
def events_of(spark):
    """Raw event rows from dicts."""

    def build(*rows):
        return spark.createDataFrame([tuple(r.values()) for r in rows], EVENT_SCHEMA)

    return build
