import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from grainmill.session import build_session, drop_scratch


@pytest.fixture(scope="session")
def spark():
    session = build_session("tests", 8, 4)
    yield session
    drop_scratch(session)
    session.stop()


@pytest.fixture
def no_broadcast(spark):
    """Make every table too large to broadcast, as on a big cluster."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def rows(df, *order):
    return sorted(tuple(r) for r in df.select(*(order or df.columns)).collect())
