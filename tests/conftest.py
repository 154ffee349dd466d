from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from reviewloom.session import get_session  # noqa: E402
from reviewloom.staging import release  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = get_session(
        "tests",
        "local[8]",
        **{"spark.sql.shuffle.partitions": "2", "spark.ui.enabled": "false", "spark.driver.memory": "4g"},
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    release(session)
    session.stop()


@pytest.fixture(scope="session")
def ranked(spark):
    """25 reviews: two well covered products in meta-category 0, one scarce in 1."""
    rows = []
    for asin, rating in (("B001", 5.0), ("B002", 1.0)):
        rows += [(0, "Electronics", asin, rating, 10 - i, f"{asin} review {i}", f"{asin}-{i:02d}") for i in range(10)]
    rows += [(1, "Books", "B003", 3.0, 5, f"B003 review {i}", f"B003-{i:02d}") for i in range(5)]
    return spark.createDataFrame(
        rows,
        "meta_category int, category string, asin string, rating double, helpful_vote long, text string, review_id string",
    )
