import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.join(ROOT, "tests"))

from driftwell.session import build_session  # noqa: E402

TESTDATA = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests",
        "local[8]",
        **{
            "spark.sql.shuffle.partitions": "8",
            "spark.driver.memory": "6g",
            "spark.sql.maxMetadataStringLength": "2000",
            "spark.sql.warehouse.dir": "/tmp/driftwell-warehouse",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    return session


@pytest.fixture(scope="session")
def tables_dir():
    return TESTDATA


def rows(frame, *columns):
    """Rows as a sorted list of tuples; nulls sort first."""
    picked = frame.select(*columns) if columns else frame
    return sorted((tuple(r) for r in picked.collect()), key=lambda r: [(v is not None, v) for v in r])
