from __future__ import annotations

import datetime as dt
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))
sys.path.insert(0, str(Path(__file__).resolve().parent))

from fixtures import write_days, write_hour  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from eventlake.session import local_session

    s = local_session("eventlake-tests", cores=4, shuffle_partitions=4)
    yield s
    s.stop()


@pytest.fixture
def hour_files(tmp_path):
    return [str(write_hour(tmp_path / "raw", dt.date(2024, 1, 1), 0, 10))]


@pytest.fixture
def day_files(tmp_path):
    return write_days(tmp_path / "raw", dt.date(2024, 1, 1), days=1, hours=3, per_hour=5)


@pytest.fixture(scope="session")
def month_lake(spark, tmp_path_factory):
    """30 days x 4 hours x 5 events landed, refined and modelled once."""
    from eventlake.plans.medallion import LakePaths, build_gold, bronze_to_silver
    from eventlake.sources.bronze import land

    root = tmp_path_factory.mktemp("month")
    files = write_days(root / "raw", dt.date(2024, 1, 1), days=30, hours=4, per_hour=5)
    paths = LakePaths(str(root / "lake"))
    land(spark, files, paths.bronze, paths.ledger)
    bronze_to_silver(spark, paths)
    build_gold(spark, paths)
    return paths
