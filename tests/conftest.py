import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path[:0] = [str(ROOT), str(ROOT / "tests")]

from session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    spark = local_session(**{"spark.sql.shuffle.partitions": "4"})
    yield spark
    spark.stop()


@pytest.fixture
def conf(spark):
    """Sets session options for one test."""
    before = {}

    def set_conf(key, value):
        before.setdefault(key, spark.conf.get(key, None))
        spark.conf.set(key, value)

    yield set_conf
    for key, value in before.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)
