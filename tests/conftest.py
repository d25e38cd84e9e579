from __future__ import annotations

import os
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))

from postura.session import local_session  # noqa: E402

SF_SMALL = os.environ.get("POSTURA_TEST_SF", "/root/testdata/sf0.001")
SF_ORACLE = os.environ.get("POSTURA_ORACLE_SF", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    s = local_session(cores=4, shuffle_partitions=8, app="postura-tests")
    s.conf.set("spark.sql.maxMetadataStringLength", "1000")  # plans name their tables in full
    yield s
    s.stop()


@pytest.fixture(scope="session")
def driver_tables(spark):
    from testsupport.driver_fixture import posture_from_driver

    return posture_from_driver(spark, SF_SMALL)
