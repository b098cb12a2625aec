from __future__ import annotations

import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path[:0] = [str(ROOT), str(ROOT / "tests")]

from fleetgauge.session import build_session  # noqa: E402
from fleetgauge.sources.dimensions import rate_card, tenant_table  # noqa: E402
from telemetry import TENANTS  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests", "local[4]",
        **{"spark.sql.shuffle.partitions": "4", "spark.ui.enabled": "false", "spark.driver.memory": "4g"},
    )
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def tenants(spark):
    return tenant_table(spark, TENANTS)


@pytest.fixture(scope="session")
def rates(spark):
    return rate_card(spark)
