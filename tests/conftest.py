from __future__ import annotations

import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))
sys.path.insert(0, str(ROOT / "tests"))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from pyspark.sql import SparkSession

    from panelcast.session import prepare

    session = (
        SparkSession.builder.master("local[4]")
        .appName("panelcast-tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .config("spark.sql.warehouse.dir", str(tmp_path_factory.mktemp("warehouse")))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "4g")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield prepare(session)
    session.stop()


@pytest.fixture(scope="session")
def panel(spark):
    """Build a panel from {series: [values]} on an hourly, daily or monthly grid."""
    from datetime import datetime, timedelta

    from panelcast.schema import SERIES

    def build(series: dict, seconds: int = 3600, start: datetime = datetime(2024, 1, 1), months: bool = False):
        rows = []
        for sid, values in series.items():
            for i, x in enumerate(values):
                if months:
                    ts = datetime(start.year + (start.month - 1 + i) // 12, (start.month - 1 + i) % 12 + 1, 1)
                else:
                    ts = start + timedelta(seconds=seconds * i)
                rows.append((sid, ts, None if x is None else float(x)))
        return spark.createDataFrame(rows, SERIES)

    return build
