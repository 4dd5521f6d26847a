import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[4]")
        .appName("threatlens-tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def make_logs(spark):
    """Builds log rows from overrides of a plain default row."""
    from threatlens.schema import LOG_COLUMNS, LOG_FILE

    def build(*rows: dict, repeat: int = 1):
        import datetime as dt

        defaults = {
            "timestamp": dt.datetime(2023, 10, 15, 14, 0),
            "source_ip": "192.168.1.100",
            "dest_ip": "10.0.0.1",
            "protocol": "TCP",
            "action": "allowed",
            "threat_label": "benign",
            "log_type": "firewall",
            "bytes_transferred": 1024,
            "user_agent": "Mozilla/5.0",
            "request_path": "/index.html",
        }
        data = [{**defaults, **row} for row in rows for _ in range(repeat)]
        return spark.createDataFrame([tuple(r[c] for c in LOG_COLUMNS) for r in data], LOG_FILE)

    return build
