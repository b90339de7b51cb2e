from __future__ import annotations

import os
import sys
from datetime import datetime

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tradeglass.config import ExchangeConfig  # noqa: E402
from tradeglass.session import prepare  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[4]")
        .appName("tests")
        .config("spark.sql.shuffle.partitions", "2")
        # Tiny inputs: compiling code for each plan would take most of the time.
        .config("spark.sql.codegen.wholeStage", "false")
        .config("spark.sql.codegen.factoryMode", "NO_CODEGEN")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "4g")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("checkpoints")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield prepare(session)
    session.stop()


@pytest.fixture
def config():
    return ExchangeConfig(native_asset="NAT", stable_assets=("USD",), blocked_assets=("BAD",))


@pytest.fixture
def table(spark):
    """Rows of a target table: missing columns are null."""
    from tradeglass.schemas import schema_of

    def build(name: str, rows: list[dict]):
        schema = schema_of(name)
        return spark.createDataFrame([tuple(row.get(f.name) for f in schema) for row in rows], schema)

    return build


@pytest.fixture
def trades(spark):
    """Trades from (id, base, quote, price, quantity, volume_quote, volume, timestamp)."""
    from tradeglass.schemas import PRICE, VOLUME

    def build(rows: list[tuple]):
        raw = spark.createDataFrame(
            [(i, b, q, str(p), str(n), str(vq), None if v is None else str(v), ts) for i, b, q, p, n, vq, v, ts in rows],
            "trade_id bigint, base_asset_id string, quote_asset_id string, price string, quantity string, "
            "volume_quote string, volume string, timestamp timestamp",
        )
        kinds = dict(price=PRICE, quantity=PRICE, volume_quote=PRICE, volume=VOLUME)
        return raw.select(*[raw[c].cast(kinds[c]).alias(c) if c in kinds else raw[c] for c in raw.columns])

    return build


def ts(text: str) -> datetime:
    return datetime.fromisoformat(text)
