"""Shared session and rows."""

from __future__ import annotations

import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from risklake.session import ROCKSDB_PROVIDER, get_session  # noqa: E402

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = get_session(
        "risklake-tests", "local[8]",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.ui.enabled": "false",
            "spark.driver.memory": "6g",
            "spark.driver.host": "127.0.0.1",
            "spark.driver.bindAddress": "127.0.0.1",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
            "spark.sql.streaming.stateStore.providerClass": ROCKSDB_PROVIDER,
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture()
def txns(spark):
    from risklake.sources.events import transactions

    return transactions(spark, SF_DIR)
