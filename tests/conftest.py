from __future__ import annotations

import os
import sys

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[4]")
        .appName("citeloom-tests")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("checkpoints")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def write_lines(tmp_path):
    import json

    def write(name, rows):
        path = tmp_path / name
        path.write_text(
            "".join((r if isinstance(r, str) else json.dumps(r)) + "\n" for r in rows),
            encoding="utf-8",
        )
        return str(path)

    return write


@pytest.fixture
def scratch(spark):
    from citeloom.scratch import Scratch

    kept = Scratch(spark, "test")
    yield kept
    kept.close()
