"""One local session for all tests."""

from __future__ import annotations

import os
import shutil
import sys
import tempfile

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    root = tempfile.mkdtemp(prefix="registry_lens_tests_")
    session = (
        SparkSession.builder.master("local[4]")
        .config("spark.sql.shuffle.partitions", "2")
        # a few rows each: compiling code and planning again cost more than they save
        .config("spark.sql.codegen.wholeStage", "false")
        .config("spark.sql.codegen.factoryMode", "NO_CODEGEN")
        .config("spark.sql.adaptive.enabled", "false")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "4g")
        .config("spark.checkpoint.dir", f"file://{root}/shared")
        .config("spark.sql.warehouse.dir", f"{root}/warehouse")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
    shutil.rmtree(root, ignore_errors=True)


@pytest.fixture(scope="session")
def smallest():
    """The smallest generated tables, where they are."""
    path = "/root/testdata/sf0.001"
    if not os.path.isdir(path):
        pytest.skip("no generated tables")
    return path
