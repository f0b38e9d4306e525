from __future__ import annotations

import uuid

import pytest
from pyspark.sql import SparkSession

from accountloom.settings import apply_plan_settings, scratch_folder
from accountloom.sources import warehouse


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[8]")
        .appName("accountloom-tests")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield apply_plan_settings(session)
    session.stop()


@pytest.fixture
def folder(spark):
    return scratch_folder(spark, "test")


@pytest.fixture
def database(spark, folder):
    name = f"test_{uuid.uuid4().hex}"
    warehouse.create_database(spark, name, f"{folder}/tables")
    return name
