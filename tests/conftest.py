import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[4]")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.driver.memory", "4g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .config("spark.sql.warehouse.dir", str(tmp_path_factory.mktemp("warehouse")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def workspace(spark):
    from rankloom.sources.workspace import Workspace

    return Workspace(spark)


@pytest.fixture(scope="session")
def small_corpus(spark):
    """Repeated terms, a term in every document, an empty document, equal documents."""
    docs = {
        1: "common apple apple banana",
        2: "common banana cherry",
        3: "common cherry cherry cherry apple",
        4: "common",
        5: "",
        6: "common banana cherry",
        7: "common durian durian elder fig",
        8: "the and of",
    }
    queries = {
        0: "apple banana",
        1: "apple apple cherry",
        2: "unknown durian",
        3: "the of and",
        4: "",
        5: "common",
        6: "nowhere",
        7: "  Cherry CHERRY common elder ",
    }
    return docs, queries
