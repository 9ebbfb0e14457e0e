import pytest
from pyspark.sql import SparkSession

from quadweld.operators import stage


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[4]")
        # Tables of a few rows: compiling and re-planning would take most of the time.
        .config("spark.sql.shuffle.partitions", "3")
        .config("spark.sql.codegen.wholeStage", "false")
        .config("spark.sql.codegen.factoryMode", "NO_CODEGEN")
        .config("spark.sql.adaptive.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "4g")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def everything_heavy(monkeypatch):
    """Treat small tables as if they were huge: keys get salted, nothing is small."""
    monkeypatch.setattr(stage, "HEAVY_FLOOR", 1)
    monkeypatch.setattr(stage, "HEAVY_SHARE", 0.05)
    monkeypatch.setattr(stage, "SALTS", 3)
    monkeypatch.setattr(stage, "CELL_ROWS", 2)
    monkeypatch.setattr(stage, "BROADCAST_ROWS", -1)
