import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
sys.path.insert(0, str(Path(__file__).resolve().parent))

from tillwright.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory) -> SparkSession:
    session = build_session(
        "tests", "local[4]",
        {
            "spark.sql.shuffle.partitions": "4",
            "spark.ui.enabled": "false",
            "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture()
def namespace(spark, tmp_path):
    """A schema of its own for one test."""
    from tillwright.sources.tables import ensure_namespace

    name = "t_" + tmp_path.name.replace("-", "_")
    ensure_namespace(spark, name, str(tmp_path / "schema"))
    return name


@pytest.fixture()
def rows_of():
    return lambda df: sorted((tuple(r) for r in df.collect()), key=repr)
