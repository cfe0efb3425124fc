import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from forumlens.runtime import local_session, ship_package  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session(8, "tests", "6g")
    session.sparkContext.setLogLevel("ERROR")
    ship_package(session)
    yield session
    session.stop()


@pytest.fixture
def column(spark):
    """Values of a column expression over literal inputs."""

    def evaluate(build, *rows, schema="value string"):
        width = len(schema.split(","))
        data = [row if width > 1 else (row,) for row in rows]
        df = spark.createDataFrame(data, schema)
        return [r[0] for r in df.coalesce(1).select(build(*[df[c] for c in df.columns])).collect()]

    return evaluate


@pytest.fixture
def folder(tmp_path):
    return str(tmp_path)
