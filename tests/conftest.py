import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from voxmill.session import build_session

    shared = tmp_path_factory.mktemp("shared")
    session = build_session("voxmill-tests", "local[*]", **{
        "spark.sql.shuffle.partitions": 8, "spark.ui.enabled": "false",
        "spark.checkpoint.dir": str(shared), "spark.driver.memory": "4g",
        "spark.sql.session.timeZone": "UTC"})
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def rows(df, *columns):
    return sorted(tuple(r) for r in (df.select(*columns) if columns else df).collect())
