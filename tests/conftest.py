import os
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
os.environ.setdefault("PYSPARK_PYTHON", sys.executable)


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from millrace.session import build_session

    shared = tmp_path_factory.mktemp("shared")
    session = build_session("tests", "local[4]", 4, **{"spark.checkpoint.dir": str(shared), "spark.driver.memory": "4g", "spark.driver.bindAddress": "127.0.0.1", "spark.driver.host": "127.0.0.1", "spark.sql.warehouse.dir": str(shared / "warehouse")})
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
