import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))

from tickshard.session import builder  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    base = tmp_path_factory.mktemp("spark")
    session = (
        builder(
            **{
                "spark.sql.shuffle.partitions": "4",
                "spark.ui.enabled": "false",
                "spark.ui.showConsoleProgress": "false",
                "spark.driver.memory": "8g",
                "spark.sql.warehouse.dir": str(base / "warehouse"),
                "spark.checkpoint.dir": str(base / "shared"),
            }
        )
        .master("local[8]")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def table_name():
    import uuid

    return f"t_{uuid.uuid4().hex}"
