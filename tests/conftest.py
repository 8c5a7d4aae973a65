import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from support import at  # noqa: E402
from tickguard.schema import TRANSACTION  # noqa: E402
from tickguard.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session("tests", "local[4]", **{
        "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
        "spark.sql.shuffle.partitions": "4",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": "4g"})
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def trades(spark):
    """Build trades from (symbol, price, seconds) or (symbol, price, seconds, volume)."""
    def build(rows):
        full = [(r[0], None if r[1] is None else float(r[1]), float(r[3]) if len(r) > 3 else 1.0,
                 None if r[2] is None else at(r[2])) for r in rows]
        return spark.createDataFrame(full, TRANSACTION)

    return build
