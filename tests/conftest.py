import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from txnlens.session import build_session  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session("tests", master="local[8]", shuffle_partitions=4, **{
        "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "8g",
        "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared"))})
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def small_folder():
    if not Path(SMALL).exists():
        pytest.skip("given tables are not here")
    return SMALL


@pytest.fixture()
def rows():
    """Collect a frame as sorted tuples."""
    return lambda df: sorted((tuple(r) for r in df.collect()), key=repr)
