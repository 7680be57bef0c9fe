import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from tickmart.session import builder  # noqa: E402

DATA = Path("/root/testdata")


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = builder(
        "tests", "local[8]", 2,
        **{"spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false", "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse"))},
    ).getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def small() -> str:
    return str(DATA / "sf0.001")


@pytest.fixture
def tick_frame(spark):
    """Clean-shaped ticks from (coin, time text, price, ...) tuples."""
    def make(data):
        full = [(c, c.upper(), c.title(), t, t, p, 1000, 1, v) for c, t, p, v in data]
        df = spark.createDataFrame(full, "coin_id string, symbol string, name string, crawl_time string, "
                                         "last_updated string, current_price double, market_cap bigint, "
                                         "market_cap_rank int, total_volume bigint")
        return df

    return make
