import datetime as dt
import pathlib
import sys

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(pathlib.Path(__file__).resolve().parents[1]))

from shelfline.schemas import SILVER  # noqa: E402
from shelfline.session import configure  # noqa: E402

RUN = dt.datetime(2026, 4, 4, 11, 6)


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (configure(SparkSession.builder.master("local[8]").appName("tests"))
               .config("spark.sql.shuffle.partitions", "4")
               .config("spark.ui.enabled", "false")
               .config("spark.ui.showConsoleProgress", "false")
               .config("spark.driver.memory", "4g")
               .config("spark.sql.warehouse.dir", str(tmp_path_factory.mktemp("warehouse")))
               .getOrCreate())
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def observations(spark):
    """Silver rows from partial dicts."""
    def make(*given):
        default = {"asin": "A", "title": "t", "price": 10.0, "rating": 4.0, "reviews_count": 5,
                   "in_stock": "in_stock", "category": "C", "source": "s", "source_system": "x",
                   "scraped_at": "2026-04-01T10:00:00.000000+00:00", "processed_at": RUN,
                   "dq_status": "VALID"}
        rows = []
        for row in given:
            row = {**default, **row}
            if "scrape_date" not in row:
                row["scrape_date"] = dt.date.fromisoformat(row["scraped_at"][:10])
            rows.append(tuple(row[name] for name in SILVER.fieldNames()))
        return spark.createDataFrame(rows, SILVER)
    return make


def at(day, hour=10, minute=0, second=0):
    return f"2026-04-{day:02d}T{hour:02d}:{minute:02d}:{second:02d}.000000+00:00"


def counted(frame):
    """The rows of a frame as a multiset, whatever the column order."""
    from collections import Counter
    names = sorted(frame.columns)
    return Counter(tuple(repr(row[name]) for name in names) for row in frame.collect())
