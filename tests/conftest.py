import os
import sys
import time

import pytest

# Times come back to Python in the machine's zone.
os.environ["TZ"] = "UTC"
time.tzset()

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tickwatch.settings import session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    own = session(
        "tickwatch-tests",
        "local[4]",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.driver.memory": "4g",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
        },
    )
    own.sparkContext.setLogLevel("ERROR")
    yield own
    own.stop()


@pytest.fixture(scope="module", autouse=True)
def nothing_cached_before(spark):
    """Tables that one module's tests left cached are not there in the next."""
    spark.catalog.clearCache()


@pytest.fixture(scope="session")
def texts(spark):
    """Make ticks of (seq, ingest ms, text) rows."""
    from pyspark.sql import functions as F

    def make(rows):
        df = spark.createDataFrame(rows, "seq BIGINT, ingest_ms BIGINT, value STRING")
        return df.select("seq", F.timestamp_millis("ingest_ms").alias("ingest_time"), "value")

    return make
