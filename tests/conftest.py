import sys
import uuid
from pathlib import Path

import pytest
from pyspark.sql import types as T

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))

from tablelift.scale import local_frame  # noqa: E402
from tablelift.session import local_session  # noqa: E402

SPLIT = {
    "spark.tablelift.smallInputBytes": "0",
    "spark.tablelift.joinInputBytes": "0",
    "spark.tablelift.groupRows": "4",
    "spark.tablelift.hotRows": "3",
    "spark.tablelift.broadcastRows": "0",
}


@pytest.fixture(scope="session")
def spark():
    session = local_session(4, "tests")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def frame(spark):
    """A DataFrame from a DDL schema and tuples."""

    def make(schema, *rows):
        struct = T.StructType.fromDDL(schema)
        return local_frame(spark, list(rows), struct)

    return make


@pytest.fixture
def split(spark):
    """Lower all size limits, so that the large-data paths run."""
    for key, value in SPLIT.items():
        spark.conf.set(key, value)
    yield
    for key in SPLIT:
        spark.conf.unset(key)


@pytest.fixture(params=["small", "split"])
def both(request):
    """Run a test with ordinary limits, then with the large-data paths forced."""
    if request.param == "split":
        request.getfixturevalue("split")
    return request.param


@pytest.fixture
def jobs(spark):
    """How many Spark jobs a call runs."""

    def count(call):
        group = uuid.uuid4().hex
        spark.sparkContext.setJobGroup(group, group)
        try:
            call()
        finally:
            spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        return len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))

    return count


class Bag(list):
    """A list of rows that compares without regard to order."""

    __hash__ = None

    def __eq__(self, other):
        return sorted(self, key=repr) == sorted(other, key=repr)


@pytest.fixture(scope="session")
def rows():
    """The rows of a DataFrame as tuples, to be compared in any order."""

    def collect(df, *columns):
        if columns:
            df = df.select(*columns)
        return Bag(tuple(r) for r in df.collect())

    return collect
