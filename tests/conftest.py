import os
import sys
import uuid

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession  # noqa: E402

from cartlake.sources.scratch import scratch_root  # noqa: E402
from cartlake.specs import Layers  # noqa: E402

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[8]")
        .appName("cartlake-tests")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.warehouse.dir", str(tmp_path_factory.mktemp("warehouse")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def layers(spark):
    """Namespaces of their own for each test."""
    made = Layers.prefixed(f"t_{uuid.uuid4().hex[:12]}", f"{scratch_root(spark)}/cartlake")
    for name in (made.bronze, made.silver, made.gold, made.dlq, made.ops):
        spark.sql(f"CREATE NAMESPACE IF NOT EXISTS {name} LOCATION '{made.location}/{name}'")
    return made


@pytest.fixture
def conf(spark):
    """Set session options for one test."""
    before = {}

    def put(key, value):
        before.setdefault(key, spark.conf.get(key))
        spark.conf.set(key, value)

    yield put
    for key, value in before.items():
        spark.conf.set(key, value)


def rows(df, *columns):
    """Rows as sorted tuples."""
    picked = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in picked.collect()), key=repr)


def final_plan(df):
    """The plan that ran, after adaptive changes."""
    df.collect()
    text = df._jdf.queryExecution().executedPlan().toString()
    return text.split("== Initial Plan ==")[0]
