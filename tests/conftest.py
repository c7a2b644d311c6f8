import os
import sys

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from flatspark import LAUNCH_SETTINGS, configure  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[4]")
        .appName("tests")
        .config(map=LAUNCH_SETTINGS)
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.default.parallelism", "4")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.ui.retainedExecutions", "1200")  # tests read the plans of those that just ran
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.warehouse.dir", str(tmp_path_factory.mktemp("warehouse")))
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield configure(session)
    session.stop()


@pytest.fixture
def json_docs(spark):
    """Rows out of Python documents with a schema, as the JSON reader would give them."""
    import json

    from pyspark.sql import functions as F

    def make(docs, schema):
        texts = spark.createDataFrame([(json.dumps(d),) for d in docs], "doc string")
        return texts.select(F.from_json("doc", schema).alias("d")).select("d.*")

    return make
