import os
import sys

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

DATA = "/root/testdata"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[8]").appName("coverlay-tests")
        .config("spark.sql.shuffle.partitions", "8").config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false").config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("checkpoints"))).getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    from coverlay import enable

    yield enable(session)
    session.stop()


@pytest.fixture(scope="session")
def shapes(spark):
    """``shapes([(id, 'WKT'), ...])`` → DataFrame ``id, geom``; further columns by name and type."""
    from coverlay.functions import geometry as G

    def make(rows, ddl="id int, wkt string"):
        return spark.createDataFrame(rows, ddl).withColumn("geom", G.from_text("wkt")).drop("wkt")

    return make
