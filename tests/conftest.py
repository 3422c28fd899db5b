import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    d = tempfile.mkdtemp(prefix="spark-")
    conf = {"spark.sql.shuffle.partitions": "8", "spark.driver.memory": "6g", "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false", "spark.sql.session.timeZone": "UTC", "spark.checkpoint.dir": f"file://{d}/shared", "spark.local.dir": d, "spark.sql.warehouse.dir": f"{d}/warehouse"}
    s = SparkSession.builder.master("local[4]").config(map=conf).getOrCreate()
    s.sparkContext.setLogLevel("ERROR")
    return s
