import os
import sys

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    session = (SparkSession.builder.master("local[8]").appName("tests")
               .config("spark.sql.shuffle.partitions", "2").config("spark.ui.enabled", "false")
               .config("spark.ui.showConsoleProgress", "false").config("spark.driver.memory", "8g")
               .config("spark.sql.session.timeZone", "UTC").getOrCreate())
    session.sparkContext.setLogLevel("ERROR")
    return session


@pytest.fixture(autouse=True)
def interpreted(spark, request):
    """Unit cases hold a few rows: compiling their plans would take longer than running them. The
    query comparison (test_queries) runs compiled."""
    compiled = request.module.__name__.endswith("test_queries")
    spark.conf.set("spark.sql.codegen.wholeStage", str(compiled).lower())
    spark.conf.set("spark.sql.codegen.factoryMode", "FALLBACK" if compiled else "NO_CODEGEN")
    yield
