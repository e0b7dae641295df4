import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    s = (SparkSession.builder.master("local[4]").appName("stockcast-tests")
         .config("spark.sql.shuffle.partitions", "8")
         .config("spark.sql.session.timeZone", "UTC")
         .config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false")
         .getOrCreate())
    s.sparkContext.setLogLevel("ERROR")
    if not s.sparkContext.getCheckpointDir():
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="stockcast-test-ckpt-"))
    yield s


@pytest.fixture()
def tmpdir_path():
    return tempfile.mkdtemp(prefix="stockcast-test-")


# hand-made sales lines, each exercising one rule
F1_ROWS = [
    ("489434", "85048", "LIGHTS", 12.0, "01/12/09 07:45", 6.95, "13085", "United Kingdom"),
    ("C489449", "22087", "PAPER BUNTING", -12.0, "01/12/09 10:33", 2.95, "16321", "Australia"),
    ("489464", "21733", None, -96.0, "01/12/09 10:52", 0.0, None, "United Kingdom"),
    ("C500001", "85048", "LIGHTS", 3.0, "02/12/09 09:00", 6.95, "13085", "United Kingdom"),
    ("A506401", "B", "Adjust", 1.0, "3/12/09 9:5", 1.0, "abc", "United Kingdom"),
    (None, "85048", "LIGHTS B", 4.0, "04/12/09 08:00", None, "13085", "France"),
    ("489470", None, "LOST", 5.0, "05/12/09 08:00", 1.0, "13085", "France"),
    ("489471", "85048", "LIGHTS", 2.0, "06/12/69 08:00", 6.95, "13085", "France"),
]
F1_SCHEMA = ("Invoice string, StockCode string, Description string, Quantity double, InvoiceDate string, "
             "Price double, `Customer ID` string, Country string")


@pytest.fixture()
def f1(spark):
    return spark.createDataFrame(F1_ROWS, F1_SCHEMA)


# restock demo, 5 products, demand under the other name, no priority/price/cost
F2_ROWS = [("A001", "Widget A", 100.0, 20.0, 80.0), ("B002", "Widget B", 50.0, 10.0, 40.0),
           ("C003", "Widget C", 75.0, 15.0, 60.0), ("D004", "Widget D", 25.0, 5.0, 20.0),
           ("E005", "Widget E", 60.0, 12.0, 48.0)]
F2_SCHEMA = "StockCode string, Description string, recommended_restock double, safety_stock double, predicted_demand double"


@pytest.fixture()
def f2(spark):
    return spark.createDataFrame(F2_ROWS, F2_SCHEMA)
