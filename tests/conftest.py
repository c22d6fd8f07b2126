import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"
SF_CHECK = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    import tempfile

    from pyspark.sql import SparkSession

    from lakeshift.session import work_root

    s = (
        SparkSession.builder.master("local[*]")
        .config("spark.sql.warehouse.dir", tempfile.mkdtemp(prefix="lakeshift-warehouse-"))
        .appName("lakeshift-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    s.sparkContext.setLogLevel("ERROR")
    work_root(s)
    yield s


@pytest.fixture()
def workdir(spark, request):
    from lakeshift.session import new_work_dir

    return new_work_dir(spark, "test-" + request.node.name.replace("[", "_").replace("]", "_"))
