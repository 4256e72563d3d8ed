import tempfile
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

from obslake.session import SETTINGS


@pytest.fixture(scope="session")
def spark():
    work = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    builder = SparkSession.builder.master("local[8]").appName("obslake-tests")
    settings = {
        **SETTINGS,
        "spark.sql.shuffle.partitions": "4",
        "spark.driver.memory": "4g",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.checkpoint.dir": f"{work}/shared",
        "spark.sql.warehouse.dir": f"{work}/warehouse",
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def sf_dir():
    path = Path("/root/testdata/sf0.001")
    if not path.exists():
        pytest.skip("test tables are not there")
    return str(path)


def plan_of(df) -> str:
    return df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")


def scanned(df) -> dict[str, int]:
    """Files and rows that the scans of a collected DataFrame have read."""
    totals = {"numFiles": 0, "numOutputRows": 0}

    def visit(node):
        name = node.getClass().getSimpleName()
        if name == "AdaptiveSparkPlanExec":
            return visit(node.executedPlan())
        if name.endswith("QueryStageExec"):
            return visit(node.plan())
        if name == "FileSourceScanExec":
            for key in totals:
                totals[key] += node.metrics().apply(key).value()
        for i in range(node.children().size()):
            visit(node.children().apply(i))

    visit(df._jdf.queryExecution().executedPlan())
    return totals
