import os
import sys
import uuid
from contextlib import contextmanager

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    folder = tmp_path_factory.mktemp("spark")
    session = (
        SparkSession.builder.master("local[*]")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.default.parallelism", "4")
        # Compiling code for hundreds of tiny plans would take most of the time.
        # test_codegen.py switches it on.
        .config("spark.sql.codegen.wholeStage", "false")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.requireAllClusterKeysForCoPartition", "false")
        .config("spark.sql.maxMetadataStringLength", "2000")
        .config("spark.checkpoint.dir", str(folder / "shared"))
        .config("spark.sql.warehouse.dir", str(folder / "warehouse"))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    return session


def rows(df, *columns):
    """Rows as sorted tuples, nulls first."""
    found = [tuple(r) for r in (df.select(*columns) if columns else df).collect()]
    return sorted(found, key=lambda r: [(v is not None, str(type(v)), v) if v is not None else (False,) for v in r])


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@contextmanager
def jobs_of(spark):
    """Collects the Spark jobs that run inside; call the result for their ids."""
    group = f"jobs-{uuid.uuid4().hex}"
    spark.sparkContext.setJobGroup(group, "watched")
    try:
        yield lambda: list(spark.sparkContext.statusTracker().getJobIdsForGroup(group))
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
