import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

SF001 = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    from movrec.session import RECOMMENDED_CONF, ensure_checkpoint_dir

    b = (
        SparkSession.builder.master("local[*]")
        .appName("movrec-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    for k, v in RECOMMENDED_CONF.items():
        b = b.config(k, v)
    s = b.getOrCreate()
    s.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(s)
    yield s
    s.stop()


@pytest.fixture
def no_broadcast(spark):
    """Force the shuffle paths: no explicit broadcasts and no planner broadcasts."""
    from movrec.operators.sizing import CAP_CONF

    old_cap = spark.conf.get(CAP_CONF, None)
    old_auto = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    old_aqe = spark.conf.get("spark.sql.adaptive.autoBroadcastJoinThreshold", None)
    spark.conf.set(CAP_CONF, "0")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    yield
    if old_cap is None:
        spark.conf.unset(CAP_CONF)
    else:
        spark.conf.set(CAP_CONF, old_cap)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old_auto)
    if old_aqe is None:
        spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")
    else:
        spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", old_aqe)
