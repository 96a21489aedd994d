"""Properties of the plans that matter at scale."""

import os

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from chartlift.operators import joins

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="the given tables are not here")

# not planned here: they run a stream or write files while they are built
EAGER = ("a4", "a5", "a10_overwrite", "m1", "m2", "m3", "i1", "i2", "i3", "k42", "k8", "l14", "k4_patients")


def plan(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def test_no_python_and_no_products(spark):
    for name, function in entry.queries().items():
        if name.startswith(EAGER):
            continue
        text = plan(function(spark, FOLDER))
        assert "Python" not in text and "ArrowEval" not in text, name
        assert "CartesianProduct" not in text, name
        if name != "c7_anti_not_in":  # a one-row null probe
            assert "BroadcastNestedLoopJoin" not in text, name


def test_filters_and_columns_reach_the_scan(spark):
    text = plan(entry.queries()["k20_vitals_encounters"](spark, FOLDER))
    assert "ReadSchema: struct<event_id:bigint,value:double>" in text
    text = plan(entry.queries()["c5_semi_exists"](spark, FOLDER))
    assert "PushedFilters: [IsNotNull(l_quantity), GreaterThan(l_quantity,49.0)" in text


def test_hot_keys_are_split(spark):
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB", "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
    }
    before = {key: spark.conf.get(key, None) for key in settings}
    try:
        for key, value in settings.items():
            spark.conf.set(key, value)
        facts = spark.range(300_000).select(F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 1000).alias("k"), "id")
        summary = facts.groupBy("k").agg(F.max("id").alias("top"))
        joined = joins.attach(facts, summary, ["k"])
        assert len(joined.collect()) == 300_000
        assert "skew=true" in plan(joined)
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)
