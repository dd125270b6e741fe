"""Plan checks: pushdown, pruning, no Python in core plans, broadcast."""

from logflow import catalog
from logflow.sources import derived as D

from conftest import SF


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_no_python_udfs_in_registered_queries(spark):
    for name in ("routed_counts", "route_as_of", "liveness", "throughput", "request_fanout", "job_state"):
        p = _plan(catalog.QUERIES[name](spark, SF))
        assert "PythonUDF" not in p and "BatchEvalPython" not in p and "ArrowEvalPython" not in p, name


def test_flagship_broadcasts_jobs(spark):
    assert "BroadcastHashJoin" in _plan(catalog.routed_counts(spark, SF))


def test_scan_prunes_columns(spark):
    p = _plan(D.records(spark, SF))
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz,user_id:bigint,event_type:string,props:string>" in p


def test_index_read_prunes_partitions(spark, tmp_path):
    from pyspark.sql import functions as F
    df = spark.createDataFrame([("a_1", "x"), ("b_2", "y")], "index string, doc string")
    df.write.partitionBy("index").parquet(str(tmp_path / "idx"))
    q = spark.read.parquet(str(tmp_path / "idx")).filter(F.col("index") == "a_1")
    p = q._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(index" in p and q.count() == 1
