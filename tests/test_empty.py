"""Every operator accepts empty input and returns an empty result."""

from logflow import schemas
from logflow.operators import batching, claims, ingest, jobs, metrics, routing
from logflow.plans import scan


def test_empty_inputs(spark):
    recs = spark.createDataFrame([], schemas.RECORDS)
    ch = spark.createDataFrame([], schemas.CHANGES)
    hb = spark.createDataFrame([], schemas.HEARTBEATS)
    req = spark.createDataFrame([], schemas.REQUESTS)
    ev = jobs.to_job_events(ch)
    outs = {
        "batches": batching.flush_counts(batching.assign_batches(recs)),
        "throughput": metrics.throughput(recs, "10 seconds"),
        "throughput_jobs": metrics.throughput(recs, "10 seconds", jobs=jobs.active_job_count(ev)),
        "state": jobs.job_state(ch),
        "prior": jobs.prior_image(ch),
        "active": jobs.active_job_count(ev),
        "running": jobs.running_topics(ev),
        "survivors": jobs.delete_all_survivors(ch),
        "snapshot": jobs.snapshot_then_tail(ch, 10),
        "liveness": claims.liveness(hb),
        "winners": claims.claim_winners(hb),
        "route": routing.route(recs, jobs.running_topics(ev)),
        "asof": routing.route_as_of(recs, ev),
        "requests": ingest.explode_logs(ingest.validate_requests(req)),
        "rownum": scan.row_number(recs, "topic", "offset"),
    }
    for name, df in outs.items():
        assert df.count() == 0, name
