"""The registered computations with tiny slice widths (many slices per group,
so every cross-slice carry is used) still equal the DuckDB oracle."""

import duckdb
import pytest

import __spark_entry__ as E
from conftest import SF
from logflow import catalog
from logflow.operators import batching, jobs, metrics, routing
from logflow.sources import derived as D


def _norm(rows, cols):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted(tuple(repr(r[i]) for i in order) for r in rows)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in ("events", "orders", "conversations"):
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def _check(con, name, df):
    res = con.execute(E.oracle_sql()[name])
    ocols = [d[0] for d in res.description]
    assert _norm([tuple(r) for r in df.collect()], df.columns) == _norm(res.fetchall(), ocols), name


def test_registry_scans_with_tiny_slices(spark, con, monkeypatch):
    ch = D.changes(spark, SF)
    ev = jobs.to_job_events(ch)
    _check(con, "prior_image", jobs.prior_image(ch, width=7))
    _check(con, "active_job_count", jobs.active_job_count(ev, width=5))
    _check(con, "effective_deletes", jobs.effective_deletes_in_log(ev, width=3))
    monkeypatch.setattr(metrics, "BLOCK_TICKS", 5)
    _check(con, "throughput", metrics.throughput(D.records(spark, SF), every=catalog.REPORT_EVERY,
                                                 jobs=jobs.active_job_count(ev, width=11)))


def test_record_scans_with_tiny_slices(spark, con):
    b = batching.assign_batches(D.records(spark, SF), max_rows=catalog.FLUSH_ROWS, max_wait=catalog.FLUSH_WAIT,
                                width=4)
    _check(con, "flush_batches", batching.flush_counts(b, max_wait=catalog.FLUSH_WAIT))
    from logflow.functions.timefmt import index_name
    r = routing.route_as_of(D.records(spark, SF), jobs.to_job_events(D.changes(spark, SF)), width=1_000_000)
    _check(con, "route_as_of", r.select("topic", "partition", "offset", "version", "job_name", "pipeline",
                                        index_name("topic", "index_type", "ts").alias("index")))
