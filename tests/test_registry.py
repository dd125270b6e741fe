"""Registry folds (P6 P10 A3 A4 A5 W2 J3 J4 T1) on hand-written change logs."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from logflow.functions.keys import JOBS_PREFIX as P
from logflow.operators import jobs

T0 = dt.datetime(2024, 1, 1)


def job(topic, name="j", itype="", pipe=""):
    return json.dumps({"job_name": name, "topic": topic, "index_type": itype, "pipeline": pipe})


def log(spark, changes):
    rows = [(i + 1, op, P + k, v, T0 + dt.timedelta(seconds=i)) for i, (op, k, v) in enumerate(changes)]
    return spark.createDataFrame(rows, "revision long, op string, key string, value string, ts timestamp_ntz")


def test_put_twice_delete_absent_put_after_delete(spark):
    ch = log(spark, [("PUT", "a", job("a", "j1")), ("PUT", "a", job("a", "j2")), ("DELETE", "zz", None),
                     ("PUT", "b", job("b")), ("DELETE", "b", None), ("PUT", "b", job("b", "j3")),
                     ("PUT", "c", "{not json"), ("PUT", "d", job("x"))])
    st = {r.name: r for r in jobs.job_state(ch).collect()}
    assert set(st) == {"a", "b", "d"}
    assert st["a"].job_name == "j2" and st["b"].job_name == "j3" and st["d"].topic == "x"
    assert [r.revision for r in jobs.quarantine(ch).collect()] == [7]
    surv = {r.name for r in jobs.delete_all_survivors(ch).collect()}
    assert surv == {"c", "d"}  # c: undecodable, never listed; d: key unlike its topic


def test_prior_image(spark):
    ch = log(spark, [("PUT", "a", job("a", "j1")), ("PUT", "a", job("a", "j2")), ("DELETE", "a", None),
                     ("PUT", "a", "oops"), ("PUT", "a", job("a", "j5")), ("DELETE", "q", None)])
    got = {r.revision: r.prior_job_name for r in jobs.prior_image(ch, width=2).collect()}
    assert got == {1: None, 2: "j1", 3: "j2", 4: None, 5: None, 6: None}


def test_decode_rules(spark):
    vals = ['{"JOB_NAME":"x","Topic":"t"}', 'null', '{"topic":5}', '[1]', '{"topic":null,"pipeline":"p"}',
            '{"topic":"t"} x', '{"topic":"t","extra":[1,2]}']
    df = spark.createDataFrame([(i, v) for i, v in enumerate(vals)], "i int, value string")
    got = {r.i: r for r in jobs.decode_jobs(df).collect()}
    assert got[0].decodable and got[0].job_name == "x" and got[0].topic == "t"
    assert got[1].decodable and got[1].topic == ""
    assert not got[2].decodable and not got[3].decodable and not got[5].decodable
    assert got[4].decodable and got[4].topic == "" and got[4].pipeline == "p"
    assert got[6].decodable


def test_decode_takes_the_last_key_of_any_case(spark):
    cases = [('{"topic":"a","Topic":"b"}', "b"), ('{"Topic":"b","topic":"a"}', "a"), ('{"topic":"a","topic":null}', "a"),
             ('{"Topic":"b","TOPIC":"c"}', "c"), ('{"topic":"a","topic":"b"}', "b"), ('{"topic":5,"topic":"a"}', None),
             ('{"topic":"a","TOPIC":[1]}', None), ('{"t\\u006fpic":"e"}', "e"), ('{"x":"\\"topic\\"","topic":"q"}', "q"),
             ('{"job_name":"j","topic":"a","index_type":"","pipeline":"","Topic":"z"}', "z"), ('{}', "")]
    df = spark.createDataFrame([(i, v) for i, (v, _) in enumerate(cases)], "i int, value string")
    got = {r.i: r.topic if r.decodable else None for r in jobs.decode_jobs(df).collect()}
    assert got == {i: w for i, (_, w) in enumerate(cases)}


def test_running_topics_and_counts(spark):
    # key k2 holds a job for topic "a"; deleting key "a" stops topic "a"
    ch = log(spark, [("PUT", "a", job("a")), ("PUT", "k2", job("a", "j2")), ("PUT", "b", job("b")),
                     ("DELETE", "a", None), ("DELETE", "k2", None), ("DELETE", "b", None),
                     ("PUT", "c", job("c"))])
    ev = jobs.to_job_events(ch)
    counts = [r.active_jobs for r in jobs.active_job_count(ev, width=2).orderBy("revision").collect()]
    assert counts == [1, 1, 2, 1, 1, 0, 1]
    eff = [r.revision for r in jobs.effective_deletes_in_log(ev, width=2).collect()]
    assert sorted(eff) == [4, 6]
    assert {r.topic for r in jobs.running_topics(ev).collect()} == {"c"}


@pytest.mark.parametrize("cut", [0, 1, 3, 5, 8, 100])
def test_snapshot_then_tail_equals_full_fold(spark, cut):
    ch = log(spark, [("PUT", "a", job("a")), ("PUT", "b", job("b")), ("DELETE", "a", None), ("PUT", "c", "bad"),
                     ("PUT", "a", job("a", "j9")), ("PUT", "b", job("b", "jb")), ("DELETE", "c", None),
                     ("PUT", "d", job("d"))])
    ev = jobs.snapshot_then_tail(ch, cut)
    assert ev.filter((F.col("phase") == 1) & (F.col("revision") <= cut)).count() == 0
    last = ev.groupBy("key").agg(F.max_by(F.struct("event_type", "job_name"), F.struct("phase", "revision"))
                                 .alias("l")).collect()
    folded = {(r.key, r.l.job_name) for r in last if r.l.event_type == 1}
    full = {(r.key, r.job_name) for r in jobs.job_state(ch).collect()}
    assert folded == full


def test_topic_change_keeps_old_topic_running(spark):
    """A key whose job moves to another topic starts the new topic; the old
    one keeps running (the running table is keyed by topic), until a delete
    of a key named like it."""
    ch = log(spark, [("PUT", "t0", job("t0", "j0")), ("PUT", "t0", job("t1", "j1"))])
    assert {r.topic for r in jobs.running_topics(jobs.to_job_events(ch)).collect()} == {"t0", "t1"}
    assert {r.topic for r in jobs.job_state(ch).collect()} == {"t1"}


def test_delete_all_changes_leave_the_survivors(spark):
    from conftest import SF
    from logflow.sources import derived as D
    ch = D.changes(spark, SF)
    after = ch.unionByName(jobs.delete_all_changes(ch))
    left = {r.key for r in jobs.registry_state(after).collect()}
    assert left == {r.key for r in jobs.delete_all_survivors(ch).collect()}
    assert left


def test_single_key_deletes(spark):
    from logflow.operators import ingest
    ch = log(spark, [("PUT", "a", job("a")), ("PUT", "b", job("b"))])
    dels = spark.createDataFrame([(3, "a"), (4, "nope")], "revision long, key string")
    after = ch.unionByName(ingest.key_deletes_to_changes(dels))
    assert {r.name for r in jobs.job_state(after).collect()} == {"b"}
    pri = {r.revision: r.prior_job_name for r in jobs.prior_image(after).collect()}
    assert pri[3] == "j" and pri[4] is None


def test_deletes_reply_with_the_removed_jobs(spark):
    from logflow.operators import ingest
    ch = log(spark, [("PUT", "a", job("a", "j1")), ("PUT", "a", job("a", "j2")), ("PUT", "b", "{bad")])
    bodies = spark.createDataFrame([(4, '{"keys":["a","a","b","no"]}'), (5, '{"keys":["a"]}'), (6, '{"keys":1}')],
                                   "revision long, body string")
    got = {(r.revision, r.pos, r.key): r.removed_job_name
           for r in jobs.removed_jobs(ingest.explode_deletes(bodies), ch, width=2).collect()}
    assert got == {(4, 0, "a"): "j2", (4, 1, "a"): None, (4, 2, "b"): None, (4, 3, "no"): None, (5, 0, "a"): None}


def test_undecodable_update_keeps_the_watched_job(spark):
    """A watcher skips an undecodable update (no event), so it keeps the old
    job; the registry listing skips the undecodable value, so the key is not
    listed.  Both follow the reference."""
    ch = log(spark, [("PUT", "t0", job("t0", "j0")), ("PUT", "t0", "{bad")])
    ev = jobs.snapshot_then_tail(ch, 0)
    assert [(r.event_type, r.job_name) for r in ev.collect()] == [(1, "j0")]
    assert jobs.job_state(ch).count() == 0
    assert [r.revision for r in jobs.quarantine(ch).collect()] == [2]
