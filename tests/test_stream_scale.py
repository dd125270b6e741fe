"""What the streams hold and deal when events outnumber topics and ticks."""

import datetime as dt
import tempfile

import numpy as np
import pandas as pd

from logflow import catalog, schemas
from logflow.streaming import collect as C
from logflow.streaming import live


class _Value:
    def __init__(self):
        self.value = None

    def exists(self):
        return self.value is not None

    def get(self):
        return self.value

    def update(self, value):
        self.value = value


class _Map(dict):
    writes = 0

    def containsKey(self, key):
        return key in self

    def getValue(self, key):
        return self[key]

    def updateValue(self, key, value):
        self.writes += 1
        self[key] = value

    def removeKey(self, key):
        del self[key]


class _Handle:
    def getValueState(self, name, schema):
        return _Value()

    def getMapState(self, name, key, value):
        return _Map()


def test_waiting_steps_are_few_entries_of_the_report():
    report = live.Report()
    report.init(_Handle())
    far = 3 * live.STEP_BLOCK
    rng = np.random.default_rng(1)
    steps = pd.DataFrame({"is_delta": True, "tick": rng.permutation(far)[:20_000], "n": rng.integers(-2, 3, 20_000)})
    closed = pd.DataFrame({"is_delta": False, "tick": [5, 9, 9000, far - 1], "n": [1, 2, 3, 4]})
    got = []
    for rows in ([steps[:9000]], [steps[9000:], closed[:2]], [closed[2:3]], [closed[3:]]):
        got += list(report.handleInputRows((0,), iter(rows), None))
    out = pd.concat(got)
    per = steps.groupby("tick")["n"].sum().reindex(range(far), fill_value=0).cumsum()
    assert out["tick"].tolist() == list(range(5, far)) and out["jobs"].tolist() == per[5:].tolist()
    assert out["rows_total"].iloc[[0, 4, -1]].tolist() == [1, 3, 10]
    assert report.deltas.writes < 20 and not report.deltas


def test_only_the_newest_event_of_a_topic_is_dealt(spark):
    rows = [(k, dt.datetime(2024, 1, 1), f"k{k}", 1, t, "j", "", "") for k in range(500) for t in ("a", None)]
    rows.append((None, dt.datetime(2024, 1, 1), "k", 2, "b", None, None, None))
    events = spark.createDataFrame(rows, "revision long, ts timestamp_ntz, key string, event_type int, topic string, "
                                         "job_name string, index_type string, pipeline string").coalesce(1)
    records = spark.createDataFrame([], schemas.RECORDS)
    got = C._one_stream(records, events, 4).select("topic", "shard", "revision", "key").collect()
    assert sorted((r.topic or "", r.shard, r.revision, r.key) for r in got) == sorted(
        (t, s, n, k) for t, n, k in (("a", 499, "k499"), ("", 499, "k499"), ("b", -1, "k")) for s in range(4))


def test_newest_events_of_many_batches(monkeypatch):
    monkeypatch.setattr(C, "EVENTS_HELD", 3)
    batches = [pd.DataFrame({"topic": [f"t{(k * 7 + j) % 9}" for j in range(5)], "revision": np.arange(5) + 10 * k})
               for k in range(20)]
    want = pd.concat(batches).groupby("topic")["revision"].max()
    assert pd.concat(C.newest_events(iter(batches))).groupby("topic")["revision"].max().equals(want)
    monkeypatch.setattr(C, "EVENTS_HELD", 100)
    got = pd.concat(C.newest_events(iter(batches)))
    assert len(got) == 9 and got.set_index("topic")["revision"].sort_index().equals(want)
    assert list(C.newest_events(iter([]))) == []


def test_sets_of_files_have_one_size(spark, monkeypatch):
    monkeypatch.setattr(catalog, "FILE_ROWS", 10)
    start = dt.datetime(2024, 1, 1)
    # the middle third is empty, the last has one row
    rows = [(k, start + dt.timedelta(seconds=k)) for k in range(90)] + [(90, start + dt.timedelta(seconds=300)), (91, None)]
    df = spark.createDataFrame(rows, "id long, ts timestamp_ntz")
    path = tempfile.mkdtemp(prefix="logflow-test-") + "/sets"
    files = catalog._by_time(df, path, 3)
    back = spark.read.schema(df.schema).parquet(path)
    assert files == 4 and len(back.inputFiles()) == 12
    assert sorted(r.id for r in back.collect()) == list(range(92))
