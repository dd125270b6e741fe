"""Index names (FIXTURES section 3), prefixes, log lines."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from logflow.functions import index_name, strip_prefix
from logflow.functions.logline import format_log_line, log_prefix

T = dt.datetime(2026, 12, 31, 17, 0, 0)


@pytest.mark.parametrize("itype,want,compat", [
    ("yyyy.MM.dd", "a_2027.01.01", "a_2027.01.01"),
    ("yyyy", "a_2027", "a_2027"),
    ("yyyy.MM", "a_2027.01", "a_1016.01"),
    ("", "a", "a"),
    ("weekly", "a", "a"),
])
def test_index_name(spark, itype, want, compat):
    df = spark.createDataFrame([("a", itype, T)], "topic string, it string, ts timestamp_ntz")
    r = df.select(index_name("topic", "it", "ts").alias("x"), index_name("topic", "it", "ts", compat=True)
                  .alias("y")).first()
    assert (r.x, r.y) == (want, compat)


def test_index_name_ignores_session_zone(spark):
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
        df = spark.createDataFrame([("a", "yyyy.MM.dd", T)], "topic string, it string, ts timestamp_ntz")
        assert df.select(index_name("topic", "it", "ts")).first()[0] == "a_2027.01.01"
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_strip_prefix(spark):
    df = spark.createDataFrame([("/p/x",), ("x",), ("/p/",)], "k string")
    assert [r[0] for r in df.select(strip_prefix("k", "/p/")).collect()] == ["x", "x", ""]


def test_log_lines(spark):
    df = spark.createDataFrame([(1, "/a/b/sched.go", 205, T, "3"), (3, None, None, T, "x y")],
                               "level int, file string, line int, ts timestamp_ntz, msg string")
    pre = [r[0] for r in df.select(log_prefix("level", "file", "line", "ts")).collect()]
    assert pre == ["[INFO][sched.go:205] 2026-12-31 ", "[ERROR] 2026-12-31 "]
    lines = [r[0] for r in df.select(format_log_line("level", "file", "line", "ts", "msg", sink="file")).collect()]
    assert lines[0] == "[INFO][sched.go:205] 2026-12-31 2026/12/31 17:00:00 [3]"
    con = df.select(format_log_line("level", "file", "line", "ts", "msg")).first()[0]
    assert con == "[INFO][sched.go:205] 2026-12-31 17:00:00 [3]"


def test_formatting_inside_a_dst_gap(spark):
    from logflow.functions.timefmt import format_ntz
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        df = spark.createDataFrame([(dt.datetime(2024, 3, 10, 2, 30, 5),)], "ts timestamp_ntz")
        r = df.select(format_ntz("ts", "yyyy-MM-dd HH:mm:ss").alias("a"), format_ntz("ts", "d'x'MM").alias("b")).first()
        assert (r.a, r.b) == ("2024-03-10 02:30:05", "10x03")
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_log_lines_with_argument_lists(spark):
    from logflow.operators.logs import log_lines
    df = spark.createDataFrame([(1, "/x/a.go", 3, T, ["logCountSum is", "42"])],
                               "level int, file string, line int, ts timestamp_ntz, msg array<string>")
    assert log_lines(df).first().line_text == "[INFO][a.go:3] 2026-12-31 17:00:00 [logCountSum is 42]"
