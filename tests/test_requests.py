"""Report body checks (P1 P2) on the cases of FIXTURES.md section 2."""

import pytest
from pyspark.sql import Row

from logflow.operators import ingest

CASES = [
    ('{"topic":"a","logs":["x","y"]}', 0, ["x", "y"]),
    ('{"topic":"a","logs":[]}', 0, []),
    ('{"topic":"a","logs":["x"],"extra":1}', 0, ["x"]),
    ('{"topic":"a","topic":"b","logs":["x"]}', 0, ["x"]),
    ('{"topic":"a","logs":["x",1]}', -2, None),
    ('{"topic":"a","logs":["x",null]}', -2, None),
    ('{"topic":"a","logs":"x"}', -2, None),
    ('{"topic":"a"}', -2, None),
    ('{"topic":5,"logs":["x"]}', -2, None),
    ('{"Topic":"a","logs":["x"]}', -2, None),
    ('null', -2, None),
    ('[1]', -1, None),
    ('"s"', -1, None),
    ('', -1, None),
    ('{bad', -1, None),
    ("{'topic':'a','logs':['x']}", -1, None),
    ('{"topic":"a","logs":["x"]} trailing', -1, None),
    ('{"topic":"a","logs":["x"]}] {', -1, None),
    ('{"topic":"a","logs":["x"]}} {', -1, None),
    ('{"topic":"a","logs":["x"]}, "c":{}', -1, None),
    ('{"topic":"a","logs":["x"]},{}', -1, None),
    (' {"topic":"a","logs":["x"]}\n', 0, ["x"]),
    ('{}', -2, None),
    ('{"topic":null,"logs":["x"]}', -2, None),
    ('{"topic":"a","logs":null}', -2, None),
    ('1', -1, None),
    ('true', -1, None),
    (None, -1, None),
    ('{"topic":"a","logs":["x"],"n":1e999}', -1, None),
    ('{"topic":"a","logs":["x"],"n":[-1E+400]}', -1, None),
    ('{"topic":"a","logs":["1e999"]}', 0, ["1e999"]),
    ('{"topic":"a","logs":["Infinity"],"n":1e300}', 0, ["Infinity"]),
    ('{"topic":"a","logs":["x"],"n":1.5e-999}', 0, ["x"]),
]


@pytest.fixture(scope="module")
def checked(spark):
    rows = [Row(req_id=i, body=b) for i, (b, _, _) in enumerate(CASES)]
    df = spark.createDataFrame(rows, "req_id long, body string")
    return {r.req_id: r for r in ingest.validate_requests(df).collect()}


@pytest.mark.parametrize("i", range(len(CASES)))
def test_code(checked, i):
    body, code, logs = CASES[i]
    r = checked[i]
    assert r.code == code, body
    if code == 0:
        assert r.logs == logs
    else:
        assert r.topic is None and r.logs is None


def test_duplicate_topic_last_wins(checked):
    i = [c[0] for c in CASES].index('{"topic":"a","topic":"b","logs":["x"]}')
    assert checked[i].topic == "b"


def test_round_trip(spark):
    """Rows wrapped into bodies come back unchanged, in order (P1 then P2)."""
    from pyspark.sql import functions as F
    src = spark.createDataFrame([(t, i, f"line {t} {i} \"q\" \\ é\n") for t in range(5) for i in range(7)],
                                "t int, i int, text string")
    bodies = (src.groupBy("t").agg(F.sort_array(F.collect_list(F.struct("i", "text"))).alias("s"))
              .select(F.col("t").cast("long").alias("req_id"),
                      F.to_json(F.struct(F.concat(F.lit("topic"), F.col("t").cast("string")).alias("topic"),
                                         F.transform("s", lambda x: x["text"]).alias("logs"))).alias("body")))
    out = ingest.explode_logs(ingest.validate_requests(bodies), keep=["req_id", "topic"])
    got = sorted((r.req_id, r.pos, r.log) for r in out.collect())
    want = sorted((t, i, f"line {t} {i} \"q\" \\ é\n") for t in range(5) for i in range(7))
    assert got == want


def test_put_and_delete_bodies(spark):
    rows = [
        (1, '{"key":"k","job_name":"j","topic":"t"}'),
        (2, '{"key":"k","job_name":"j","topic":"t","pipeline":"p","index_type":"yyyy"}'),
        (3, '{"key":"k","job_name":"j","topic":"t","pipeline":null}'),
        (4, '{"key":"k","job_name":"j"}'),
        (5, '{"key":1,"job_name":"j","topic":"t"}'),
        (6, 'null'),
        (7, '{"key":"k","job_name":"j","topic":"t","n":1e999}'),
    ]
    df = spark.createDataFrame(rows, "revision long, body string")
    got = {r.revision: r for r in ingest.validate_job_puts(df).collect()}
    assert got[1].code == 0 and got[1].pipeline == "" and got[1].index_type == ""
    assert got[2].code == 0 and got[2].pipeline == "p" and got[2].index_type == "yyyy"
    assert [got[i].code for i in (3, 4, 5, 6, 7)] == [-1, -1, -1, -1, -1]
    dels = spark.createDataFrame([(1, '{"keys":["a","b"]}'), (2, '{"keys":[]}'), (3, '{"keys":["a",2]}'),
                                  (4, '{"nokeys":1}'), (5, '{"keys":"a"}'), (6, '{"keys":["a"],"n":2e308}')],
                                 "revision long, body string")
    rows = sorted((r.revision, r.code, r.key) for r in ingest.explode_deletes(dels).collect())
    assert rows == [(1, 0, "a"), (1, 0, "b"), (2, 0, None), (3, -1, None), (4, -1, None), (5, -1, None),
                    (6, -1, None)]


def test_single_expression_form_agrees(spark, checked):
    from pyspark.sql import functions as F

    from logflow.functions import jsoncheck as J
    df = spark.createDataFrame([(i, b) for i, (b, _, _) in enumerate(CASES)], "req_id long, body string")
    got = {r.req_id: r.c for r in df.select("req_id", J.request_code(J.parse_one(F.col("body")), F.col("body"))
                                                           .alias("c"))
           .collect()}
    assert got == {i: r.code for i, r in checked.items()}
