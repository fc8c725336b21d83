"""Code sets, classification, retries, decoding, log lines against plain Python."""

import random

import pytest
from pyspark.sql import functions as F

from restframe.functions.codes import classify, code_set, is_sink_error, parse_code_set, rule_error
from restframe.functions.loglines import request_line, response_line
from restframe.operators.response import (
    emit_rows,
    fail_on_error,
    process_responses,
    pruned_schema,
)
from restframe.operators.retry import backoff, resolve_attempts, retry_counters
from restframe.spec import ARRAY, EXPONENTIAL_DELAY, LookupSpec, seconds

def random_code_set(seed):
    """An expression and the codes it stands for: whole classes and single codes, less those excluded."""
    rng = random.Random(seed)
    parts, inside, outside = [], set(), set()
    for _ in range(rng.randint(0, 7)):
        if rng.random() < 0.4:
            hundred = rng.randint(1, 5)
            parts.append(f"{hundred}{rng.choice('xX')}{rng.choice('xX')}")
            inside |= set(range(100 * hundred, 100 * hundred + 100))
        else:
            code = rng.randint(100, 599)
            excluded = rng.random() < 0.4
            parts.append(("!" if excluded else "") + "0" * rng.choice([0, 0, 12]) + str(code))
            (outside if excluded else inside).add(code)
    spaced = [" " * rng.randint(0, 2) + part + " " * rng.randint(0, 2) for part in parts]
    return ",".join(spaced), inside - outside


@pytest.mark.parametrize("seed", range(25))
def test_code_set(one, seed):
    expression, want = random_code_set(seed)
    assert parse_code_set(expression) == want
    assert one(code_set(F.lit(expression))) == sorted(want)


@pytest.mark.parametrize("wrong", ["0xx", "7xx", "42", "811", "x4x", "4x", "4xxx", "!5xx", "4 4 4", "-301", "3.1", "!", "9" * 30])
def test_bad_code_set(one, wrong):
    for expression in (wrong, f"{random_code_set(3)[0] or '200'},{wrong}"):
        with pytest.raises(ValueError):
            parse_code_set(expression)
        assert one(code_set(F.lit(expression))) is None


def test_rule_error(one):
    assert one(rule_error(code_set(F.lit("2XX")), code_set(F.lit("503")))) is None
    assert "overlap" in one(rule_error(code_set(F.lit("2XX")), code_set(F.lit("201"))))
    with pytest.raises(ValueError, match="both success and retry"):
        LookupSpec(url="http://s", schema="a int", retry_codes="201")
    with pytest.raises(ValueError, match="empty"):
        LookupSpec(url="http://s", schema="a int", success_codes="!200")


def test_classify(spark):
    good, again = parse_code_set("3XX,217,!304"), parse_code_set("5XX,429,!511")
    want = {c: "SUCCESS" if c in good else "RETRY" if c in again else "ERROR" for c in range(100, 600)}
    frame = spark.createDataFrame([(s,) for s in want], "status int")
    assert dict(frame.select("status", classify(F.col("status"), good, again)).collect()) == want


def test_sink_errors(spark, one):
    frame = spark.createDataFrame([(s,) for s in (100, 200, 400, 404, 500, 501)], "s int")
    by_default = dict(frame.select("s", is_sink_error(F.col("s"))).collect())
    assert [s for s, bad in by_default.items() if bad] == [400, 404, 500, 501]
    excluded = dict(frame.select("s", is_sink_error(F.col("s"), "4xx,500", "404")).collect())
    assert [s for s, bad in excluded.items() if bad] == [400, 500]
    with pytest.raises(ValueError):
        is_sink_error(F.lit(1), "4X")
    with pytest.raises(Exception, match="invalid HTTP status"):
        one(is_sink_error(F.lit(99)))


def test_backoff():
    spec = LookupSpec(
        url="http://s", schema="a int", max_retries=6, retry_strategy=EXPONENTIAL_DELAY,
        initial_backoff=0.015, backoff_multiplier=2, max_backoff=0.120,
    )
    waits = [round(1000 * backoff(n, spec)) for n in range(1, 7)]
    assert waits == [15, 30, 60, 120, 120, 120]


@pytest.mark.parametrize(
    ("text", "want"), [("30 s", 30), ("500 ms", 0.5), ("1 min", 60), ("PT10S", 10), ("7", 7), (3, 3)]
)
def test_seconds(text, want):
    assert seconds(text) == want


def test_resolve_attempts(spark):
    spec = LookupSpec(url="http://s", schema="a int", max_retries=2)
    rows = [
        ("once", 1, 200, None),
        ("again", 1, 503, None), ("again", 2, None, "reset"), ("again", 3, 200, None),
        ("never", 1, 503, None), ("never", 2, 503, None), ("never", 3, 500, None), ("never", 4, 200, None),
        ("refused", 1, 400, None), ("refused", 2, 200, None),
    ]
    log = spark.createDataFrame(rows, "request_id string, attempt int, status int, io_error string")
    final = resolve_attempts(log, spec)
    got = {r.request_id: (r.n_attempts, r.status) for r in final.collect()}
    assert got == {"once": (1, 200), "again": (3, 200), "never": (3, 500), "refused": (1, 400)}
    counters = retry_counters(final, spec).first()
    assert tuple(counters) == (1, 1, 2)
    single = resolve_attempts(log, spec.replace(max_retries=0))
    assert {r.n_attempts for r in single.collect()} == {1}


def responses(spark, *rows):
    ddl = "request_id string, status int, headers map<string,array<string>>, body string, io_error string"
    return spark.createDataFrame([(str(i), *row) for i, row in enumerate(rows)], ddl)


def outcome(spark, spec, *rows):
    got = process_responses(responses(spark, *rows), spec).orderBy("request_id").collect()
    return [(r.completion_state, [tuple(x) for x in r.rows], r.error_string) for r in got]


SPEC = LookupSpec(url="http://s", schema="id int, flag boolean", ignored_codes="404", continue_on_error=True)
OK = {"X": ["1"]}


def test_decision_table(spark):
    got = outcome(
        spark,
        SPEC,
        (None, None, None, "refused"),
        (500, OK, "", None),
        (404, OK, " ", None),
        (200, OK, " \n", None),
        (200, OK, "A test string that is not json", None),
        (200, OK, '{"id": "7", "flag": "TRUE", "more": 1}', None),
        (200, OK, '{"id": "x"}', None),
        (200, OK, "{}", None),
        (200, OK, "null", None),
    )
    assert got == [
        ("EXCEPTION", [], "refused"),
        ("HTTP_ERROR_STATUS", [], ""),
        ("IGNORE_STATUS_CODE", [], None),
        ("SUCCESS", [], None),
        ("UNABLE_TO_DESERIALIZE_RESPONSE", [], "A test string that is not json"),
        ("SUCCESS", [(7, True)], None),
        ("UNABLE_TO_DESERIALIZE_RESPONSE", [], '{"id": "x"}'),
        ("SUCCESS", [(None, None)], None),
        ("SUCCESS", [], None),
    ]


def test_ignored_parse_errors(spark):
    lenient = SPEC.replace(options={"json.ignore-parse-errors": "true"})
    got = outcome(spark, lenient, (200, OK, "no json", None), (200, OK, '{"id": "x", "flag": true}', None))
    assert got == [("SUCCESS", [], None), ("SUCCESS", [(None, True)], None)]


def test_array_results(spark):
    spec = SPEC.replace(result_type=ARRAY)
    body = '[{"id":1},null,{"id":2}]'
    bad = '[{"id":"a"},{"id":3},"text"]'
    got = outcome(spark, spec, (200, OK, body, None), (200, OK, bad, None), (200, OK, '{"id":1}', None))
    assert got[0] == ("SUCCESS", [(1, None), (2, None)], None)
    assert got[1] == ("UNABLE_TO_DESERIALIZE_RESPONSE", [], bad)
    assert got[2][0] == "UNABLE_TO_DESERIALIZE_RESPONSE"
    lenient = spec.replace(options={"json.ignore-parse-errors": "true"})
    assert outcome(spark, lenient, (200, OK, bad, None))[0] == ("SUCCESS", [(None, None), (3, None)], None)
    single = emit_rows(
        process_responses(responses(spark, (200, OK, body, None)), spec), spec.replace(max_rows_per_key=1)
    )
    assert [r.id for r in single.collect()] == [1]


def test_emission(spark):
    processed = process_responses(
        responses(spark, (404, OK, "", None), (200, OK, '{"id":1}', None), (None, None, None, "reset")), SPEC
    )
    assert [r.id for r in emit_rows(processed, SPEC).collect()] == [1]
    names = ["http-status-code", "http-completion-state", "error-string"]
    full = emit_rows(processed, SPEC, names).orderBy("request_id").collect()
    assert [tuple(r)[1:] for r in full] == [
        (None, None, 404, "IGNORE_STATUS_CODE", None),
        (1, None, 200, "SUCCESS", None),
        (None, None, None, "EXCEPTION", "reset"),
    ]


def test_fail_fast(spark):
    strict = SPEC.replace(continue_on_error=False)
    processed = process_responses(responses(spark, (500, OK, "broken", None)), strict)
    with pytest.raises(Exception, match="lookup failed: HTTP_ERROR_STATUS 500 broken"):
        emit_rows(fail_on_error(processed, strict), strict).count()


def test_pruned_schema():
    from pyspark.sql import types as T

    nested = T.StructType().add("b", T.IntegerType()).add("c", T.StringType())
    schema = T.StructType().add("x", T.IntegerType()).add("a", nested)
    assert pruned_schema(schema, ["a.c"]).simpleString() == "struct<a:struct<c:string>>"
    assert pruned_schema(schema, ["a", "a.c"]) == T.StructType([schema["a"]])
    with pytest.raises(ValueError):
        pruned_schema(schema, ["nope"])


@pytest.mark.parametrize(
    ("level", "headers", "body"),
    [(None, "***", "***"), ("MIN", "***", "***"), ("REQRESPONSE", "***", "x"), ("MAX", "bbb:[ccc;ddd];eee:[fff]", "x")],
)
def test_log_lines(one, level, headers, body):
    sent = F.expr("map('eee', array('fff'), 'bbb', array('ccc', 'ddd'))")
    url, none = F.lit("http://aaa"), F.expr("cast(map() as map<string,array<string>>)")
    assert one(request_line(F.lit("GET"), url, sent, level)) == f"HTTP GET Request: URL: http://aaa, Headers: {headers}"
    assert one(request_line(F.lit("GET"), url, none, level)).endswith("Headers: None")
    want = f"HTTP POST Response: URL: http://aaa, Response Headers: {headers}, status code: 200, Response Body: {body}"
    assert one(response_line(F.lit("POST"), url, sent, F.lit(200), F.lit("x"), level)) == want
    assert one(response_line(F.lit("POST"), url, sent, F.lit(200), F.lit(""), level)).endswith("Body: None")
