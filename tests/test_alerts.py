"""Load, fan-out and failure events."""

import json
import pathlib
from urllib.parse import unquote_plus

import pytest
from conftest import rows
from pyspark.sql import functions as F

from salesmill import alert_text, failure_alerts, parse_fanout, parse_load_events
from salesmill.functions import json_find_first
from salesmill.sinks.alert_table import alert_table
from salesmill.streaming.event_log import run_alerts

S3 = {"bucket": {"name": "sales"}, "object": {"key": "sales_records_in/g+a%2Bb/c.csv"}}
ARN = "arn:aws:lambda:zone:acct:function:cleanSales:$LATEST"


def events(spark, *documents):
    return spark.createDataFrame([(json.dumps(d),) for d in documents], "event string")


def test_load_events(spark):
    two = {"Records": [{"s3": S3}, {"s3": {**S3, "object": {"key": "x/y/z"}}}]}
    got = parse_load_events(events(spark, two, {"other": 1}), "event")
    assert rows(got, "bucket", "object_key", "company_name") == [
        ("sales", "sales_records_in/g a+b/c.csv", "g a+b"),
        ("sales", "x/y/z", "y"),
        (None, None, None),
    ]


def test_fanout(spark):
    message = json.dumps({"responsePayload": {"company_id": 'a "b"'}})
    got = parse_fanout(events(spark, {"Records": [{"Sns": {"Message": message}}]}), "event")
    assert rows(got, "company_name") == [('a "b"',)]


def test_failures(spark):
    error = {"errorMessage": "no", "errorType": "ValueError", "stackTrace": ["a", "b"]}
    context = {"requestContext": {"functionArn": ARN}}
    message = json.dumps({"requestPayload": {"Records": [{"s3": S3}]}})
    load = {**context, "requestPayload": {"Records": [{"s3": S3}]}, "responsePayload": error}
    report = {**context, "requestPayload": {"Records": [{"Sns": {"Message": message}}]}}
    plain = {**context, "responsePayload": {"errorMessage": "no", "stackTrace": "one text"}}
    got = failure_alerts(events(spark, load, report, plain, {}))
    file = "s3://sales/sales_records_in/g a+b/c.csv"
    columns = ["job", "company", "file", "error_type", "error_message", "stack_trace"]
    assert rows(got, *columns) == [
        ("cleanSales", "g a+b", file, "ValueError", "no", "a\nb"),
        ("cleanSales", "g a+b", file, None, None, None),
        ("cleanSales", None, None, None, "no", "one text"),
        (None,) * 6,
    ]


def test_alert_text(spark):
    event = {"requestContext": {"functionArn": ARN}, "x": [{"errorType": "Oops"}]}
    text = alert_text(failure_alerts(events(spark, event))).first().alert_text
    assert text == (
        "There was an error while executing Pipeline.\n\nLambda: cleanSales\n"
        "Error Type: Oops.\n\n" + "-" * 56 + "\n" + json.dumps(event, indent=2)
    )


def test_half_a_surrogate_pair_is_no_end_of_the_job(spark):
    event = '{"errorMessage": "bad \\ud800 text", "errorType": "E", "stackTrace": ["at \\udc00"]}'
    events = spark.createDataFrame([(event,)], "event string")
    assert events.select(json_find_first(F.col("event"), "errorMessage")).first()[0] == "bad ? text"


def python_nodes(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return plan.count("ArrowEvalPython")


def test_one_walk_in_python_and_none_for_load_events(spark):
    """However a node is found, the JVM's answer is that of the walk."""
    got = failure_alerts(events(spark, {}))
    assert python_nodes(got) == 1
    assert python_nodes(parse_load_events(events(spark, {}), "event")) == 0


def plain_alert(text):
    """Company, file and error of an event by a walk through the parsed document."""
    from salesmill.functions.json_find import first_values, plain_text

    try:
        document = json.loads(text)
    except ValueError:
        return (None,) * 4
    found = first_values(document, ["s3", "Message", "errorType", "errorMessage", "stackTrace"])
    if "s3" not in found and "Message" in found:
        try:
            found |= first_values(json.loads(plain_text(found["Message"])), ["s3"])
        except ValueError:
            pass
    node = found.get("s3") or {}
    bucket, key = node.get("bucket", {}).get("name"), node.get("object", {}).get("key")
    file = None if bucket is None or key is None else f"s3://{bucket}/{unquote_plus(key)}"
    trace = found.get("stackTrace")
    trace = "\n".join(trace) if isinstance(trace, list) else trace
    return file, found.get("errorType"), found.get("errorMessage"), trace


def test_jvm_and_python_agree_on_odd_events(spark):
    error = {"errorMessage": "no\n\t\"x\" \\ y/z", "errorType": "E", "stackTrace": ["a \"b\"", "c"]}
    load = {"requestPayload": {"Records": [{"s3": S3}]}, "responsePayload": error}
    other = {"bucket": {"name": "first"}, "object": {"key": "a/b/c"}}
    message = json.dumps(load)
    documents = [
        load,
        {"before": {"s3": other}, **load},
        {**load, "after": {"s3": other}},
        {"requestPayload": {"Records": [{"Sns": {"Message": message}}]}, "responsePayload": error},
        {"requestPayload": {"Records": [{"Sns": {"Message": "not json"}}]}, "responsePayload": error},
        {"requestPayload": {"Records": [{"Sns": {"Message": message}}], "deep": [{"s3": other}]}},
        {"x": [{"Message": message}], "errorType": "top", "responsePayload": error},
        {"requestPayload": {"Records": [{"s3": None}]}, "other": {"s3": other}},
        {"responsePayload": {**error, "errorType": None}},
        {"responsePayload": {**error, "errorMessage": "s3"}, "requestPayload": {"Records": [{"s3": S3}]}},
        {"responsePayload": {"errorMessage": "ä é 日本", "stackTrace": "one"}},
        {"responsePayload": {"errorMessage": "", "stackTrace": []}},
    ]
    texts = [json.dumps(d) for d in documents] + [json.dumps(d, ensure_ascii=False) for d in documents]
    whole = texts[0]
    texts += [whole + " ", whole + " x", whole + " {}", whole + '] {"a": 1}', whole + ',"e":{}', whole[:-1], "", "[1]"]
    texts += [whole.replace('"errorType"', '"errorType": "first", "errorType"'), whole.replace("bucket", "\\u0062ucket")]
    frame = spark.createDataFrame([(t,) for t in texts], "event string")
    got = {r.raw_event: r for r in failure_alerts(frame).collect()}
    for text in texts:
        row = got[text]
        assert (row.file, row.error_type, row.error_message, row.stack_trace) == plain_alert(text), text


@pytest.fixture
def logged(layout):
    def write(name, *documents):
        folder = pathlib.Path(layout.events)
        folder.mkdir(parents=True, exist_ok=True)
        folder.joinpath(name).write_text("".join(json.dumps(d) + "\n" for d in documents) + "\n")

    return write


def failure(n):
    error = {"errorMessage": f"no {n}", "errorType": "ValueError", "stackTrace": ["a"]}
    request = {"Records": [{"s3": {**S3, "object": {"key": f"in/shop {n}/x.csv"}}}]}
    return {"requestContext": {"functionArn": ARN}, "requestPayload": request, "responsePayload": error}


def test_event_files_become_alerts_once(spark, layout, logged):
    logged("1.json", failure(1), failure(2))
    logged("2.json", failure(3))
    run_alerts(spark, layout, max_files=1)
    columns = ["job", "company", "file", "error_message"]
    expected = [("cleanSales", f"shop {n}", f"s3://sales/in/shop {n}/x.csv", f"no {n}") for n in (1, 2, 3)]
    assert rows(alert_table(spark, layout.alerts), *columns) == expected
    run_alerts(spark, layout)
    logged("3.json", failure(4))
    run_alerts(spark, layout)
    assert alert_table(spark, layout.alerts).count() == 4


def test_a_replayed_batch_of_events_adds_nothing(spark, layout, logged, monkeypatch):
    """The first try dies after its alerts are written, before the stream notes its end."""
    from salesmill.streaming import event_log

    logged("1.json", failure(1), failure(2))
    write = event_log.write_alerts

    def lost(*args):
        write(*args)
        raise RuntimeError("lost")

    with monkeypatch.context() as patched:
        patched.setattr(event_log, "write_alerts", lost)
        with pytest.raises(Exception, match="lost"):
            run_alerts(spark, layout)
    assert alert_table(spark, layout.alerts).count() == 2
    run_alerts(spark, layout)
    assert alert_table(spark, layout.alerts).count() == 2
    assert alert_table(spark, layout.alerts).select("batch_id").distinct().count() == 1
