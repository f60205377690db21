"""Pipeline events in JSON: what was loaded, what to refresh, what failed."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salesmill.functions.json_find import json_find_all
from salesmill.functions.paths import decode_key, segment

LOAD_EVENT = (
    "struct<Records: array<struct<s3: struct<bucket: struct<name: string>,"
    " object: struct<key: string>>>>>"
)
FANOUT_EVENT = "struct<Records: array<struct<Sns: struct<Message: string>>>>"

# Place of the job name in a function ARN and of the company in an
# object key.
JOB_SEGMENT = 6
COMPANY_SEGMENT = 1

# Usual places in a failure event, which is parsed inside an array.
FILE_PATH = "$[0].requestPayload.Records[0].s3"
MESSAGE_PATH = "$[0].requestPayload.Records[0].Sns.Message"
ERROR_PATHS = {
    "errorMessage": "$[0].responsePayload.errorMessage",
    "errorType": "$[0].responsePayload.errorType",
    "stackTrace": "$[0].responsePayload.stackTrace",
}

# Wording of an alert.
ALERT_HEADING = "There was an error while executing Pipeline."
ALERT_RULE = "--------------------------------------------------------"


def parse_load_events(events: DataFrame, json_col: str) -> DataFrame:
    """Bucket, key and company of every record of the load events."""
    record = F.explode_outer(F.from_json(json_col, LOAD_EVENT)["Records"]).alias("record")
    return (
        events.select("*", record)
        .withColumn("bucket", F.col("record.s3.bucket.name"))
        .withColumn("object_key", decode_key(F.col("record.s3.object.key")))
        .withColumn("company_name", segment(F.col("object_key"), "/", COMPANY_SEGMENT))
        .drop("record")
    )


def parse_fanout(events: DataFrame, json_col: str) -> DataFrame:
    """Company of every record of the fan-out events, whose message is JSON text."""
    record = F.explode_outer(F.from_json(json_col, FANOUT_EVENT)["Records"]).alias("record")
    company = F.get_json_object("record.Sns.Message", "$.responsePayload.company_id")
    return events.select("*", record).withColumn("company_name", company).drop("record")


def _once(text: Column, key: str) -> Column:
    """How often a key stands in a JSON text as a whole string, at least 0 and at most 2."""
    quoted = f'"{key}"'
    rest = F.substring_index(text, quoted, 1)
    twice = F.substring_index(text, quoted, 2)
    return (F.length(rest) < F.length(text)).cast("int") + (F.length(twice) < F.length(text)).cast("int")


def _at(document: Column, path: str, kind: str) -> Column:
    """The value at a path of a parsed document if it has the wanted type."""
    value = F.try_variant_get(document, path, "variant")
    return F.when(F.schema_of_variant(value) == kind, F.try_variant_get(document, path, "string"))


def _document(text: Column) -> Column:
    """A JSON document, inside an array, or NULL unless the JVM reads it as Python does.

    The parser gives NULL for broken text and for a name that an object holds twice, but
    does not mind what follows. What may follow inside an array may not follow inside
    an object, so text that parses in both is a single document.
    """
    inside = F.try_parse_json(F.concat(F.lit("["), text, F.lit("]")))
    also = F.try_parse_json(F.concat(F.lit('{"d":'), text, F.lit("}")))
    return F.when(~F.contains(text, F.lit("\\u")) & also.isNotNull(), inside)


def _known_file(text: Column, document: Column) -> tuple[Column, Column, Column]:
    """Bucket and object key at the usual place of an event, and whether they are all there is."""
    bucket, key = (_at(document, f"{FILE_PATH}.{p}", "STRING") for p in ("bucket.name", "object.key"))
    sure = document.isNotNull() & (_once(text, "s3") == 1) & bucket.isNotNull() & key.isNotNull()
    return bucket, key, sure


def failure_alerts(events: DataFrame, json_col: str = "event") -> DataFrame:
    """One alert per failure event.

    Company and file come from the ``s3`` node. A failed report carries that node
    inside a message that is JSON text, so the message is opened where the event
    itself has none. The first place of a key counts, which takes a walk through the
    document; but where a key stands in the text once, at its usual path, nothing can
    come before it. Such events are read by built-in functions, and only the others go
    to Python, in one walk that opens the message, too.
    """
    raw = F.col("raw_event")
    parsed = events.select(F.col(json_col).alias("raw_event")).select(raw, _document(raw).alias("doc"))
    message = _at(F.col("doc"), MESSAGE_PATH, "STRING")
    opened = parsed.select("*", F.when(_once(raw, "Message") == 1, message).alias("message")).select(
        "*", _document(F.col("message")).alias("message_doc")
    )
    bucket, key, own = _known_file(raw, F.col("doc"))
    sent_bucket, sent_key, sent = _known_file(F.col("message"), F.col("message_doc"))
    sent = sent & (_once(raw, "s3") == 0)
    neither = (_once(raw, "s3") == 0) & (_once(raw, "Message") == 0)
    sure = F.col("doc").isNotNull() & (own | sent | neither)
    known = {"bucket": F.when(own, bucket).when(sent, sent_bucket), "key": F.when(own, key).when(sent, sent_key)}
    for name, path in ERROR_PATHS.items():
        value = _at(F.col("doc"), path, "STRING")
        if name == "stackTrace":
            lines = F.try_variant_get("doc", path, "array<string>")
            many = F.schema_of_variant(F.try_variant_get("doc", path, "variant")) == "ARRAY<STRING>"
            value = F.coalesce(value, F.when(many, F.array_join(lines, "\n")))
        known[name] = value
        sure = sure & ((_once(raw, name) == 0) | ((_once(raw, name) == 1) & value.isNotNull()))
    wanted = ["s3", "errorMessage", "errorType", "stackTrace"]
    judged = opened.select(
        "raw_event",
        F.coalesce(sure, F.lit(False)).alias("sure"),
        *(value.alias(f"known_{name}") for name, value in known.items()),
    )
    missed = json_find_all(F.when(~F.col("sure"), raw), wanted, inside={"s3": "Message"})
    found = judged.withColumn("found", missed)

    def either(name: str, value: Column) -> Column:
        return F.when(F.col("sure"), F.col(f"known_{name}")).otherwise(value)

    trace = F.array_join(F.from_json("found.stackTrace", "array<string>"), "\n")
    named = found.select(
        "raw_event",
        segment(F.get_json_object("raw_event", "$.requestContext.functionArn"), ":", JOB_SEGMENT)
        .alias("job"),
        either("bucket", F.get_json_object("found.s3", "$.bucket.name")).alias("bucket"),
        decode_key(either("key", F.get_json_object("found.s3", "$.object.key"))).alias("key"),
        either("errorType", F.col("found.errorType")).alias("error_type"),
        either("errorMessage", F.col("found.errorMessage")).alias("error_message"),
        either("stackTrace", F.coalesce(trace, "found.stackTrace")).alias("stack_trace"),
    )
    return named.select(
        "job",
        segment(F.col("key"), "/", COMPANY_SEGMENT).alias("company"),
        F.concat(F.lit("s3://"), "bucket", F.lit("/"), "key").alias("file"),
        "error_type",
        "error_message",
        "stack_trace",
        "raw_event",
    )


def alert_text(alerts: DataFrame) -> DataFrame:
    """Add the message to send. Lines without a value are left out."""
    event = json_find_all(F.col("raw_event"), [], pretty="event")["event"]
    from_file = F.col("file").isNotNull()
    lines = [
        F.lit(ALERT_HEADING),
        F.lit(""),
        F.concat(F.lit("Lambda: "), "job"),
        F.when(from_file, F.concat(F.lit("Company: "), "company")),
        F.when(from_file, F.concat(F.lit("Trigger File: "), "file")),
        F.when(from_file, F.lit("")),
        F.concat(F.lit("Error Type: "), "error_type", F.lit(".")),
        F.concat(F.lit('Error Message: "'), "error_message", F.lit('".')),
        F.concat(F.lit("Stack Trace: \n"), "stack_trace"),
        F.lit(""),
        F.lit(ALERT_RULE),
        F.coalesce(event, "raw_event"),
    ]
    return alerts.withColumn("alert_text", F.concat_ws("\n", *lines))
