"""Logged failures to alerts: files of failure events, read as a stream.

Each line of an event file is one event in JSON. Files should be moved into the folder
complete; they stay there, and the stream's checkpoint knows which it has read.
"""

from __future__ import annotations

from concurrent.futures import Future

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from salesmill.operators.alerts import failure_alerts
from salesmill.sinks.alert_table import write_alerts
from salesmill.sources.files import make_folder
from salesmill.streaming.ingest import Layout


def alert_batch(events: DataFrame, batch_id: str, layout: Layout) -> None:
    """The alerts of one batch of events, in a folder of their own.

    A batch that is run again, as its end was not recorded, writes the same folder.
    Blank lines are no events.
    """
    lines = events.select(F.col("value").alias("event")).filter(F.trim("event") != "")
    write_alerts(failure_alerts(lines), layout.alerts, batch_id)


def start_alerts(spark: SparkSession, layout: Layout, max_files: int = 1000) -> StreamingQuery:
    """Read the event files that wait, at most ``max_files`` at a time.

    Batch names join the identity of the checkpoint with the batch number.
    """
    make_folder(spark, layout.events)
    events = (
        spark.readStream.format("text")
        .option("recursiveFileLookup", "true")
        .option("maxFilesPerTrigger", max_files)
        .load(layout.events)
    )
    identity: Future[str] = Future()

    def store(batch: DataFrame, number: int) -> None:
        alert_batch(batch, f"events-{identity.result()}-{number:09d}", layout)

    query = (
        events.writeStream.foreachBatch(store)
        .option("checkpointLocation", layout.event_checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    identity.set_result(query.id)
    return query


def run_alerts(spark: SparkSession, layout: Layout, max_files: int = 1000) -> None:
    """Turn all event files that wait into alerts, and return when it is done."""
    start_alerts(spark, layout, max_files).awaitTermination()
