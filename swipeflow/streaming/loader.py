"""Event loading as a stream."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from swipeflow.operators.loads import EVENT_KEY, append_if_absent


def stream_load(stream: DataFrame, watermark: str = "25 hours", key: Sequence[str] = EVENT_KEY) -> DataFrame:
    """Events once per key, late ones accepted up to ``watermark`` behind the newest.

    State is kept for the watermark only. Input that is not roughly in time
    order (a backfill), or in which one event may be repeated very often,
    belongs to ``start_insert_ignore``: it has no lateness limit, and collapses
    copies before they are shuffled.
    """
    return stream.withWatermark("event_dt", watermark).dropDuplicatesWithinWatermark(list(key))


def start_insert_ignore(stream: DataFrame, target: str, checkpoint: str,
                        key: Sequence[str] = EVENT_KEY, fixed_time: str | None = None) -> StreamingQuery:
    """Appends each micro-batch's new events to a parquet table; processes what is there, then stops.

    Copies of a key collapse map-side inside the batch, and the rest is matched
    against the table, so a micro-batch that is run again after a failure adds nothing twice.
    With ``fixed_time`` (see append_if_absent) a micro-batch reads its own time range of the table only.
    """

    # An empty first write gives the table its schema, so that the first batch can read it too.
    session = stream.sparkSession
    session.createDataFrame([], stream.schema).write.mode("append").parquet(target)

    def write(batch: DataFrame, batch_id: int) -> None:
        held = batch.sparkSession.read.schema(batch.schema).parquet(target)
        append_if_absent(held, batch, key, fixed_time=fixed_time).write.mode("append").parquet(target)

    return (
        stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )
