"""Inbound text messages: append log and running subscriber state."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from ticketlens.functions import wall_clock
from ticketlens.operators.sms import clean_messages, emails_by_number, fill_email, message_email, sms_subscribers
from ticketlens.schemas import MESSAGE_JSON, MESSAGES, SUBSCRIBERS
from ticketlens.semantics import STOP_PATTERN
from ticketlens.sources import deltas

# Request parameter of each message column.
MESSAGE_FIELDS = {
    "mobile_number": "m",
    "keyword": "k",
    "security_code": "s",
    "campaign": "c",
    "body": "b",
    "email": "e",
}


def message_rows(requests: DataFrame) -> DataFrame:
    """Requests with one-letter fields to message rows; emails in join-key form, blank ones missing."""
    columns = [F.col(letter).alias(name) for name, letter in MESSAGE_FIELDS.items() if name != "email"]
    return requests.select(
        *columns, message_email(F.col("e")).alias("email"), wall_clock(F.col("t")).alias("timestamp")
    )


def read_message_requests(spark: SparkSession, source: str, files_per_trigger: int = 1000) -> DataFrame:
    stream = spark.readStream.schema(MESSAGE_JSON).option("maxFilesPerTrigger", files_per_trigger)
    return message_rows(stream.json(source))


def stream_messages(messages: DataFrame, sink: str, checkpoint: str) -> StreamingQuery:
    """Append arriving messages to the log, then stop when the backlog is done.

    The file sink records what it committed, so a restart repeats nothing.
    """
    return (
        messages.writeStream.format("parquet")
        .option("path", sink)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )


def message_log(spark: SparkSession, source: str, schema: StructType = MESSAGES) -> DataFrame:
    """The message log as a stream."""
    return spark.readStream.schema(schema).parquet(source)


def subscriber_stream(
    messages: DataFrame,
    stop_pattern: str = STOP_PATTERN,
    crm_contacts: DataFrame | None = None,
    wide: DataFrame | None = None,
) -> DataFrame:
    """Running subscriber rows, the batch aggregate on a stream.

    With CRM contacts and the wide table, missing emails are filled as in the batch
    job, from the state of these tables when the micro-batch runs.
    """
    if crm_contacts is not None and wide is not None:
        known = emails_by_number(crm_contacts, wide)
        messages = fill_email(clean_messages(messages).join(known, "mobile_number", "left"))
    return sms_subscribers(messages, stop_pattern)


def stream_sms_subscribers(
    messages: DataFrame,
    root: str,
    checkpoint: str,
    stop_pattern: str = STOP_PATTERN,
    crm_contacts: DataFrame | None = None,
    wide: DataFrame | None = None,
    compact_every: int = 16,
) -> StreamingQuery:
    """Keep the subscriber table at ``root`` up to date from a message stream, as a delta log.

    Each micro-batch brings the full current row of every number it touched and appends only
    these rows (:mod:`ticketlens.sources.deltas`); readers keep the latest batch's row of a number.
    After ``compact_every`` pending batches the log is folded into a new base. A replayed batch
    finds its delta written and adds nothing.
    """

    def apply(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        deltas.append(batch, root, batch_id, ["mobile_number"], SUBSCRIBERS)
        if deltas.pending(spark, root) >= compact_every:
            deltas.compact(spark, root)

    return (
        subscriber_stream(messages, stop_pattern, crm_contacts, wide)
        .writeStream.outputMode("update")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .foreachBatch(apply)
        .start()
    )
