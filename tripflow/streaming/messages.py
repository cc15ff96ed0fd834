"""JSON messages on a topic: encode, decode, quarantine, resume."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tripflow.functions import decode_json, encode_json
from tripflow.functions.scalars import CORRUPT


def encode_messages(df: DataFrame, key: str | None = None) -> DataFrame:
    """Each row as one JSON ``value``, with an optional message ``key``."""
    value = encode_json(*df.columns).alias("value")
    if key is None:
        return df.select(value)
    return df.select(F.col(key).cast("string").alias("key"), value)


def decode_messages(df: DataFrame, schema: T.StructType, value: str = "value") -> DataFrame:
    """Message fields as columns, other columns kept, bad text in ``malformed``.

    A malformed message does not stop the stream; its text is kept for
    the quarantine and its fields are NULL.
    """
    others = [c for c in df.columns if c != value]
    text = F.col(value).cast("string")
    decoded = df.select(*others, decode_json(text, schema).alias("_message"))
    return decoded.select(
        *others,
        *(F.col(f"_message.{name}").alias(name) for name in schema.names),
        F.col(f"_message.{CORRUPT}").alias("malformed"),
    )


def well_formed(decoded: DataFrame) -> DataFrame:
    return decoded.filter(F.col("malformed").isNull()).drop("malformed")


def quarantined(decoded: DataFrame) -> DataFrame:
    return decoded.filter(F.col("malformed").isNotNull()).select("malformed")


def topic_options(servers: str, topic: str, earliest: bool = True, **extra: str) -> dict[str, str]:
    return {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": "earliest" if earliest else "latest",
        **extra,
    }


def read_topic(
    spark: SparkSession,
    servers: str,
    topic: str,
    group: str | None = None,
    messages_at_once: int | None = None,
    **extra: str,
) -> DataFrame:
    """Messages of a topic from its start. Needs the Kafka connector on the class path.

    ``messages_at_once`` bounds a micro-batch, the first one over a long
    history too; the rest waits for the next one.
    """
    if group:
        extra["kafka.group.id"] = group
    if messages_at_once is not None:
        extra["maxOffsetsPerTrigger"] = str(messages_at_once)
    options = topic_options(servers, topic, **extra)
    return spark.readStream.format("kafka").options(**options).load()


def write_topic(messages: DataFrame, servers: str, topic: str, checkpoint: str) -> StreamingQuery:
    """Send encoded messages to a topic, at least once."""
    return (
        messages.writeStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("topic", topic)
        .option("checkpointLocation", checkpoint)
        .start()
    )


def read_text_files(
    spark: SparkSession, path: str, files_at_once: int | None = None
) -> DataFrame:
    """A folder of JSON lines as a stream of ``value``.

    ``files_at_once`` bounds a micro-batch; the rest waits for the next one.
    """
    reader = spark.readStream
    if files_at_once is not None:
        reader = reader.option("maxFilesPerTrigger", files_at_once)
    return reader.text(path)


def store_messages(
    decoded: DataFrame, path: str, checkpoint: str, once: bool = True
) -> StreamingQuery:
    """Append decoded messages to Parquet, good and malformed apart.

    The file sink commits each micro-batch in its own log and the checkpoint
    holds the position, so a restart neither loses nor repeats a message.
    ``once`` drains what is there and stops; otherwise the query keeps running.
    """
    flagged = decoded.withColumn("is_malformed", F.col("malformed").isNotNull())
    writer = (
        flagged.writeStream.format("parquet")
        .partitionBy("is_malformed")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
    )
    return (writer.trigger(availableNow=True) if once else writer).start()


def read_stored(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path).drop("is_malformed")


def for_each_batch(
    decoded: DataFrame,
    action: Callable[[DataFrame, int], None],
    checkpoint: str,
    once: bool = True,
) -> StreamingQuery:
    """Run an action per micro-batch.

    A batch can be replayed after a failure: the action must be idempotent for
    its batch id.
    """
    writer = decoded.writeStream.foreachBatch(action).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer).start()


def print_messages(decoded: DataFrame, checkpoint: str, once: bool = False) -> StreamingQuery:
    """Show each decoded message on the console; for debugging."""
    writer = (
        decoded.writeStream.format("console")
        .option("truncate", False)
        .option("checkpointLocation", checkpoint)
    )
    return (writer.trigger(availableNow=True) if once else writer).start()
