"""Streaming sources of the bronze tables.

Every path, topic, format and schema is a parameter. A file source remembers
in the query's checkpoint which files it has read. CSV files are streamed by
name and read by their headers when a batch of them is stored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from callmeter.schemas import CALL_SCHEMA, FEEDBACK_SCHEMA, PRICING_SCHEMA
from callmeter.sources.csv_files import CsvStream, csv_stream


def _received(stream: DataFrame) -> DataFrame:
    return stream.withColumn("ingested_at", F.current_timestamp())


def calls_json(spark: SparkSession, path: str, **options) -> DataFrame:
    """New JSON files of calls. Options such as ``maxFilesPerTrigger`` bound a batch."""
    return _received(spark.readStream.schema(CALL_SCHEMA).options(**options).json(path))


def pricing_csv(spark: SparkSession, path: str, schema: StructType = PRICING_SCHEMA, **options) -> CsvStream:
    return csv_stream(spark, path, schema, **options)


def feedback_csv(spark: SparkSession, path: str, schema: StructType = FEEDBACK_SCHEMA, **options) -> CsvStream:
    return csv_stream(spark, path, schema, **options)


def kafka_messages(spark: SparkSession, servers: str, topic: str, **options) -> DataFrame:
    """Messages of a topic from its beginning; needs Spark's Kafka connector on the class path."""
    reader = spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers)
    return reader.option("subscribe", topic).option("startingOffsets", "earliest").options(**options).load()


def decode_calls(messages: DataFrame) -> DataFrame:
    """Calls from messages (``value`` binary, ``timestamp``), batch or stream.

    A payload that is no JSON object gives a row of NULLs, which the rules
    drop later.
    """
    call = F.from_json(F.col("value").cast("string"), CALL_SCHEMA)
    return messages.select(call.alias("call"), F.col("timestamp").alias("kafka_timestamp")).select(
        "call.*", "kafka_timestamp"
    )


def calls_kafka(messages: DataFrame) -> DataFrame:
    """Live calls from a message stream, of Kafka or of any source with the same two columns."""
    return _received(decode_calls(messages))
