"""Message-stream sources (A5) and bounded runs.

A stream is a streaming DataFrame with a ``value`` column holding one message.
Files (one JSON message per line) work everywhere; Kafka works when its
package is on the classpath. Offsets live in the query's checkpoint, and a
message counts as handled once the micro-batch that read it is committed, which
is what acknowledging after the write did (A7).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery


def message_stream(spark: SparkSession, path: str, fmt: str = "text", max_files_per_trigger: int | None = None,
                   options: dict[str, str] | None = None) -> DataFrame:
    """A5: messages from files under ``path`` (``fmt='text'``: one message per line)."""
    reader = spark.readStream.format(fmt)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", int(max_files_per_trigger))
    for k, v in (options or {}).items():
        reader = reader.option(k, v)
    return reader.load(path)


def kafka_stream(spark: SparkSession, servers: str, topic: str,
                 starting_offsets: str = "earliest") -> DataFrame:  # pragma: no cover - needs the Kafka jar
    """A5 on a Kafka topic; ``value`` is the message bytes (decoded by ``from_json`` after a cast)."""
    return (spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers)
            .option("subscribe", topic).option("startingOffsets", starting_offsets).load()
            .selectExpr("CAST(value AS STRING) AS value"))


def run_bounded(query: StreamingQuery, seconds: float) -> bool:
    """Let a query run for ``seconds``, then stop it and wait for the shutdown.

    Returns whether it ended by itself. A failure inside the query is raised.
    """
    finished = query.awaitTermination(seconds)
    if not finished:
        query.stop()
    exc = query.exception()
    if exc is not None:
        raise exc
    return bool(finished)


def run_available(query: StreamingQuery) -> None:
    """Run a query started with ``trigger(availableNow=True)`` to completion (tests, backfills)."""
    query.awaitTermination()
    exc = query.exception()
    if exc is not None:
        raise exc
