"""Landing job (A12): messages -> flattened, name-cleaned Parquet drops named by time.

Each micro-batch becomes one drop folder ``<yyyy-MM-dd-HH-mm-ss><batch id>-<stream>``
(the layout the newest-drop reader expects). The name's time is the newest
message time in the batch, so drop names order like their content; a replayed
batch rewrites the same folder. Messages that don't parse or have no time go,
with their text, to a reject table: messages in = rows landed + rows rejected.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tempora.constants import PRICE_TIME_COLUMN, PRICE_VALUE_COLUMN
from tempora.functions.anyjson import flatten_any
from tempora.functions.timebuckets import ACCEPTED_TIME_FORMATS, parse_time_epoch
from tempora.sources.sinks import stream_id
from tempora.streaming.messages import parse_price_messages, parse_weather_messages


def drop_name(newest_epoch: int, batch_id: int) -> str:
    import datetime as _dt

    t = _dt.datetime.fromtimestamp(int(newest_epoch), tz=_dt.timezone.utc)
    return t.strftime("%Y-%m-%d-%H-%M-%S") + f"{int(batch_id):08d}"


def landable(messages: DataFrame, kind: str = "weather") -> DataFrame:
    """Parsed messages with their text (``value``), ``_time`` (epoch seconds) and ``_malformed``."""
    if kind == "weather":
        parsed = parse_weather_messages(messages, keep=["value"]).drop("weather")
        return parsed.withColumn("_time", F.col("dt"))
    if kind == "prices":
        parsed = parse_price_messages(messages, keep=["value"])
        return parsed.withColumns({"_time": parse_time_epoch(PRICE_TIME_COLUMN, ACCEPTED_TIME_FORMATS),
                                   "_malformed": F.col(PRICE_VALUE_COLUMN).isNull()})
    raise ValueError(f"kind must be weather or prices, not {kind!r}")


def land_batch(parsed: DataFrame, directory: str, batch_id: int, partition_by_day: bool = False,
               stream: str = "direct", rejects: str | None = None) -> str | None:
    """Write one batch of ``landable`` messages as a drop; returns its name (None if no message can be landed).

    With ``partition_by_day`` the drop is partitioned by the UTC day of the message
    (a ``day=`` folder per day), so readers of a date range only open those
    folders (partition pruning). The rest goes to ``rejects`` (``<directory>_rejects``).
    """
    directory = directory.rstrip("/")
    bad = F.coalesce(F.col("_malformed"), F.lit(True)) | F.col("_time").isNull()
    good = parsed.where(~bad)
    newest, n_bad = parsed.agg(F.max(F.when(~bad, F.col("_time"))), F.count_if(bad)).first()
    if n_bad:
        parsed.where(bad).select("value").write.mode("overwrite").parquet(
            f"{rejects or directory + '_rejects'}/stream={stream}/batch_id={int(batch_id)}")
    if newest is None:
        return None
    name = f"{drop_name(newest, batch_id)}-{stream}"
    out = good.drop("_malformed", "_time", "value")
    if partition_by_day:
        days = good.withColumn("day", F.to_date(F.timestamp_seconds("_time"))).drop("_malformed", "_time", "value")
        days.write.mode("overwrite").partitionBy("day").parquet(f"{directory}/{name}")
    else:
        out.write.mode("overwrite").parquet(f"{directory}/{name}")
    return name


def land_any_batch(messages: DataFrame, directory: str, batch_id: int, stream: str = "direct", time_col: str = "dt",
                   rejects: str | None = None) -> str | None:
    """``land_batch`` for messages whose keys nobody has listed: every key of the batch is a column of the drop.

    Messages that are no JSON object, or whose ``time_col`` (epoch seconds, after flattening) is missing or no
    number, go to the rejects. Other drops may have other columns: read them with ``mergeSchema``.
    """
    flat = flatten_any(messages, keep=["value"])
    time = F.col(time_col).try_cast("long") if time_col in flat.columns else F.lit(None).cast("long")
    return land_batch(flat.withColumn("_time", time), directory, batch_id, stream=stream, rejects=rejects)


def start_landing(messages: DataFrame, directory: str, checkpoint: str, available_now: bool = False,
                  partition_by_day: bool = False, kind: str = "weather", rejects: str | None = None) -> StreamingQuery:
    """Land a message stream; ``kind`` is weather, prices or any (``land_any_batch``)."""
    parsed = messages.select("value") if kind == "any" else landable(messages, kind)

    def handle(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()  # read more than once: newest time for the name, keys, then the writes
        stream = stream_id(batch.sparkSession) or "direct"
        try:
            if kind == "any":
                land_any_batch(batch, directory, batch_id, stream, rejects=rejects)
            else:
                land_batch(batch, directory, batch_id, partition_by_day, stream, rejects)
        finally:
            batch.unpersist()

    writer = parsed.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint)
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()
