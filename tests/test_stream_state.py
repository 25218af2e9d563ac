"""Mergeable stream state: sums by bucket (X1), distinct readings with a late side output (D5), subscription with ack."""

import os
import time

import pytest
from pyspark.sql import functions as F

from tempora.functions.timebuckets import bucket_start
from tempora.plans.weather_price import weather_bucket_averages
from tempora.sources.sinks import KeyedTable, SumTable
from tempora.streaming.bucket_stream import (
    averages_of,
    late_count,
    late_rows,
    start_bucket_averages,
    start_distinct,
)
from tempora.streaming.sources import run_available
from tempora.streaming.subscription import Queue, publish, run_until_empty, subscribe

SCHEMA = "dt bigint, id bigint, temp double"
AVERAGES = {"avg_temp": "temp"}


def drop(spark, rows, path):
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(path)
    time.sleep(0.05)  # the file source reads in the order of modification times


def stream(spark, path):
    return spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(path)


def batch_averages(spark, path):
    return {(r.dt, r.avg_temp) for r in weather_bucket_averages(spark.read.parquet(path), averages=AVERAGES, drop=[]).where("dt IS NOT NULL").collect()}


def served(spark, table, **scales):
    return {(r.dt, r.avg_temp) for r in averages_of(table.read(spark), "dt", AVERAGES, **scales).collect()}


def test_sums_over_restarts_equal_batch_and_read_only_new_rows(spark, scratch):
    """Copies of a bucket come in other micro-batches and at other seconds; nulls; a day that grows."""
    table = SumTable(f"{scratch}/sums", keys=["dt"], compact_every=4)
    base = 1_700_000_100
    for k in range(6):
        rows = [(base + 60 * i + k, i % 4, None if i % 7 == 0 else i / 4) for i in range(40)]
        drop(spark, [*rows, (None, 1, 2.0), (base, 9, None)], f"{scratch}/in")
        q = start_bucket_averages(stream(spark, f"{scratch}/in"), AVERAGES, table, f"{scratch}/ckpt", available_now=True)
        run_available(q)
        assert served(spark, table) == batch_averages(spark, f"{scratch}/in")
        assert sum(p["numInputRows"] for p in q.recentProgress) == 42  # this drop's rows, however many came before
    assert len(table.applied_batches(spark)) < 6  # compacted on the way


def test_exact_sums_do_not_depend_on_the_order(spark, scratch):
    base, scales = 1_700_000_100, {"avg_temp": 2}
    rows = [(base + i, i, round(0.1 * i * (-1) ** i + 1e6, 2)) for i in range(90)]
    got = []
    for name, parts in (("a", [rows[:30], rows[30:]]), ("b", [rows[::-1][:50], rows[::-1][50:]])):
        for part in parts:
            drop(spark, part, f"{scratch}/{name}")
        table = SumTable(f"{scratch}/sums_{name}", keys=["dt"])
        run_available(start_bucket_averages(stream(spark, f"{scratch}/{name}"), AVERAGES, table, f"{scratch}/ckpt_{name}",
                                            exact_scales=scales, available_now=True))
        got.append(served(spark, table, exact_scales=scales))
    assert got[0] == got[1] and len(got[0]) == 1


def test_a_failure_after_the_write_counts_nothing_twice(spark, scratch, monkeypatch):
    base = 1_700_000_100
    drop(spark, [(base + i, i, float(i)) for i in range(10)], f"{scratch}/in")
    table = SumTable(f"{scratch}/sums", keys=["dt"])
    write = SumTable.upsert_stream_batch

    def failing(self, df, batch_id, stream=None):
        write(self, df, batch_id, stream)
        raise RuntimeError("lost after the write")

    monkeypatch.setattr(SumTable, "upsert_stream_batch", failing)
    with pytest.raises(Exception, match="lost after the write"):
        run_available(start_bucket_averages(stream(spark, f"{scratch}/in"), AVERAGES, table, f"{scratch}/ckpt", available_now=True))
    monkeypatch.undo()
    drop(spark, [(base + i, i, float(i)) for i in range(5, 15)], f"{scratch}/in")
    run_available(start_bucket_averages(stream(spark, f"{scratch}/in"), AVERAGES, table, f"{scratch}/ckpt", available_now=True))
    assert served(spark, table) == batch_averages(spark, f"{scratch}/in")


def test_a_fresh_checkpoint_on_old_sums_is_refused(spark, scratch):
    drop(spark, [(1_700_000_100, 1, 1.0)], f"{scratch}/in")
    table = SumTable(f"{scratch}/sums", keys=["dt"])
    run_available(start_bucket_averages(stream(spark, f"{scratch}/in"), AVERAGES, table, f"{scratch}/a", available_now=True))
    with pytest.raises(Exception, match="fresh table"):
        run_available(start_bucket_averages(stream(spark, f"{scratch}/in"), AVERAGES, table, f"{scratch}/b", available_now=True))
    assert served(spark, table) == batch_averages(spark, f"{scratch}/in")


def test_distinct_with_a_delay_and_its_late_rows(spark, scratch):
    hour = 3_600
    start = 1_700_000_400 // hour * hour
    drops = [
        [(start, 1, 1.0), (start + 7, 1, 1.0), (start, 2, 2.0)],                  # a copy within the bucket
        [(start + 20, 1, 1.0), (start + 5 * hour, 3, 3.0)],                       # a copy in a later drop; time moves on
        [(start + 6 * hour, 4, 4.0)],
        [(start + 8, 5, 5.0), (start + 30, 2, 2.0), (start + 6 * hour + 4, 4, 4.0), (None, 6, 6.0)],  # late, a late copy, a copy, no time
        [(start + 5 * hour + 1, 7, 7.0)],                                          # old, but within the delay
    ]
    for rows in drops:
        drop(spark, rows, f"{scratch}/in")
    q = start_distinct(stream(spark, f"{scratch}/in"), f"{scratch}/kept", f"{scratch}/ckpt", delay="2 hours", available_now=True)
    run_available(q)
    kept = spark.read.parquet(f"{scratch}/kept").drop("stream", "batch")
    landed = spark.read.parquet(f"{scratch}/in")
    assert sorted(r.id for r in kept.collect()) == [1, 2, 3, 4, 7]
    late = late_rows(landed, kept)
    assert [(r.id, r.temp) for r in late.collect()] == [(5, 5.0)]
    assert late_count(q) == 2  # the late reading and the late copy of one that was kept
    batch = landed.where("dt IS NOT NULL").withColumn("dt", bucket_start("dt", 300)).distinct()
    assert sorted(map(str, kept.unionByName(late).collect())) == sorted(map(str, batch.collect()))


def test_distinct_state_is_forgotten_with_the_delay(spark, scratch):
    start = 1_700_000_400 // 3_600 * 3_600
    for k in range(8):
        drop(spark, [(start + 3_600 * k + i, i, float(i)) for i in range(5)], f"{scratch}/in")
    q = start_distinct(stream(spark, f"{scratch}/in"), f"{scratch}/kept", f"{scratch}/ckpt", delay="1 hour", available_now=True)
    run_available(q)
    assert q.recentProgress[-1]["stateOperators"][0]["numRowsTotal"] <= 15  # of 40 distinct readings
    assert spark.read.parquet(f"{scratch}/kept").count() == 40


# ---------------------------------------------------------------------------
# Subscription.
# ---------------------------------------------------------------------------
def send(spark, queue, ids, files=2):
    publish(spark.createDataFrame([(f'{{"id": {i}}}',) for i in ids], "value string").repartition(files), queue)


def pull(spark, queue, table, checkpoint, fail=False):
    def handle(batch, batch_id):
        table.upsert_stream_batch(batch.select(F.get_json_object("value", "$.id").cast("int").alias("id"), "message_id"), batch_id)
        if fail:
            raise RuntimeError("lost before the commit")

    return run_until_empty(subscribe(spark, queue).writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint)
                           .trigger(availableNow=True).start)


def held(spark, table):
    return sorted(r.id for r in table.read(spark).collect())


def test_messages_are_acknowledged_after_the_commit(spark, scratch):
    queue, table = f"{scratch}/queue", KeyedTable(f"{scratch}/t", keys=["id"])
    for k in range(4):
        send(spark, queue, range(10 * k, 10 * k + 10))
        assert pull(spark, queue, table, f"{scratch}/ckpt") == 10
        assert held(spark, table) == list(range(10 * k + 10))
    # All but the last micro-batch's, which the next one will acknowledge, have left the queue.
    assert Queue(queue).acked() >= 3 and len(Queue(queue).waiting()) <= 2
    assert set(Queue(queue).waiting()) == {n for files in Queue(queue).deliveries().values() for n in files}


def test_a_failure_between_write_and_commit_loses_and_doubles_nothing(spark, scratch):
    queue, table = f"{scratch}/queue", KeyedTable(f"{scratch}/t", keys=["message_id"])
    send(spark, queue, range(20))
    with pytest.raises(Exception, match="lost before the commit"):
        pull(spark, queue, table, f"{scratch}/ckpt", fail=True)
    assert Queue(queue).acked() == 0 and len(Queue(queue).waiting()) == 2
    send(spark, queue, range(20, 25))
    assert pull(spark, queue, table, f"{scratch}/ckpt") == 25  # the failed micro-batch again, then the new messages
    assert held(spark, table) == list(range(25))
    assert len(table.applied_batches(spark)) == 2
    # Another subscriber's checkpoint gets what nobody has acknowledged, with the same message ids.
    left = {n for files in Queue(queue).deliveries().values() for n in files}
    pull(spark, queue, table, f"{scratch}/fresh")
    assert held(spark, table) == list(range(25)) and len(left) <= 4


def test_queue_records(scratch):
    queue = Queue(f"{scratch}/q")
    os.makedirs(f"{scratch}/q/_temporary")
    for name in ("b", "a", ".hidden", "_SUCCESS"):
        with open(f"{scratch}/q/{name}", "w") as f:
            f.write("x\n")
    assert queue.deliver(1) == 1 and queue.deliver(1) == 2 and queue.deliver(None) == 2
    assert queue.deliveries() == {1: {"a": 2}, 2: {"b": 2}}
    with open(f"{scratch}/q/0", "w") as f:  # a name before the others still comes
        f.write("y\n")
    assert queue.deliver(None) == 3
    queue.acknowledge(2)
    assert set(queue.waiting()) == {"0"} and queue.acked() == 2 and list(queue.deliveries()) == [3]
    queue.acknowledge(1)
    queue.acknowledge(2)
    assert queue.acked() == 2
    os.remove(f"{scratch}/q/0")  # removed by an acknowledgement that crashed before its record
    queue.acknowledge(3)
    assert queue.acked() == 3 and queue.deliver(None) == 3 and queue.deliveries() == {}
