"""Newest drop (A2, drops fixture), CSV city list (L11), keyed upsert (A9/A10, same_key_batch)."""

import os

import pytest
from pyspark.sql import functions as F

from tempora.plans.cities import country_cities
from tempora.sources.files import newest_drop_name, read_newest_drop
from tempora.sources.sinks import KeyedTable


def test_newest_drop_name_rules():
    names = ["2022-12-17-05-12-13aaa", "2022-12-18-01-00-00bbb", "2022-12-18-01-00-00ccc"]
    assert newest_drop_name(names) == "2022-12-18-01-00-00bbb"  # first wins on a tie
    with pytest.raises(ValueError):
        newest_drop_name(names + ["README"])
    assert newest_drop_name(names + ["README"], strict=False) == "2022-12-18-01-00-00bbb"
    with pytest.raises(ValueError):
        newest_drop_name([])


def test_read_newest_drop_file_or_directory(spark, scratch):
    # drops fixture: two directories and one single file; only the newest is read.
    spark.createDataFrame([(1,)], "v int").write.parquet(f"{scratch}/2022-12-17-05-12-13x")
    spark.createDataFrame([(2,)], "v int").write.parquet(f"{scratch}/2022-12-18-05-12-13y")
    spark.createDataFrame([(3,)], "v int").coalesce(1).write.parquet(f"{scratch}/_tmp")
    part = [f for f in os.listdir(f"{scratch}/_tmp") if f.endswith(".parquet")][0]
    os.link(f"{scratch}/_tmp/{part}", f"{scratch}/2022-12-19-00-00-00z.parquet")
    assert [r.v for r in read_newest_drop(spark, scratch).collect()] == [3]


def test_city_list_csv(spark, scratch):
    path = f"{scratch}/cities.csv"
    with open(path, "w") as f:
        f.write("Geoname ID;Name;ASCII Name;Alternate Names;Country name EN;Coordinates\n")
        f.write("2800866;Brussels;Brussels;Bruxelles;Belgium;50.85045,4.34878\n")
        f.write("2759794;Amsterdam;Amsterdam;;Netherlands;52.37403,4.88969\n")
    got = country_cities(spark, path, "Belgium").collect()
    assert [(r["Geoname ID"], r["Name"], r.lat, r.lon) for r in got] == [(2800866, "Brussels", 50.85045, 4.34878)]
    assert "Alternate Names" not in country_cities(spark, path, "Belgium").columns
    with pytest.raises(ValueError):
        country_cities(spark, path, "France")  # no city: the collector stops


def test_keyed_table_same_key_batch_and_replay(spark, scratch):
    t = KeyedTable(f"{scratch}/preds", keys=["dt", "id"], order=["seq"])
    b0 = spark.createDataFrame([(1, 1, 0, 10.0), (1, 1, 1, 11.0), (2, 1, 0, 20.0)],
                               "dt int, id int, seq int, prediction double")
    t.write_batch(b0, 0)
    t.write_batch(b0, 0)  # replay of the same batch: no duplicate
    state = {(r.dt, r.id): r.prediction for r in t.read(spark).collect()}
    assert state == {(1, 1): 11.0, (2, 1): 20.0}
    b1 = spark.createDataFrame([(2, 1, 5, 21.0), (3, 1, 0, 30.0)], "dt int, id int, seq int, prediction double")
    t.write_batch(b1, 1)
    assert t.compact(spark) == 1
    b2 = spark.createDataFrame([(3, 1, 1, 31.0)], "dt int, id int, seq int, prediction double")
    t.write_batch(b2, 2)
    state = {(r.dt, r.id): r.prediction for r in t.read(spark).collect()}
    assert state == {(1, 1): 11.0, (2, 1): 21.0, (3, 1): 31.0}
    assert t.next_batch_id(spark) == 3


def test_keyed_table_last_write_wins_without_order(spark, scratch):
    t = KeyedTable(f"{scratch}/view", keys=["dt"])
    t.write_batch(spark.createDataFrame([(1, 1.0), (2, 2.0)], "dt int, avg_price double"), 0)
    t.write_batch(spark.createDataFrame([(1, 5.0)], "dt int, avg_price double"), 1)
    assert {r.dt: r.avg_price for r in t.read(spark).collect()} == {1: 5.0, 2: 2.0}
    assert t.read(spark).where(F.col("dt") == 1).count() == 1


def test_keyed_table_periodic_compaction_and_vacuum(spark, scratch):
    t = KeyedTable(f"{scratch}/s", keys=["id"], order=["v"], compact_every=3)
    for b in range(7):
        t.upsert_stream_batch(spark.createDataFrame([(b % 2, b)], "id int, v int"), b)
    state = {r.id: r.v for r in t.read(spark).collect()}
    assert state == {0: 6, 1: 5}
    # Snapshots at batches 2 and 5 (older one removed), log keeps only batch 6.
    assert t.applied_batches(spark) == [6]
    assert os.listdir(f"{scratch}/s/snapshot") == ["batch_id=5"]


def test_keyed_table_single_part_read_has_no_shuffle(spark, scratch):
    t = KeyedTable(f"{scratch}/c", keys=["id"])
    t.write_batch(spark.createDataFrame([(1, 1.0), (1, 2.0), (2, 3.0)], "id int, v double"), 0)
    one = t.read(spark)
    assert sorted((r.id, r.v) for r in one.collect()) == [(1, 1.0), (2, 3.0)] or \
        sorted((r.id, r.v) for r in one.collect()) == [(1, 2.0), (2, 3.0)]
    assert "Exchange" not in one._jdf.queryExecution().executedPlan().toString()
    t.write_batch(spark.createDataFrame([(2, 4.0)], "id int, v double"), 1)
    t.compact(spark)
    snap = t.read(spark)
    assert dict((r.id, r.v) for r in snap.collect())[2] == 4.0
    assert "Exchange" not in snap._jdf.queryExecution().executedPlan().toString()
    assert snap.columns == ["id", "v"]


def test_claims_of_dead_writers_lapse_and_slow_ones_write_again(spark, scratch):
    import time

    from tempora.sources.sinks import KeyedTable

    def rows(*pairs):
        return spark.createDataFrame(list(pairs), "id int, v string")

    def state(table):
        return {r.id: r.v for r in table.read(spark).collect()}

    # A writer that died: nothing passes its number until its claim has lapsed.
    table = KeyedTable(f"{scratch}/t", keys=["id"], claim_seconds=3600)
    table.append(rows((1, "a")))
    dead = table.claim(spark, "dead", 0)
    table.append(rows((2, "b")))
    assert table.compact(spark) == 0 and dead == 1
    short = KeyedTable(f"{scratch}/t", keys=["id"], claim_seconds=0.01)
    time.sleep(1.1)
    assert short.compact(spark) == 2
    short.vacuum(spark)
    assert state(table) == {1: "a", 2: "b"} and table.applied_batches(spark) == []
    # It was only slow: its batch comes under a new number and isn't lost.
    table.upsert_stream_batch(rows((1, "late"), (3, "c")), 0, stream="dead")
    assert state(table) == {1: "late", 2: "b", 3: "c"}
    # A stream that has gone on no longer holds its older numbers, whatever the time.
    steady = KeyedTable(f"{scratch}/s", keys=["id"], claim_seconds=None)
    steady.claim(spark, "s", 0)
    steady.upsert_stream_batch(rows((7, "x")), 1, stream="s")
    assert steady.compact(spark) == 1 and state(steady) == {7: "x"}
    # Nothing lapses that is still within its time.
    steady.claim(spark, "other", 0)
    steady.upsert_stream_batch(rows((8, "y")), 2, stream="s")
    assert steady.compact(spark) == 1 and state(steady) == {7: "x", 8: "y"}


def test_a_claim_that_lapses_during_the_write(spark, scratch, monkeypatch):
    from tempora.sources.sinks import KeyedTable

    table = KeyedTable(f"{scratch}/t", keys=["id"])
    write, seen = KeyedTable.write_batch, []

    def slow(self, df, n):
        seen.append(n)
        if len(seen) == 1:  # a compaction passes over it now
            self._mark(spark, n)
            spark.createDataFrame([(0, "z")], "id int, v string").write.parquet(f"{self.log_dir}/batch_id={n + 1}")
            self.compact(spark)
        write(self, df, n)

    monkeypatch.setattr(KeyedTable, "write_batch", slow)
    table.append(spark.createDataFrame([(1, "a")], "id int, v string"))
    assert seen == [0, 2] and {r.id: r.v for r in table.read(spark).collect()} == {0: "z", 1: "a"}
