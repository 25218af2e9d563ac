"""Sharding by best-fit-decreasing bin packing.

Rows with equal keys form groups that stay together. Small groups are packed
into parcels inside each task, largest first, each into the fullest parcel that
still has room, which a balanced tree of the parcels by remaining room finds. Parcels and large groups, whose number is bounded by the parameters, are
then packed into the shards in the same way on the driver, under the least
capacity for which they fit.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tempora.session import shared_path

PARCELS = 64           # a parcel holds a shard's capacity divided by this
ROW_BYTES = 16
SLOT_ROWS = 20_000     # rows that are numbered together, about


class RoomTree:
    """Bins in the order of (room left, bin): a search tree, balanced by priorities that are a hash of the bin."""

    def __init__(self) -> None:
        self.room = [-1]                # node 0 stands above the root, its right child
        self.child = ([0], [0])         # left and right; 0: none
        self.weight = [1 << 64]

    def _is_before(self, a: int, b: int) -> bool:
        return (self.room[a], a) < (self.room[b], b)

    def tightest(self, size: int) -> int | None:
        """The bin with the least room that holds ``size``; of equal ones the lowest."""
        best, n = 0, self.child[1][0]
        while n:
            if self.room[n] >= size:
                best, n = n, self.child[0][n]
            else:
                n = self.child[1][n]
        return best - 1 if best else None

    def insert(self, b: int, room: int) -> None:
        n = b + 1
        while len(self.room) <= n:
            k = len(self.room)
            self.room.append(0)
            self.weight.append((k * 0x9E3779B97F4A7C15 ^ (k * 0xBF58476D1CE4E5B9 >> 29)) % (1 << 64))
            self.child[0].append(0)
            self.child[1].append(0)
        self.room[n] = room
        above, side, at = 0, 1, self.child[1][0]
        while at and self.weight[at] >= self.weight[n]:
            above, side = at, int(self._is_before(at, n))
            at = self.child[side][at]
        self.child[side][above] = n
        # What was below this place is split into the nodes before and after the new one.
        ends = [(0, n), (1, n)]
        while at:
            after = int(not self._is_before(at, n))
            s, e = ends[after]
            self.child[s][e] = at
            ends[after] = (1 - after, at)
            at = self.child[1 - after][at]
        for s, e in ends:
            self.child[s][e] = 0

    def remove(self, b: int) -> None:
        n = b + 1
        above, side, at = 0, 1, self.child[1][0]
        while at != n:
            above, side = at, int(self._is_before(at, n))
            at = self.child[side][at]
        low, high = self.child[0][n], self.child[1][n]
        while low and high:  # the heavier of the two comes up
            if self.weight[low] >= self.weight[high]:
                self.child[side][above] = low
                above, side, low = low, 1, self.child[1][low]
            else:
                self.child[side][above] = high
                above, side, high = high, 0, self.child[0][high]
        self.child[side][above] = low or high


def best_fit_decreasing(sizes: np.ndarray, capacity: int) -> tuple[np.ndarray, int]:
    """(bin of each size, number of bins): largest first, each into the tightest bin with room, else a new one.

    Ties go to the earlier size and the lower bin. A size above the capacity gets a bin of its own.
    """
    bins = np.zeros(len(sizes), dtype=np.int64)
    tree = RoomTree()
    n = 0
    for i in np.argsort(-sizes, kind="stable").tolist():
        size = int(sizes[i])
        b = tree.tightest(size)
        if b is None:
            b, left = n, max(capacity, size)
            n += 1
        else:
            left = tree.room[b + 1]
            tree.remove(b)
        bins[i] = b
        if left > size:
            tree.insert(b, left - size)
    return bins, n


def pack_into(sizes: np.ndarray, n_bins: int) -> tuple[np.ndarray, int]:
    """(bin of each size, capacity): the least capacity, by bisection, at which at most ``n_bins`` are needed.

    It starts at the mean of the sizes without those that are above it: these have bins of their own and don't
    make the other bins larger. With fewer sizes than bins each has its own.
    """
    if not len(sizes):
        return np.zeros(0, dtype=np.int64), 0
    if len(sizes) <= n_bins:
        return np.argsort(np.argsort(-sizes, kind="stable")), int(sizes.max())
    rest, left = int(sizes.sum()), n_bins
    for size in np.sort(sizes)[::-1][:n_bins].tolist():  # a size above the mean of what is left has a bin of its own
        if size * left <= rest:
            break
        rest, left = rest - size, left - 1
    low = high = max(1, math.ceil(rest / max(1, left)))
    while best_fit_decreasing(sizes, high)[1] > n_bins:
        low, high = high + 1, high + max(1, high // 8)
    while low < high:
        mid = (low + high) // 2
        if best_fit_decreasing(sizes, mid)[1] <= n_bins:
            high = mid
        else:
            low = mid + 1
    return best_fit_decreasing(sizes, high)[0], high


def numbered(rows: DataFrame, group: str, order: list[Column], n_rows: int, name: str) -> DataFrame:
    """``name``: each row's place in its group, without gaps from 0. Rows are dealt into hash slots that are
    numbered by themselves and start where the slots before them end; the counts have one row a slot."""
    slots = max(1, math.ceil(n_rows / SLOT_ROWS))
    rows = rows.withColumn("__slot", F.pmod(F.xxhash64(*order), F.lit(slots)).cast("int"))
    sizes = rows.groupBy(group, "__slot").agg(F.count(F.lit(1)).alias("__n"))
    before = Window.partitionBy(group).orderBy("__slot").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(group, "__slot", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__start"))
    inside = F.row_number().over(Window.partitionBy(group, "__slot").orderBy(*order))
    rows = rows.withColumn("__at", inside).join(starts, [group, "__slot"])
    return rows.withColumn(name, F.col("__start") + F.col("__at") - 1).drop("__slot", "__at", "__start")


def shard(spark: SparkSession, docs: DataFrame, n_shards: int = 40, id_col: str = "doc_id", text_col: str = "text",
          row_bytes: int = ROW_BYTES, parcels: int = PARCELS) -> DataFrame:
    """(id, size, text_crc32, shard, slot): every row in one of ``n_shards`` shards of nearly equal bytes.

    The size of a row is its text's UTF-8 bytes plus ``row_bytes``; rows with equal texts stay in one
    shard, null texts being equal to each other but not to the empty text. Only a group larger than a
    shard (there are fewer of them than shards) is cut, by a hash of the id, into pieces that are packed
    like groups. ``slot`` numbers a shard's rows without gaps from 0, by a hash of the row, then by id. Null ids and repeated rows
    are kept; null texts count no bytes and have the checksum of no bytes; an empty table gives no rows.
    With few or very unequal groups shards can't be equal, and some may stay empty.
    """
    text = F.col(text_col).cast("string")
    data = F.coalesce(text, F.lit("")).cast("binary")
    rows = docs.select(F.col(id_col), (F.octet_length(data) + row_bytes).cast("long").alias("size"),
                       F.crc32(data).alias("text_crc32"), F.xxhash64(F.lit(1), text).alias("g1"),
                       F.xxhash64(F.lit(2), text, text.isNull()).alias("g2"))
    path = shared_path(spark, "sharding", unique=True)
    rows.write.parquet(path + "/rows")
    rows = spark.read.schema(rows.schema).parquet(path + "/rows")
    total, n_rows = rows.agg(F.coalesce(F.sum("size"), F.lit(0)), F.count(F.lit(1))).first()
    capacity = max(1, math.ceil(total / n_shards))

    groups = rows.groupBy("g1", "g2").agg(F.sum("size").alias("bytes"))
    over = {(r.g1, r.g2): r.bytes for r in groups.where(F.col("bytes") > capacity).collect()}  # fewer than n_shards
    pieces = F.lit(1)
    for (a, b), size in sorted(over.items()):
        pieces = F.when((F.col("g1") == a) & (F.col("g2") == b), F.lit(8 * math.ceil(size / capacity))).otherwise(pieces)
    rows = rows.withColumn("piece", F.pmod(F.xxhash64(F.lit(3), id_col), pieces).cast("int"))
    items = rows.groupBy("g1", "g2", "piece").agg(F.sum("size").alias("bytes"))

    room = max(1, capacity // parcels)

    def into_parcels(batches):
        table = pa.Table.from_batches(list(batches), schema=item_schema)  # numbers only: 28 bytes a group
        table = table.sort_by([("g1", "ascending"), ("g2", "ascending"), ("piece", "ascending")])
        bins, _ = best_fit_decreasing(table.column("bytes").to_numpy(), room)
        first = int(table.column("g1")[0].as_py()) if len(table) else 0
        out = table.append_column("parcel", pa.array([f"{first}:{b}" for b in bins.tolist()], pa.string()))
        yield from out.to_batches()

    item_schema = pa.schema([("g1", pa.int64()), ("g2", pa.int64()), ("piece", pa.int32()), ("bytes", pa.int64())])
    packed = items.mapInArrow(into_parcels, "g1 long, g2 long, piece int, bytes long, parcel string")
    packed.write.parquet(path + "/items")
    packed = spark.read.schema(packed.schema).parquet(path + "/items")
    # Bounded: parcels but each task's last are more than half full on the whole, large groups more than
    # full, so that there are at most about 2 * parcels * n_shards and one a task.
    parcel = sorted((r.parcel, r.bytes) for r in packed.groupBy("parcel").agg(F.sum("bytes").alias("bytes")).collect())
    bins, _ = pack_into(np.array([b for _, b in parcel], dtype=np.int64), n_shards)
    places = spark.createDataFrame([(p, int(b)) for (p, _), b in zip(parcel, bins)], "parcel string, shard int")
    placed = packed.join(F.broadcast(places), "parcel").select("g1", "g2", "piece", "shard")
    out = rows.join(placed, ["g1", "g2", "piece"]).select(id_col, "size", "text_crc32", "shard")
    return numbered(out, "shard", [F.col(id_col), F.col("text_crc32"), F.col("size")], n_rows, "slot")
