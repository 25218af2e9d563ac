"""Sinks: keyed upsert tables (A9, A10), JSON publishing (A11), console.

``KeyedTable`` gives upsert semantics on plain Parquet, with no table format:

- every write is one *batch* folder ``log/batch_id=N``, overwritten as a whole.
  N is a table-wide sequence: a writer claims the next number for its own
  (stream id, batch id) with an exclusively created file under ``claims/``. A
  replayed batch finds its claim and rewrites the same folder; another stream,
  or the same one with a fresh checkpoint, gets new numbers and never
  overwrites earlier rows;
- a read takes, per key, the row with the greatest ``(order..., batch_id)``:
  ``max(struct)`` is algebraic, so it is partial-aggregated before the shuffle
  and a hot key is never gathered in one task;
- ``compact`` writes that result as ``snapshot/batch_id=N`` (a cut in lineage
  and in files to read); later reads scan the newest complete snapshot plus
  the batches after it, which partition pruning selects. It stops before the
  first number that is claimed but not written yet, so that no batch still
  being written is passed over. The claim of a writer that died doesn't hold it up for ever: it
  lapses when its stream has a later claim, or after ``claim_seconds``. A writer that is only slow finds
  its claim marked as lapsed, and writes its batch again under a new number.

The table lives in a shared folder (HDFS / object store), so it survives the
loss of any executor; a folder is complete when Spark's ``_SUCCESS`` marker is
in it, and incomplete ones are ignored.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

BATCH_COL = "batch_id"
CLAIM_SECONDS = 24 * 3600.0  # longer than any write of a batch
LAPSED = "lapsed"


def _file_system(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def _complete_batches(spark: SparkSession, directory: str) -> list[int]:
    """Ids of the folders with Spark's marker, by one listing call."""
    fs, pattern = _file_system(spark, f"{directory}/{BATCH_COL}=*/_SUCCESS")
    found = fs.globStatus(pattern) or []
    return sorted(int(s.getPath().getParent().getName().split("=", 1)[1]) for s in found)


def stream_id(spark: SparkSession) -> str | None:
    """The id of the streaming query that runs this code (inside ``foreachBatch``); it stays with its checkpoint."""
    return spark.sparkContext.getLocalProperty("sql.streaming.queryId")


class KeyedTable:
    """An upsert table keyed by ``keys``; the newest row per key wins.

    "Newest" is the greatest ``order`` columns, then the greatest batch id (so
    with no ``order`` the last write wins, as a database upsert).
    """

    def __init__(self, path: str, keys: Sequence[str], order: Sequence[str] = (), compact_every: int | None = None,
                 claim_seconds: float | None = CLAIM_SECONDS):
        self.claim_seconds = claim_seconds
        self.path = path.rstrip("/")
        self.keys = list(keys)
        self.order = list(order)
        self.compact_every = compact_every

    @property
    def log_dir(self) -> str:
        return f"{self.path}/log"

    @property
    def snapshot_dir(self) -> str:
        return f"{self.path}/snapshot"

    @property
    def claims_dir(self) -> str:
        return f"{self.path}/claims"

    def _claim_files(self, spark: SparkSession) -> list[tuple[int, str, float]]:
        """(sequence number, rest of the name, time of writing) of every file of claims."""
        fs, pattern = _file_system(spark, f"{self.claims_dir}/*")
        out = []
        for status in fs.globStatus(pattern) or []:
            n, _, rest = status.getPath().getName().partition(".")
            out.append((int(n), rest, status.getModificationTime() / 1000))
        return out

    def _claims(self, spark: SparkSession) -> list[tuple[int, str | None, int]]:
        """(sequence number, stream, batch) of each claim; a number without its claim file has no stream."""
        out = []
        for n, rest, _ in self._claim_files(spark):
            stream, _, batch = rest.rpartition(".")
            if rest != LAPSED:
                out.append((n, stream or None, int(batch or -1)))
        return out

    def _lapsed(self, spark: SparkSession) -> set[int]:
        """Numbers that a compaction has passed over."""
        return {n for n, rest, _ in self._claim_files(spark) if rest == LAPSED}

    def _may_lapse(self, spark: SparkSession, numbers: set[int]) -> set[int]:
        """Those of some unwritten numbers whose writer has gone on to a later batch, or has had ``claim_seconds``."""
        files = self._claim_files(spark)
        owner = {n: rest.rpartition(".")[0] for n, rest, _ in files if rest and rest != LAPSED}
        last = {stream: max(n for n, s in owner.items() if s == stream) for stream in owner.values()}
        newest = {n: max(t for m, _, t in files if m == n) for n in {n for n, _, _ in files}}
        now = time.time()
        return {n for n in numbers if last.get(owner.get(n), n) > n
                or (self.claim_seconds is not None and now - newest[n] > self.claim_seconds)}

    def _mark(self, spark: SparkSession, number: int) -> None:
        fs, path = _file_system(spark, f"{self.claims_dir}/{number}.{LAPSED}")
        fs.createNewFile(path)

    def claim(self, spark: SparkSession, stream: str, batch_id: int) -> int:
        """The table-wide sequence number of a stream's batch: the one it has, or the next free one."""
        claims, lapsed = self._claims(spark), self._lapsed(spark)
        for n, s, b in claims:
            if (s, b) == (stream, int(batch_id)) and n not in lapsed:
                return n
        taken = [n for n, _, _ in claims] + self.applied_batches(spark) + _complete_batches(spark, self.snapshot_dir)
        n = max(taken, default=-1) + 1
        while True:
            fs, number = _file_system(spark, f"{self.claims_dir}/{n}")
            if fs.createNewFile(number):  # false if another writer was first
                fs.createNewFile(_file_system(spark, f"{self.claims_dir}/{n}.{stream}.{int(batch_id)}")[1])
                return n
            n += 1

    def append(self, df: DataFrame) -> int:
        """Upsert one batch under the next sequence number, which it returns."""
        return self._write_claimed(df, uuid.uuid4().hex, 0)

    def _write_claimed(self, df: DataFrame, stream: str, batch_id: int) -> int:
        """Write under the batch's number; again under a new one if that lapsed meanwhile."""
        spark = df.sparkSession
        while True:
            n = self.claim(spark, stream, batch_id)
            snaps = _complete_batches(spark, self.snapshot_dir)
            if snaps and snaps[-1] >= n:  # a replay of what the snapshot holds
                return n
            self.write_batch(df, n)
            if n not in self._lapsed(spark):
                return n

    def write_batch(self, df: DataFrame, batch_id: int) -> None:
        """Upsert one batch under a sequence number of the caller's (idempotent for a given number)."""
        latest = self._latest(df.withColumn(BATCH_COL, F.lit(int(batch_id)).cast("bigint")), df.columns)
        # Sorted by key inside each file, so row-group statistics let key filters skip data.
        latest.drop(BATCH_COL).sortWithinPartitions(*self.keys).write.mode("overwrite").parquet(
            f"{self.log_dir}/{BATCH_COL}={int(batch_id)}")

    def applied_batches(self, spark: SparkSession) -> list[int]:
        return _complete_batches(spark, self.log_dir)

    def next_batch_id(self, spark: SparkSession) -> int:
        ids = self.applied_batches(spark) + _complete_batches(spark, self.snapshot_dir)
        return (max(ids) + 1) if ids else 0

    def _latest(self, df: DataFrame, columns: Sequence[str]) -> DataFrame:
        rank = [F.col(c) for c in self.order] + [F.col(BATCH_COL)]
        payload = [c for c in columns if c not in self.keys and c != BATCH_COL]
        best = F.max(F.struct(*[r.alias(f"_o{i}") for i, r in enumerate(rank)],
                              *[F.col(c) for c in payload])).alias("_best")
        out = df.groupBy(*self.keys).agg(best)
        return out.select(*self.keys, *[F.col(f"_best.{c}").alias(c) for c in payload],
                          F.col(f"_best._o{len(rank) - 1}").alias(BATCH_COL))

    def read(self, spark: SparkSession, up_to: int | None = None) -> DataFrame | None:
        """Current state (one row per key), or None when nothing was written yet; ``up_to``: of the batches up to it."""
        snaps = _complete_batches(spark, self.snapshot_dir)
        parts = []
        snap_id = -1
        if snaps:
            snap_id = snaps[-1]
            parts.append(spark.read.parquet(f"{self.snapshot_dir}/{BATCH_COL}={snap_id}"))
        batches = [b for b in self.applied_batches(spark) if b > snap_id and (up_to is None or b <= up_to)]
        if batches:
            log = spark.read.option("basePath", self.log_dir).parquet(
                *[f"{self.log_dir}/{BATCH_COL}={b}" for b in batches])
            parts.append(log)
        if not parts:
            return None
        if (snaps and not batches) or (not snaps and len(batches) == 1):
            # Only a snapshot, or only one batch: already one row per key (both are
            # written de-duplicated), so the read needs no shuffle.
            return parts[0].drop(BATCH_COL)
        unioned = parts[0]
        for p in parts[1:]:
            unioned = unioned.unionByName(p, allowMissingColumns=True)
        cols = [c for c in unioned.columns if c != BATCH_COL]
        return self._latest(unioned, cols).drop(BATCH_COL)

    def compact(self, spark: SparkSession) -> int | None:
        """Write the current state as a snapshot at the newest batch id; returns that id."""
        snaps = _complete_batches(spark, self.snapshot_dir)
        covered = snaps[-1] if snaps else -1
        ids = self.applied_batches(spark)
        done = set(ids)
        open_ = {n for n, _, _ in self._claims(spark) if n > covered and n not in done} - self._lapsed(spark)
        for n in self._may_lapse(spark, open_):
            self._mark(spark, n)
            open_.discard(n)
        ids = [b for b in ids if b > covered and b < min(open_, default=b + 1)]
        if not ids:
            return covered if snaps else None
        top = ids[-1]
        state = self.read(spark, up_to=top)
        state.withColumn(BATCH_COL, F.lit(top).cast("bigint")).write.mode("overwrite").parquet(
            f"{self.snapshot_dir}/{BATCH_COL}={top}")
        return top

    def vacuum(self, spark: SparkSession) -> int:
        """Delete log batches and older snapshots already covered by the newest snapshot.

        Safe for readers that list the table afterwards; a reader that listed
        before may fail on a deleted folder and simply re-reads. Returns the
        number of folders removed.
        """
        snaps = _complete_batches(spark, self.snapshot_dir)
        if not snaps:
            return 0
        keep = snaps[-1]
        doomed = [f"{self.log_dir}/{BATCH_COL}={b}" for b in self.applied_batches(spark) if b <= keep]
        doomed += [f"{self.snapshot_dir}/{BATCH_COL}={b}" for b in snaps[:-1]]
        # Of a stream only the newest claim can still be asked for, by a replay.
        claims = self._claims(spark)
        newest: dict[str, int] = {}
        for _, s, b in claims:
            if s is not None:
                newest[s] = max(b, newest.get(s, -1))
        lapsed = self._lapsed(spark)
        old = [f"{n}.{s}.{b}" if s is not None else f"{n}" for n, s, b in claims
               if n <= keep and n not in lapsed and (s is None or b < newest[s])]
        for d in [*doomed, *[f"{self.claims_dir}/{name}" for name in old]]:
            fs, p = _file_system(spark, d)
            fs.delete(p, True)
        return len(doomed)

    def upsert_stream_batch(self, df: DataFrame, batch_id: int, stream: str | None = None) -> None:
        """``foreachBatch`` callback: a replayed micro-batch of a stream rewrites the same folder.

        ``stream`` names the writer; by default it is the running query's id. With
        ``compact_every=n``, every n-th batch also compacts and vacuums, so a
        long-running stream keeps a bounded number of folders to read.
        """
        spark = df.sparkSession
        n = self._write_claimed(df, stream or stream_id(spark) or "direct", batch_id)
        if self.compact_every and (n + 1) % self.compact_every == 0:
            self.compact(spark)
            self.vacuum(spark)


class SumTable(KeyedTable):
    """A table of sums by ``keys``: every batch adds to them instead of replacing rows.

    A batch folder holds the batch's own sums, a row a key; all other columns are added up (NULL adds nothing). Writing
    reads nothing that was written before; a read, or a compaction, adds the newest snapshot and the
    batches after it, with a partial aggregate before the shuffle. A replayed batch
    rewrites its folder, so that nothing counts twice.

    Claims lapse only when their stream has gone on, since a batch that is written twice would count twice.

    The table belongs to one stream: a stream with a fresh checkpoint would read its source again, and add
    it a second time, so it is refused.
    """

    def __init__(self, path: str, keys: Sequence[str], compact_every: int | None = None):
        super().__init__(path, keys, compact_every=compact_every, claim_seconds=None)

    def _latest(self, df: DataFrame, columns: Sequence[str]) -> DataFrame:
        payload = [c for c in columns if c not in self.keys and c != BATCH_COL]
        out = df.groupBy(*self.keys).agg(*[F.sum(c).cast(df.schema[c].dataType).alias(c) for c in payload], F.max(BATCH_COL).alias(BATCH_COL))
        return out.select(*self.keys, *payload, BATCH_COL)

    def claim(self, spark: SparkSession, stream: str, batch_id: int) -> int:
        others = {s for _, s, _ in self._claims(spark) if s not in (None, stream)}
        if others:
            raise ValueError(f"{self.path} has the sums of another stream ({', '.join(sorted(others))}); a fresh checkpoint needs a fresh table")
        return super().claim(spark, stream, batch_id)


def publish_json(df: DataFrame, path: str, files: int | None = None) -> None:
    """A11 to files: one JSON message per line (``value``), as a topic writer would send them.

    ``files`` sets how many files (i.e. how many source micro-batches with
    ``maxFilesPerTrigger=1``); by default one per input partition.
    """
    from tempora.functions.jsonops import encode_json

    out = df if list(df.columns) == ["value"] else df.select(encode_json(*df.columns).alias("value"))
    if files:
        out = out.repartition(files)
    out.write.mode("overwrite").text(path)


def publish_kafka(df: DataFrame, servers: str, topic: str) -> None:  # pragma: no cover - needs the Kafka jar
    """A11 to a Kafka topic (requires the spark-sql-kafka package on the classpath)."""
    from tempora.functions.jsonops import encode_json

    out = df if list(df.columns) == ["value"] else df.select(encode_json(*df.columns).alias("value"))
    out.write.format("kafka").option("kafka.bootstrap.servers", servers).option("topic", topic).save()


def to_console(df: DataFrame, checkpoint: str, truncate: bool = False):
    """Print each micro-batch (the memory sink serves the same purpose in tests)."""
    return (df.writeStream.format("console").option("truncate", truncate)
            .option("checkpointLocation", checkpoint).start())
