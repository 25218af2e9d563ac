"""Text blocks and question rounds: exact corpus-wide counting of hashed units without hot keys.

Rows are dealt into *blocks* of a few MB by a hash of id and text. In a round
every block asks about its distinct 64-bit hashes, cut into buckets by their
high bits; one task per bucket holds the same hashes of all blocks, works out
the answer per hash, and sends it back to the block in the order asked. A unit
that fills a third of the corpus is asked once per block, so no bucket is hot,
and nothing passes through the driver. Each round re-reads the blocks' shuffle
output (Spark reuses the exchange), so the text moves once.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tempora.llm.memory import CACHES, give_back

BLOCK_BYTES = 2 << 20
BUCKET_BYTES = 4 << 20
U = np.uint64

# Rolling hash modulo 2**64: one random 64-bit value for each byte, an odd base, and its inverse.
_RNG = np.random.default_rng(20240607)
BYTE_VALUES = _RNG.integers(1, 1 << 63, 256, dtype=np.uint64) * U(2) + U(1)
BASE = int(_RNG.integers(1, 1 << 62)) * 2 + 1
WORD_BASE = int(_RNG.integers(1, 1 << 62)) * 2 + 1
WORD_BASE_2 = int(_RNG.integers(1, 1 << 62)) * 2 + 1
_POWERS: dict[int, np.ndarray] = {}
CACHES.append(_POWERS)


def powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**n modulo 2**64 (kept for a block's work, grown on demand)."""
    have = _POWERS.get(base)
    if have is None or len(have) <= n:
        p = np.full(max(n + 1, 1 << 16), base % (1 << 64), dtype=np.uint64)
        p[0] = 1
        have = _POWERS[base] = np.cumprod(p, dtype=np.uint64)
    return have[: n + 1]


def inverse(base: int) -> int:
    return pow(base, -1, 1 << 64)


def mix(x: np.ndarray) -> np.ndarray:
    """Spread a 64-bit value over all its bits (one-to-one)."""
    x = x ^ (x >> U(32))
    x = x * U(0xD6E8FEB86659FD93)
    x ^= x >> U(29)
    x = x * U(0xBF58476D1CE4E5B9)
    return x ^ (x >> U(32))


class SpanHash:
    """Hashes of any spans of one sequence by prefix sums; equal content gives equal hashes."""

    def __init__(self, values: np.ndarray, base: int = BASE):
        n = len(values)
        self.sums = np.zeros(n + 1, dtype=np.uint64)
        np.cumsum(values * powers(base, n)[:n], out=self.sums[1:])
        self.inv = powers(inverse(base), n)

    def spans(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return (self.sums[end] - self.sums[start]) * self.inv[start]

    def every(self, length: int) -> np.ndarray:
        """The span of ``length`` from each position at which it fits."""
        n = len(self.sums) - length
        return (self.sums[length:] - self.sums[:n]) * self.inv[:n]


def text_blocks(docs: DataFrame, id_col: str, text_col: str, block_bytes: int = BLOCK_BYTES,
                by_id: bool = False) -> tuple[DataFrame, int, int]:
    """(block, id, text, kd, kt) with the number of blocks and the bytes of text in all; ``by_id``: an id's rows share a block."""
    d = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    total, rows = d.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0)), F.count(F.lit(1))).first()
    n = max(1, math.ceil((total + 32 * rows) / block_bytes))
    d = d.withColumns({"kd": F.xxhash64("id"), "kt": F.xxhash64("text")})
    return d.withColumn("block", F.pmod(F.col("kd") if by_id else F.xxhash64("kd", "kt"), F.lit(n)).cast("int")), n, total


class Block:
    """One block's rows in a fixed order, with all texts in one byte array."""

    def __init__(self, table: pa.Table):
        table = table.sort_by([("kt", "ascending"), ("kd", "ascending")]).combine_chunks()
        self.ids = table.column("id")
        text = table.column("text").fill_null("").cast(pa.large_string()).combine_chunks()
        if isinstance(text, pa.ChunkedArray):
            text = pa.concat_arrays(text.chunks) if text.num_chunks else pa.array([], pa.large_string())
        self.n = len(text)
        off = np.frombuffer(text.buffers()[1], dtype=np.int64)[text.offset: text.offset + self.n + 1] if self.n else np.zeros(1, np.int64)
        data = text.buffers()[2]
        data = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
        self.data = data[off[0]: off[-1]]
        self.off = off - off[0]


SPACE = np.zeros(256, dtype=bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256)
_LOWER[65:91] += 32
LOWER_VALUES = BYTE_VALUES[_LOWER]


class Words:
    """Words ``[^\\x20\\x09-\\x0D]+`` of a block: byte spans, a hash of each, and each row's range of words."""

    def __init__(self, block: Block, lower: bool = False):
        data, off = block.data, block.off
        gap = np.ones(len(data) + 1, dtype=bool)
        gap[:-1] = SPACE[data]
        first = ~gap[:-1]
        last = first.copy()
        first[1:] &= gap[:-2]
        last &= gap[1:]
        inner = off[1:-1]
        inner = inner[(inner > 0) & (inner < len(data))]
        first[inner] = ~gap[inner]
        last[inner - 1] = ~gap[inner - 1]
        self.start = np.flatnonzero(first)
        self.end = np.flatnonzero(last) + 1
        self.off = np.searchsorted(self.start, off)
        values = (LOWER_VALUES if lower else BYTE_VALUES)[data]
        self.hash = mix(SpanHash(values).spans(self.start, self.end) + (self.end - self.start).astype(np.uint64))
        self.doc = np.repeat(np.arange(block.n), np.diff(self.off))

    def window_starts(self, length: int) -> np.ndarray:
        """Word positions at which a window of ``length`` words fits into its row."""
        n = len(self.start)
        at = np.arange(max(0, n - length + 1))
        return at[at + length <= self.off[1:][self.doc[at]]]


# ---------------------------------------------------------------------------
# Rounds.
# ---------------------------------------------------------------------------
def bucket_count(total_entries: int, entry_bytes: int) -> int:
    """A power of two with about BUCKET_BYTES of entries in each bucket."""
    return 1 << max(4, math.ceil(math.log2(max(1, total_entries * entry_bytes / BUCKET_BYTES))))


ASKED = "bucket int, block int, payload binary"
ANSWERED = "block int, bucket int, payload binary"


def cut(sorted_hash: np.ndarray, n_buckets: int) -> np.ndarray:
    """Bounds of each bucket (by the high bits) in ascending hashes."""
    shift = U(64 - int(math.log2(n_buckets)))
    return np.searchsorted(sorted_hash >> shift, np.arange(n_buckets + 1, dtype=np.uint64))


def ask(blocks: DataFrame, request: Callable[[Block], tuple[np.ndarray, np.ndarray]], n_buckets: int) -> DataFrame:
    """``request(block)`` gives ascending hashes and a 2-d array of bytes, one row a hash."""

    def run(key, table):
        hashes, payload = request(Block(table))
        bounds = cut(hashes, n_buckets)
        some = np.flatnonzero(np.diff(bounds))
        give_back()
        return pa.table({
            "bucket": pa.array(some, pa.int32()), "block": pa.array([key[0].as_py()] * len(some), pa.int32()),
            "payload": pa.array([payload[bounds[b]: bounds[b + 1]].tobytes() for b in some], pa.binary())})

    return blocks.groupBy("block").applyInArrow(run, ASKED)


def answer(asked: DataFrame, width: int | Callable[[int], int], reply: Callable[[np.ndarray, np.ndarray], np.ndarray]) -> DataFrame:
    """``reply(bytes of all entries, block of each)`` gives an array with one element an entry; ``width``: an entry's bytes, or a bucket's."""

    def run(key, table):
        table = table.sort_by("block")
        wide = width(key[0].as_py()) if callable(width) else width
        parts = [x.as_py() for x in table.column("payload")]
        sizes = np.array([len(p) // wide for p in parts])
        entries = np.frombuffer(b"".join(parts), dtype=np.uint8).reshape(-1, wide)
        block = table.column("block").to_numpy()
        out = reply(entries, np.repeat(block, sizes))
        ends = np.cumsum(sizes)
        give_back()
        return pa.table({
            "block": pa.array(block, pa.int32()), "bucket": pa.array([key[0].as_py()] * len(parts), pa.int32()),
            "payload": pa.array([out[e - s: e].tobytes() for s, e in zip(sizes, ends)], pa.binary())})

    return asked.groupBy("bucket").applyInArrow(run, ANSWERED)


def answers_of(table: pa.Table, dtype) -> np.ndarray:
    """A block's answers in the order of its ascending hashes."""
    table = table.sort_by("bucket")
    return np.frombuffer(b"".join(x.as_py() for x in table.column("payload")), dtype=dtype)


def as_bytes(*columns: tuple[np.ndarray, int]) -> np.ndarray:
    """Join the low ``n`` bytes of each column, row by row."""
    return np.concatenate([np.ascontiguousarray(c).astype("<u8").view(np.uint8).reshape(-1, 8)[:, :n] for c, n in columns], axis=1)


def from_bytes(entries: np.ndarray, start: int, n: int) -> np.ndarray:
    out = np.zeros((len(entries), 8), dtype=np.uint8)
    out[:, :n] = entries[:, start: start + n]
    return out.view("<u8").ravel()


HASH_BYTES = 5


def short_hash(hashes: np.ndarray, n_buckets: int) -> np.ndarray:
    """The HASH_BYTES that follow the bucket's bits; enough to propose candidates, never to decide."""
    return (hashes << U(int(math.log2(n_buckets)))) >> U(64 - 8 * HASH_BYTES)


def counts(values: np.ndarray) -> np.ndarray:
    """How often each element's value occurs in all."""
    _, inv, n = np.unique(values, return_inverse=True, return_counts=True)
    return n[inv]


def in_batches(rows: Iterator, size: int) -> Iterator[list]:
    batch: list = []
    for r in rows:
        batch.append(r)
        if len(batch) >= size:
            yield batch
            batch = []
    if batch:
        yield batch
