"""Byte-level BPE: merges replayed over the distinct words of a task's texts, and decoding.

The texts of a task are cut by the tokenizer's pattern; every distinct word is
encoded once. All new distinct words of a batch are merged together: an
inverted index from the rank of a pair to its positions, and the ranks taken in
order; applying a merge touches only its two neighbours.
"""

from __future__ import annotations

import base64
import heapq
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tempora.llm.memory import give_back, small_batches

SLICE_BYTES = 3 << 20
PREPARE_BYTES = 12 << 20
SHIFT, NONE = 24, (1 << 31) - 1
GROUP = 400_000
TRUE = np.ones(1, dtype=bool)


def load_ranks(path: str) -> dict[bytes, int]:
    """A rank file: base64 of a token, a space, its rank, per line."""
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}


def compile_pattern(pattern: str) -> regex.Pattern:
    """The pattern with white space as Unicode has it (Python's \\s also holds \\x1c to \\x1f)."""
    pattern = pattern.replace(r"[^\s", r"[^\p{White_Space}").replace(r"\s", r"\p{White_Space}").replace(r"\S", r"\P{White_Space}")
    return regex.compile(pattern)


class Merger:
    """Applies every merge of a rank table to many words at once."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.byte = np.array([ranks[bytes([b])] for b in range(256)])
        pairs = {}  # every pair of tokens that merges, and the rank of its merge
        for t, r in ranks.items():
            for i in range(1, len(t)):
                a, b = ranks.get(t[:i]), ranks.get(t[i:])
                if a is not None and b is not None:
                    pairs[a << SHIFT | b] = r
        self.tokens = pa.array(list(ranks), pa.large_binary())
        self.token_ids = np.array(list(ranks.values()), dtype=np.int32)
        self.pair = np.array(sorted(pairs), dtype=np.int64)
        self.rank = np.array([pairs[p] for p in self.pair.tolist()], dtype=np.int32)

    def pair_ranks(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Rank of the merge of each pair; NONE if there is none or one side is a gap."""
        key = a.astype(np.int64) << SHIFT | b
        at = np.minimum(np.searchsorted(self.pair, key), len(self.pair) - 1)
        return np.where((self.pair[at] == key) & (a >= 0) & (b >= 0), self.rank[at], np.int32(NONE))

    def encode(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all words in a row, number of ids of each), GROUP words in one replay of all merges."""
        found = [self.replay(words.slice(at, GROUP)) for at in range(0, len(words), GROUP)]
        empty = [(np.zeros(0, dtype=np.int32), np.zeros(0, dtype=np.int64))]
        return tuple(np.concatenate(x) for x in zip(*(found or empty)))

    def replay(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of each word; equal to merging the lowest rank first, leftmost first, in each word alone.

        A word that is a token by itself isn't merged. In one pass of a rank each other word merges at its first position; a
        word with more of them is taken up again by that rank, or by a lower one that the merge has brought up.
        """
        words = words.cast(pa.large_binary())
        place = pc.index_in(words, value_set=self.tokens)
        whole = place.is_valid().to_numpy(zero_copy_only=False)
        flat, counts = self._merge(words.filter(pa.array(~whole)))
        sizes = np.ones(len(words), dtype=np.int64)
        sizes[~whole] = counts
        out = np.empty(int(sizes.sum()), dtype=np.int32)
        merged = np.repeat(~whole, sizes)
        out[merged] = flat
        out[~merged] = self.token_ids[place.drop_null().to_numpy()]
        return out, sizes

    def _merge(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids, number of ids of each word), all words through the merges."""
        n_words = len(words)
        if not n_words:
            return np.zeros(0, dtype=np.int32), np.zeros(0, dtype=np.int64)
        bounds = np.frombuffer(words.buffers()[1], dtype=np.int64)[words.offset: words.offset + n_words + 1]
        data = np.frombuffer(words.buffers()[2] or b"", dtype=np.uint8)[bounds[0]: bounds[-1]]
        sizes = np.diff(bounds) + 1
        sym = np.full(sizes.sum(), -1, dtype=np.int32)  # each word is followed by a gap
        inside = np.ones(len(sym), dtype=bool)
        inside[np.cumsum(sizes) - 1] = False
        sym[inside] = self.byte[data]
        word = np.repeat(np.arange(n_words, dtype=np.int32), sizes)
        n = len(sym)
        nxt, prv = np.arange(1, n + 1, dtype=np.int32), np.arange(-1, n - 1, dtype=np.int32)
        pair = np.full(n, NONE, dtype=np.int32)  # rank of the merge of a position with its successor
        pair[:-1] = self.pair_ranks(sym[:-1], sym[1:])
        index: dict[int, list[np.ndarray]] = {}
        heap: list[int] = []

        def enter(at: np.ndarray, ranks: np.ndarray) -> None:
            order = np.argsort(ranks, kind="stable")
            ranks, at = ranks[order], at[order]
            cuts = np.flatnonzero(ranks[1:] != ranks[:-1]) + 1
            for s, part in zip(ranks[np.concatenate(([0], cuts))].tolist(), np.split(at, cuts)):
                if s in index:
                    index[s].append(part)
                else:
                    index[s] = [part]
                    heapq.heappush(heap, s)

        first = np.flatnonzero(pair != NONE)
        if len(first):
            enter(first, pair[first])
        while heap:
            r = heapq.heappop(heap)
            at = index.pop(r)
            at = np.concatenate(at) if len(at) > 1 else at[0]
            at = at[pair[at] == r]  # else a neighbour has been merged meanwhile
            at.sort()
            if len(at) > 1:
                at = at[np.concatenate((TRUE, at[1:] != at[:-1]))]
            if not len(at):
                continue
            if len(at) > 1:
                own = word[at]
                again = np.concatenate((~TRUE, own[1:] == own[:-1]))
                if again.any():
                    index[r] = [at[again]]
                    heapq.heappush(heap, r)
                    at = at[~again]
            j = nxt[at]
            k = nxt[j]
            h = prv[at]
            sym[at] = r
            sym[j] = -2
            pair[j] = NONE
            nxt[at] = k
            prv[k] = at
            pair[at] = right = self.pair_ranks(sym[at], sym[k])
            left = self.pair_ranks(np.where(h >= 0, sym[h], -1), sym[at])
            pair[h[h >= 0]] = left[h >= 0]
            at, ranks = np.concatenate((at, h)), np.concatenate((right, left))
            if (some := ranks != NONE).any():
                enter(at[some], ranks[some])
        kept = sym >= 0
        return sym[kept], np.bincount(word[kept], minlength=n_words)


def gathered_ids(table: np.ndarray, sizes: np.ndarray, codes: np.ndarray) -> np.ndarray:
    """The ids of the pieces ``codes`` one after the other; ``table`` has those of piece 0, 1, ..."""
    n = sizes[codes]
    ends = np.cumsum(n)
    starts = np.cumsum(sizes) - sizes
    at = np.arange(int(ends[-1]) if len(ends) else 0)
    at += np.repeat(starts[codes] - ends + n, n)
    return table[at]


def _joined(pieces: pa.Array, bounds: np.ndarray, separator) -> pa.Array:
    """Pieces bounds[0] to bounds[1] as one, and so on."""
    return pc.binary_join(pa.LargeListArray.from_arrays(pa.array(bounds, pa.int64()), pieces), pa.scalar(separator, pieces.type))


class _Encoder:
    """Ids of texts by the pieces between single spaces, each distinct one through the pattern and the merges once.

    A lone space between two characters that aren't white space always begins a new word of the
    pattern, so that a text can be cut there. A text with white space beside such a cut goes through the
    pattern as a whole.
    """

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.merger = Merger(ranks)
        self.split = compile_pattern(pattern).findall
        ids = self.merger.token_ids
        self.place = np.zeros(int(ids.max()) + 1, dtype=np.int64)  # of an id among the tokens
        self.place[ids] = np.arange(len(ids))
        self.numbers = pa.array([str(i) for i in ids.tolist()], pa.large_string())

    def _cut(self, texts: pa.Array):
        """(words of all units in a row, bounds of each unit's words, units of all texts in a row, bounds of each text's units)."""
        lists = pc.split_pattern(texts, " ")
        bounds = lists.offsets.to_numpy().astype(np.int64)
        bounds = bounds - bounds[0]
        pieces = lists.flatten()
        first = np.zeros(len(pieces), dtype=bool)
        first[bounds[:-1]] = True
        inner, heads = (pieces.filter(pa.array(m)).dictionary_encode() for m in (~first, first))
        plain = self._plain(inner.dictionary, pc.utf8_trim_whitespace)
        plain_head = self._plain(heads.dictionary, pc.utf8_rtrim_whitespace)
        good = np.empty(len(pieces), dtype=bool)
        good[~first] = plain[inner.indices.to_numpy()]
        good[first] = plain_head[heads.indices.to_numpy()]
        alone = np.minimum.reduceat(good, bounds[:-1]) if len(texts) else good  # texts to be cut here
        odd = texts.filter(pa.array(~alone)).to_pylist()
        # Units: plain inner pieces, plain heads, the texts that aren't cut.
        inside = inner.dictionary.filter(pa.array(plain))
        found = self.split(" " + _joined(inside, np.array([0, len(inside)]), " ")[0].as_py()) if len(inside) else []
        more = [self.split(t) for t in [*heads.dictionary.filter(pa.array(plain_head)).to_pylist(), *odd]]
        sizes = np.concatenate((np.diff(np.flatnonzero([*[w[0] == " " for w in found], True])), [len(x) for x in more])).astype(np.int64)
        words = pa.array([*found, *[w for x in more for w in x]], pa.large_string())
        number, head_number = np.cumsum(plain) - 1, len(inside) + np.cumsum(plain_head) - 1
        units = np.empty(len(pieces), dtype=np.int64)
        units[~first] = number[inner.indices.to_numpy()]
        units[first] = head_number[heads.indices.to_numpy()]
        units[bounds[:-1][~alone]] = len(sizes) - len(odd) + np.arange(len(odd))
        kept = np.repeat(alone, np.diff(bounds)) | first
        return words, np.concatenate(([0], np.cumsum(sizes))), units[kept], np.concatenate(([0], np.cumsum(kept)))[bounds]

    @staticmethod
    def _plain(pieces: pa.Array, trim) -> np.ndarray:
        return pc.and_(pc.equal(trim(pieces), pieces), pc.not_equal(pieces, "")).to_numpy(zero_copy_only=False)

    def encode(self, texts: pa.Array, bounds: list[int], decode: bool) -> Iterator[list[pa.Array]]:
        """For each range of texts between ``bounds``: number of ids, ids as text and, with ``decode``, the bytes that they stand for."""
        words, word_bounds, units, unit_bounds = self._cut(texts)
        coded = words.dictionary_encode()
        ids, sizes = self.merger.encode(coded.dictionary)
        codes = coded.indices.to_numpy()
        ids = self.place[gathered_ids(ids, sizes, codes)]
        ends = np.concatenate(([0], np.cumsum(sizes[codes])))[word_bounds]
        n = np.diff(ends)
        taken = pa.array(ids)
        text = _joined(self.numbers.take(taken), ends, " ")
        data = _joined(self.merger.tokens.take(taken), ends, b"") if decode else None
        for a, b in zip(bounds[:-1], bounds[1:]):
            marks = unit_bounds[a: b + 1]
            of = units[marks[0]: marks[-1]]
            marks = marks - marks[0]
            total = np.concatenate(([0], np.cumsum(n[of])))[marks]
            out = [pa.array(np.diff(total), pa.int64()), _joined(text.take(pa.array(of)), marks, " ").cast(pa.string())]
            if decode:
                out.append(_joined(data.take(pa.array(of)), marks, b"").cast(pa.binary()))
            yield out


def slices(batch: pa.RecordBatch, size: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cuts of a batch with about ``size`` bytes of the last column's text, a row at least."""
    rows = max(1, int(batch.num_rows * size / max(1, batch.column(batch.num_columns - 1).nbytes)))
    for at in range(0, batch.num_rows, rows):
        yield batch.slice(at, rows)


def gathered(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[list[pa.RecordBatch]]:
    """Batches, cut if they are larger, that hold about ``size`` bytes of the last column's text together."""
    held, held_bytes = [], 0
    for big in batches:
        for b in slices(big, size):
            held.append(b)
            held_bytes += b.column(b.num_columns - 1).nbytes
            if held_bytes >= size:
                yield held
                held, held_bytes = [], 0
    if held:
        yield held


def decode_ids(token: dict[str, bytes], ids: str) -> bytes:
    """The bytes of decimal ids separated by spaces."""
    return b"".join([token[i] for i in ids.split()])


_WORKER: dict = {}


def bpe_encode(spark: SparkSession, docs: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id",
               text_col: str = "text", keep: tuple[str, ...] = (), decode: bool = False) -> DataFrame:
    """(id, *keep, n_tokens, ids): ``ids`` is the decimal ids joined by one space; with ``decode`` also
    ``decoded``, the bytes that the ids stand for, without a second pass over them.

    A null or empty text has no tokens and an empty ``ids``; rows are kept one for one, repeated
    rows and null ids too; other columns may have any names. Special tokens' strings are ordinary
    text. The rank table (a file of fixed size) is read on the driver and broadcast.
    """
    small_batches(spark)
    tables = spark.sparkContext.broadcast((load_ranks(ranks_path), pattern))
    token = uuid.uuid4().hex
    d = docs.select(F.col(id_col), *[F.col(c) for c in keep], F.col(text_col).cast("string").alias("__text"))
    fields = [f for f in d.schema.fields if f.name != "__text"]
    schema = T.StructType([*fields, T.StructField("n_tokens", T.LongType()), T.StructField("ids", T.StringType())])
    if decode:
        schema = schema.add("decoded", T.BinaryType())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key = ("bpe", token)  # tables are built once a worker
        if key not in _WORKER:
            _WORKER.clear()
            _WORKER[key] = _Encoder(*tables.value)
        enc = _WORKER[key]
        for group in gathered(batches, PREPARE_BYTES):
            parts = [b for big in group for b in slices(big)]
            texts = pa.concat_arrays([b.column(b.num_columns - 1) for b in parts]).fill_null("")
            bounds = np.concatenate(([0], np.cumsum([b.num_rows for b in parts]))).tolist()
            for b, out in zip(parts, enc.encode(texts, bounds, decode)):
                yield pa.RecordBatch.from_arrays([*[b.column(i) for i in range(b.num_columns - 1)], *out], names=schema.names)
        give_back()  # the worker may go on to other work

    return d.mapInArrow(run, schema)


def bpe_decode(spark: SparkSession, encoded: DataFrame, ranks_path: str, ids_col: str = "ids",
               out_col: str = "decoded") -> DataFrame:
    """``encoded`` with the bytes that its ids stand for (null ids: null; no ids: empty) in place of the ids."""
    small_batches(spark)
    tables = spark.sparkContext.broadcast({str(r): t for t, r in load_ranks(ranks_path).items()})
    fields = [f for f in encoded.schema.fields if f.name != ids_col]
    schema = T.StructType([*fields, T.StructField(out_col, T.BinaryType())])
    d = encoded.select(*[F.col(f.name) for f in fields], F.col(ids_col))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        token = tables.value
        for big in batches:
            for b in slices(big):
                out = [None if x is None else decode_ids(token, x)
                       for x in b.column(b.num_columns - 1).to_pylist()]
                yield pa.RecordBatch.from_arrays([*[b.column(i) for i in range(b.num_columns - 1)], pa.array(out, pa.binary())],
                                                 names=[*[f.name for f in fields], out_col])
        give_back()

    return d.mapInArrow(run, schema)
