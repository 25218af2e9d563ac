"""Removal of word windows that repeat anywhere, by difference-cover anchors.

D = {0, 1, 4, 14, 16} covers every difference modulo 21: for any two word
positions there is a shift below 21 that puts both on D. Short windows are
hashed only at positions on D (counted in the row), so that any repeated long
window holds an anchor at the same offset in both places. Round one counts the
anchors' hashes over the corpus. Around shared anchors the match is extended to
whole windows, which round two counts by 128-bit hashes. See blocks.py for the
rounds.
"""

from __future__ import annotations

from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tempora.llm import blocks as B

WINDOW = 35
PERIOD, COVER = 21, (0, 1, 4, 14, 16)


def anchor_length(window: int) -> int:
    """The longest anchor that every window has at the shift that two positions share."""
    if window < PERIOD:
        raise ValueError(f"windows of {PERIOD} words or more")
    return window - PERIOD + 1


def anchors(words: B.Words, length: int) -> tuple[np.ndarray, np.ndarray]:
    """(word positions on the cover with room for an anchor, hash of each anchor)."""
    at = words.window_starts(length)
    on = np.zeros(PERIOD, dtype=bool)
    on[list(COVER)] = True
    at = at[on[(at - words.off[words.doc[at]]) % PERIOD]]
    return at, B.mix(B.SpanHash(words.hash, B.WORD_BASE).spans(at, at + length))


def ask_anchors(length: int, n_buckets: int, block: B.Block) -> tuple[np.ndarray, np.ndarray]:
    _, h = anchors(B.Words(block), length)
    h = np.unique(h)
    return h, B.as_bytes((B.short_hash(h, n_buckets), B.HASH_BYTES))


def shared_elsewhere(entries: np.ndarray, block: np.ndarray) -> np.ndarray:
    """1 where the same bytes come from another block too (a block asks once for each hash)."""
    if entries.shape[1] <= 8:
        return (B.counts(B.from_bytes(entries, 0, entries.shape[1])) > 1).astype(np.uint8)
    high, low = B.from_bytes(entries, 0, 8), B.from_bytes(entries, 8, entries.shape[1] - 8)
    order = np.lexsort((low, high))
    same = (high[order][1:] == high[order][:-1]) & (low[order][1:] == low[order][:-1])
    out = np.zeros(len(entries), dtype=np.uint8)
    out[order[1:][same]] = 1
    out[order[:-1][same]] = 1
    return out


class Candidates:
    """A block's windows that hold a shared anchor, with two hashes of each."""

    def __init__(self, window: int, block: B.Block, table: pa.Table):
        length = anchor_length(window)
        self.words = words = B.Words(block)
        at, h = anchors(words, length)
        _, inv, n = np.unique(h, return_inverse=True, return_counts=True)
        shared = B.answers_of(table, np.uint8).astype(bool) | (n > 1) if len(n) else np.zeros(0, bool)
        at = at[shared[inv]] if len(n) else at
        # A window from s holds the anchors from s to s + PERIOD - 1.
        edge = np.zeros(len(words.start) + PERIOD + 1, dtype=np.int32)
        np.add.at(edge, np.maximum(at - PERIOD + 1, 0), 1)
        np.add.at(edge, at + 1, -1)
        starts = words.window_starts(window)
        self.at = starts[np.cumsum(edge)[starts] > 0]
        self.high = B.mix(B.SpanHash(words.hash, B.WORD_BASE).spans(self.at, self.at + window))
        self.low = B.mix(B.SpanHash(B.mix(words.hash + B.U(1)), B.WORD_BASE_2).spans(self.at, self.at + window))
        # One entry for each distinct window, ascending by its first hash.
        self.order = np.lexsort((self.low, self.high))
        high, low = self.high[self.order], self.low[self.order]
        self.new = np.ones(len(high), dtype=bool)
        self.new[1:] = (high[1:] != high[:-1]) | (low[1:] != low[:-1])
        self.entry_high, self.entry_low = high[self.new], low[self.new]

    def repeated(self, elsewhere: np.ndarray) -> np.ndarray:
        """Positions of the windows that occur twice or more, given which entries other blocks have."""
        if not len(self.at):
            return self.at
        entry = np.cumsum(self.new) - 1
        twice = elsewhere.astype(bool) | (np.bincount(entry) > 1)
        return np.sort(self.at[self.order[twice[entry]]])


def _round(table: pa.Table, n: int) -> pa.Table:
    return table.filter(pa.compute.equal(table.column("round"), n))


def substring_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW) -> DataFrame:
    """(id, n_words, n_removed, kept_text): each row without the words of any repeated window.

    Words are ``[^\\x20\\x09-\\x0D]+``, compared as they are; a window is ``window`` words in a row of one
    text, repeated if the same words start anywhere else, in the same text included. Windows are
    judged on the input. ``kept_text`` joins the kept words by one space. Null and empty texts
    have no words and an empty ``kept_text``; every row is kept, repeated rows and null ids too
    (two equal rows repeat each other). Other columns are not read and may have any names.
    """
    import pyarrow.compute  # noqa: F401 - used by _round in the workers too

    from pyspark.sql import functions as F

    length = anchor_length(window)
    blocks, _, total = B.text_blocks(docs, id_col, text_col)
    n_buckets = B.bucket_count(total // 24, B.HASH_BYTES)
    first = B.answer(B.ask(blocks, partial(ask_anchors, length, n_buckets), n_buckets), B.HASH_BYTES, shared_elsewhere)

    def extend(key, rows, told):
        block = B.Block(rows)
        c = Candidates(window, block, told)
        bounds = B.cut(c.entry_high, n_buckets)
        some = np.flatnonzero(np.diff(bounds))
        entries = B.as_bytes((c.entry_high, 8), (c.entry_low, 8))
        number = key[0].as_py()
        return pa.table({
            "bucket": pa.array(some, pa.int32()), "block": pa.array([number] * len(some), pa.int32()),
            "payload": pa.array([entries[bounds[b]: bounds[b + 1]].tobytes() for b in some], pa.binary())})

    windows = blocks.groupBy("block").cogroup(first.groupBy("block")).applyInArrow(extend, B.ASKED)
    second = B.answer(windows, 16, shared_elsewhere)
    told = first.withColumn("round", F.lit(1)).unionByName(second.withColumn("round", F.lit(2)))
    schema = T.StructType([T.StructField(id_col, docs.schema[id_col].dataType), T.StructField("n_words", T.LongType()),
                           T.StructField("n_removed", T.LongType()), T.StructField("kept_text", T.StringType())])

    def remove(key, rows, told):
        block = B.Block(rows)
        c = Candidates(window, block, _round(told, 1))
        words = c.words
        at = c.repeated(B.answers_of(_round(told, 2), np.uint8))
        edge = np.zeros(len(words.start) + 1, dtype=np.int32)
        np.add.at(edge, at, 1)
        np.add.at(edge, at + window, -1)
        kept = np.cumsum(edge)[:-1] == 0
        # The kept words' bytes, each followed by a space but for a row's last.
        sizes = np.where(kept, words.end - words.start + 1, 0)
        doc_bytes = np.add.reduceat(np.concatenate((sizes, [0])), words.off[:-1]) if block.n else np.zeros(0, np.int64)
        doc_bytes = np.where(np.diff(words.off) > 0, doc_bytes, 0)
        copy = np.zeros(len(block.data) + 1, dtype=np.int8)
        copy[words.start[kept]] = 1
        copy[words.end[kept]] -= 1
        inside = np.cumsum(copy[:-1], dtype=np.int8).astype(bool)
        out = np.full(int(sizes.sum()), 0x20, dtype=np.uint8)
        text_at = np.ones(len(out), dtype=bool)
        ends = np.cumsum(sizes[kept])
        text_at[ends - 1] = False
        out[text_at] = block.data[inside]
        stops = np.cumsum(doc_bytes)
        buf = out.tobytes()
        texts = [buf[e - n: e - 1] if n else b"" for e, n in zip(stops.tolist(), doc_bytes.tolist())]
        n_words = np.diff(words.off)
        before = np.concatenate(([0], np.cumsum(kept)))
        n_kept = before[words.off[1:]] - before[words.off[:-1]]
        return pa.table({id_col: block.ids, "n_words": pa.array(n_words, pa.int64()),
                         "n_removed": pa.array(n_words - n_kept, pa.int64()),
                         "kept_text": pa.array(texts, pa.binary()).cast(pa.string())})

    return blocks.groupBy("block").cogroup(told.groupBy("block")).applyInArrow(remove, schema)
