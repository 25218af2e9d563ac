"""Cross-entropy difference scoring with matched target and background bigram models.

Both models are counted over the corpus: the background over all texts, the
target over those that are marked. They share one vocabulary, every word of the
corpus, and are matched in mass: background counts are scaled to the target's
number of tokens, so that both are smoothed alike. A text's score is the mean
over its tokens of the target's loss less the background's; low is like the
target. Counting is a round of blocks.py: a block asks with its own counts of
each distinct word and word pair and is told the corpus's counts.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tempora.llm import blocks as B

MASS = 4.0                  # tokens that the lower model counts for beside a context's own
TOTAL = B.U(0x5DEECE66D1B)  # stands for the corpus among the hashes


class Grams:
    """A block's words and word pairs, each with its place among the block's distinct hashes."""

    def __init__(self, block: B.Block, target: np.ndarray):
        words = B.Words(block, lower=True)
        self.n_words = np.diff(words.off)
        self.doc = words.doc
        h = words.hash
        first = np.zeros(len(h) + 1, dtype=bool)
        first[words.off[:-1]] = True
        self.first = first = first[:-1]
        before = np.where(first, B.U(1), np.concatenate(([B.U(1)], h))[:-1])  # a text's first word follows the start
        pair = B.mix(before * B.U(B.WORD_BASE) + h)
        word = B.mix(h ^ B.U(0x2545F4914F6CDD1D))
        n = len(h)
        start = B.mix(np.array([B.U(1) ^ B.U(0x2545F4914F6CDD1D)]))
        self.hash, place = np.unique(np.concatenate((word, pair, start, [TOTAL])), return_inverse=True)
        self.word, self.pair, start, self.total = place[:n], place[n: 2 * n], place[2 * n], place[2 * n + 1]
        self.context = np.where(first, start, np.concatenate(([0], self.word))[:-1])
        places = np.concatenate((place[: 2 * n], np.full(n, self.total), np.full(block.n, start)))
        marked = target[np.concatenate((self.doc, self.doc, self.doc, np.arange(block.n)))].astype(np.float64)
        self.count = np.bincount(places, minlength=len(self.hash)).astype(np.int64)
        self.target = np.bincount(places, weights=marked, minlength=len(self.hash)).astype(np.int64)

    def own(self, place: np.ndarray) -> np.ndarray:
        """How often the token's text has the gram of each token itself."""
        _, inv, n = np.unique(self.doc * len(self.hash) + place, return_inverse=True, return_counts=True)
        return n[inv]


def packed(g: Grams, n_buckets: int, number: int) -> pa.Table:
    """A block's counts by bucket: short hashes, then counts, then target counts. A byte holds a count up to 255;
    a larger one takes several entries of its hash."""
    times = np.maximum(1, -(-g.count // 255))
    h, place = np.repeat(g.hash, times), np.repeat(np.arange(len(times)), times)
    nth = np.arange(len(h)) - np.repeat(np.cumsum(times) - times, times)
    count = np.clip(g.count[place] - 255 * nth, 0, 255).astype(np.uint8)
    target = np.clip(g.target[place] - 255 * nth, 0, 255).astype(np.uint8)
    short = B.as_bytes((B.short_hash(h, n_buckets), B.HASH_BYTES))
    bounds = B.cut(h, n_buckets)
    some = np.flatnonzero(np.diff(bounds))
    return pa.table({
        "bucket": pa.array(some, pa.int32()), "block": pa.array([number] * len(some), pa.int32()),
        "payload": pa.array([b"".join(x[bounds[b]: bounds[b + 1]].tobytes() for x in (short, count, target)) for b in some], pa.binary())})


def add_up(key, table):
    """Each entry's corpus counts, as bytes by significance: what is mostly zero packs well."""
    table = table.sort_by("block")
    hashes, count, target, sizes = [], [], [], []
    for x in table.column("payload"):
        x = np.frombuffer(x.as_py(), dtype=np.uint8)
        n = len(x) // (B.HASH_BYTES + 2)
        sizes.append(n)
        hashes.append(B.from_bytes(x[: n * B.HASH_BYTES].reshape(n, B.HASH_BYTES), 0, B.HASH_BYTES))
        count.append(x[n * B.HASH_BYTES: n * (B.HASH_BYTES + 1)])
        target.append(x[n * (B.HASH_BYTES + 1):])
    _, inv = np.unique(np.concatenate(hashes), return_inverse=True)
    sums = [np.bincount(inv, weights=np.concatenate(c).astype(np.float64))[inv].astype("<u8") for c in (count, target)]
    planes = np.concatenate([s.view(np.uint8).reshape(-1, 8)[:, :6] for s in sums], axis=1)
    ends = np.cumsum(sizes)
    return pa.table({
        "block": table.column("block"), "bucket": pa.array([key[0].as_py()] * len(sizes), pa.int32()),
        "payload": pa.array([planes[e - s: e].T.tobytes() for s, e in zip(sizes, ends)], pa.binary())})


def corpus_counts(g: Grams, told: pa.Table) -> np.ndarray:
    """[count, target count] of each of the block's distinct hashes in the corpus."""
    times = np.maximum(1, -(-g.count // 255))
    parts = []
    for x in told.sort_by("bucket").column("payload"):
        x = np.frombuffer(x.as_py(), dtype=np.uint8).reshape(12, -1).T
        parts.append(np.stack([B.from_bytes(x, 0, 6), B.from_bytes(x, 6, 6)], axis=1))
    return np.concatenate(parts).astype(np.float64)[np.cumsum(times) - times].T


def losses(g: Grams, c: np.ndarray, target: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each token's loss under the target and the background, with the counts of its own text left out."""
    mine = np.bincount(g.doc, minlength=len(g.n_words))[g.doc].astype(np.float64)
    marked = target[g.doc].astype(np.float64)
    word, pair = g.own(g.word).astype(np.float64), g.own(g.pair).astype(np.float64)
    context = np.where(g.first, 1.0, np.concatenate(([1.0], word))[:-1])
    n_b = np.maximum(c[0, g.total] - mine, 1.0)
    n_t = np.maximum(c[1, g.total] - mine * marked, 0.0)
    match = n_t / n_b  # the background's mass becomes the target's
    base = np.maximum(c[0, g.word] - word, 0.5) / n_b  # of the shared vocabulary
    out = []
    for k, scale, own, n in ((1, 1.0, marked, n_t), (0, match, 1.0, n_t)):
        one = (scale * np.maximum(c[k, g.word] - own * word, 0) + MASS * base) / (n + MASS)
        two = (scale * np.maximum(c[k, g.pair] - own * pair, 0) + MASS * one) / (scale * np.maximum(c[k, g.context] - own * context, 0) + MASS)
        out.append(-np.log(two))
    return out[0], out[1]


def score_texts(docs: DataFrame, target_ids: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_tokens, target_loss, background_loss, score) for every row; losses in nats a token.

    Words are ``[^\\x20\\x09-\\x0D]+`` with A-Z lower-cased. The target model is counted over the rows whose
    id is in ``target_ids`` (same column name; repeats and nulls there don't matter), the background
    over all rows; a text's own counts are left out when it is scored. Null and empty texts have no
    tokens and null losses and score; without target texts every score is 0. Repeated rows and null
    ids are kept; other columns are not read.
    """
    blocks, n_blocks, total = B.text_blocks(docs, id_col, text_col, by_id=True)
    n_buckets = B.bucket_count(total // 6, B.HASH_BYTES + 2)
    marks = target_ids.select(F.xxhash64(F.col(id_col).cast(docs.schema[id_col].dataType)).alias("kd")).where(
        F.col(id_col).isNotNull()).distinct()
    marks = marks.select(F.pmod("kd", F.lit(n_blocks)).cast("int").alias("block"), F.lit(-1).alias("bucket"),
                         F.lit(None).cast("binary").alias("payload"), "kd")

    def opened(rows, told):
        rows = rows.sort_by([("kt", "ascending"), ("kd", "ascending")])
        block = B.Block(rows)
        target = pc.is_in(rows.column("kd"), value_set=told.column("kd").combine_chunks().drop_null()).to_numpy()
        return block, target, Grams(block, target)

    def ask(key, rows, told):
        if not len(rows):  # marks of ids that no row has
            return pa.table({"bucket": pa.array([], pa.int32()), "block": pa.array([], pa.int32()), "payload": pa.array([], pa.binary())})
        return packed(opened(rows, told)[2], n_buckets, key[0].as_py())

    told = blocks.groupBy("block").cogroup(marks.groupBy("block")).applyInArrow(ask, B.ASKED).groupBy("bucket").applyInArrow(
        add_up, B.ANSWERED)
    both = told.withColumn("kd", F.lit(None).cast("long")).unionByName(marks)
    schema = T.StructType([T.StructField(id_col, docs.schema[id_col].dataType), T.StructField("n_tokens", T.LongType()),
                           T.StructField("target_loss", T.DoubleType()), T.StructField("background_loss", T.DoubleType())])

    def score(key, rows, both):
        block, target, g = opened(rows, both)
        loss_t, loss_b = losses(g, corpus_counts(g, both.filter(pc.greater_equal(both.column("bucket"), 0))), target) if len(rows) else ([], [])
        n = g.n_words
        means = [np.bincount(g.doc, weights=x, minlength=block.n) / np.maximum(n, 1) for x in (loss_t, loss_b)]
        none = n == 0
        return pa.table({id_col: block.ids, "n_tokens": pa.array(n, pa.int64()), "target_loss": pa.array(means[0], pa.float64(), mask=none),
                         "background_loss": pa.array(means[1], pa.float64(), mask=none)})

    out = blocks.groupBy("block").cogroup(both.groupBy("block")).applyInArrow(score, schema)
    return out.withColumn("score", F.col("target_loss") - F.col("background_loss"))
