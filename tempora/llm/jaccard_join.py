"""Exact n-gram Jaccard self-join by signature trees.

1. Two rounds (see blocks.py) find the texts that can have a partner. In the
   first, each text asks about the least part of its shingles in hash order; a
   pair at the threshold must share several of these. In the second the texts
   left ask about all their shingles; those that no other text has can't be
   common, and a text needs three quarters of the rest. Equal sets are joined
   into one here.
2. With the rarest shingles first, a pair must share one of the first
   |x| - ceil(0.75 |x|) + 1. Sets are tied to the least set with the same such
   shingle; the components of these ties hold every pair.
3. In each component (cut into pairs of parts if it is very large) a signature
   tree is built over the sets: its nodes hold OR-combined token bitmaps and
   size ranges. A dual traversal prunes node pairs by the largest overlap that
   they allow, or if they are all linked already; the rest is compared exactly.
4. The components of the links found are the result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tempora.llm import blocks as B
from tempora.llm.components import connected_components
from tempora.llm.memory import give_back
from tempora.session import shared_path

WORDS = 5
PERCENT = 75
SHARE = 0.08      # shingles, of all, that a pair shares in its least ones, beyond those that may differ
PART = 2_048      # sets of a component that are compared in one task with another part
FANOUT = 8
BITS = 4_096
HUBS = 8


class Shingles:
    """The distinct shingles of each of a block's texts: hashes in ascending order text by text, and their bounds."""

    def __init__(self, block: B.Block, n: int = WORDS):
        words = B.Words(block, lower=True)
        at = words.window_starts(n)
        h = B.mix(B.SpanHash(words.hash, B.WORD_BASE).spans(at, at + n))
        doc = words.doc[at]
        n_words = np.diff(words.off)
        few = np.flatnonzero((n_words > 0) & (n_words < n))  # the whole sequence is one shingle
        if len(few):
            whole = B.SpanHash(words.hash, B.WORD_BASE).spans(words.off[few], words.off[few + 1])
            h = np.concatenate((h, B.mix(whole + n_words[few].astype(np.uint64))))
            doc = np.concatenate((doc, few))
        order = np.lexsort((h, doc))
        h, doc = h[order], doc[order]
        new = np.ones(len(h), dtype=bool)
        new[1:] = (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])
        self.hash, self.doc = h[new], doc[new]
        self.size = np.bincount(self.doc, minlength=block.n).astype(np.int64)
        self.off = np.concatenate(([0], np.cumsum(self.size)))
        # A hash for each set.
        self.set_hash = np.zeros(block.n, dtype=np.uint64)
        np.add.at(self.set_hash, self.doc, B.mix(self.hash ^ B.U(0x9E3779B97F4A7C15)))
        self.set_hash = B.mix(self.set_hash + self.size.astype(np.uint64))


def least_overlap(size: np.ndarray, percent: int) -> np.ndarray:
    """Shingles that a set of this size shares with any partner at least."""
    return -(-size * percent // 100)


def first_round(s: Shingles, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """(which shingles are asked about, how many of a text's must be shared)."""
    part = np.maximum(1, np.ceil(s.size * SHARE)).astype(np.int64)
    length = s.size - least_overlap(s.size, percent) + part
    asked = np.arange(len(s.hash)) - s.off[s.doc] < length[s.doc]
    # A partner has percent % of the size at least, and shares as many as the smaller of both parts.
    need = np.maximum(1, np.ceil(least_overlap(s.size, percent) * SHARE)).astype(np.int64)
    return asked, np.minimum(need, part)


def distinct(h: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(ascending distinct hashes, place of each, number of texts of each)."""
    u, inv, n = np.unique(h, return_inverse=True, return_counts=True)
    return u, inv, n


def block_counts(entries: np.ndarray, block: np.ndarray) -> np.ndarray:
    """For each entry how many blocks ask about it, as a class from 0 (one block), with 128 for the first of them."""
    h = B.from_bytes(entries, 0, entries.shape[1])
    order = np.argsort(h, kind="stable")  # entries come in the order of blocks
    new = np.ones(len(h), dtype=bool)
    new[1:] = h[order][1:] != h[order][:-1]
    group = np.cumsum(new) - 1
    n = np.bincount(group)[group]
    out = np.empty(len(h), dtype=np.uint8)
    out[order] = np.minimum(127, np.ceil(4 * np.log2(n))).astype(np.uint8) + 128 * new
    return out


# ---------------------------------------------------------------------------
# Signature trees.
# ---------------------------------------------------------------------------
class Links:
    """Union-find."""

    def __init__(self, n: int):
        self.up = list(range(n))

    def root(self, x: int) -> int:
        while self.up[x] != x:
            self.up[x] = x = self.up[self.up[x]]
        return x

    def join(self, a: int, b: int) -> None:
        a, b = self.root(a), self.root(b)
        if a != b:
            self.up[max(a, b)] = min(a, b)

    def roots(self) -> np.ndarray:
        return np.array([self.root(x) for x in range(len(self.up))], dtype=np.int64)


class Sets:
    """Sets as numbers of tokens, with sizes that count the tokens no other set has too."""

    def __init__(self, tokens: list[np.ndarray], size: np.ndarray, percent: int):
        self.n = len(tokens)
        self.size, self.percent = size.astype(np.int64), percent
        length = np.array([len(t) for t in tokens], dtype=np.int64)
        self.off = np.concatenate(([0], np.cumsum(length)))
        self.hash = np.concatenate(tokens)
        names, self.token = np.unique(self.hash, return_inverse=True)
        self.mark = np.zeros(len(names), dtype=bool)

    def linked(self, a: int, others: np.ndarray) -> np.ndarray:
        """Which of the others are linked with ``a``: percent % of the union or more is common."""
        own = self.token[self.off[a]: self.off[a + 1]]
        self.mark[own] = True
        n = self.off[others + 1] - self.off[others]
        at = np.repeat(self.off[others] - np.concatenate(([0], np.cumsum(n)[:-1])), n) + np.arange(n.sum())
        common = np.add.reduceat(self.mark[self.token[at]].astype(np.int64), np.concatenate(([0], np.cumsum(n)[:-1])))
        self.mark[own] = False
        return 100 * common >= self.percent * (self.size[a] + self.size[others] - common)


class SignatureTree:
    """Levels of nodes over sets; a node has the OR of its sets' bitmaps, their sizes' range and their fewest bits."""

    def __init__(self, sets: Sets, members: np.ndarray):
        # Sets with the same least tokens stand side by side, so that nodes are alike inside.
        key = np.array([sets.hash[sets.off[i]: sets.off[i + 1]].min() for i in members.tolist()], dtype=np.uint64)
        self.members = members[np.lexsort((sets.size[members], key))]
        bits = np.zeros((len(members), BITS // 8), dtype=np.uint8)
        for row, i in enumerate(self.members.tolist()):
            b = (sets.hash[sets.off[i]: sets.off[i + 1]] & B.U(BITS - 1)).astype(np.int64)
            flags = np.zeros(BITS, dtype=bool)
            flags[b] = True
            bits[row] = np.packbits(flags)
        bits = bits.view(np.uint64)
        size = sets.size[self.members]
        count = np.bitwise_count(bits).sum(axis=1).astype(np.int64)
        self.levels = [(bits, size, size, count)]
        while len(self.levels[-1][0]) > 1:
            bits, low, high, count = self.levels[-1]
            cuts = np.arange(0, len(bits), FANOUT)
            self.levels.append((np.bitwise_or.reduceat(bits, cuts, axis=0), np.minimum.reduceat(low, cuts),
                                np.maximum.reduceat(high, cuts), np.minimum.reduceat(count, cuts)))

    def classes(self, roots: np.ndarray) -> list[np.ndarray]:
        """For each level the class that all sets of a node are in, or -1."""
        level = roots[self.members]
        out = [level]
        for bits, *_ in self.levels[1:]:
            cuts = np.arange(0, len(level), FANOUT)
            low, high = np.minimum.reduceat(level, cuts), np.maximum.reduceat(level, cuts)
            level = np.where(low == high, low, -1)
            out.append(level)
        return out


def possible(a: tuple, i: np.ndarray, b: tuple, j: np.ndarray, percent: int) -> np.ndarray:
    """Whether sets below node i of level ``a`` and node j of level ``b`` can be linked."""
    low_a, high_a, low_b, high_b = a[1][i], a[2][i], b[1][j], b[2][j]
    ok = (100 * high_a >= percent * low_b) & (100 * high_b >= percent * low_a)
    for at in range(0, len(i), 20_000):
        s = slice(at, at + 20_000)
        shared = np.bitwise_count(a[0][i[s]] & b[0][j[s]]).sum(axis=1).astype(np.int64)
        # Bits that a set has and no set of the other node has are tokens that aren't common.
        most = np.minimum(high_a[s] - np.maximum(0, a[3][i[s]] - shared), high_b[s] - np.maximum(0, b[3][j[s]] - shared))
        ok[s] &= (100 + percent) * most >= percent * (low_a[s] + low_b[s])
    return ok


def children(i: np.ndarray, j: np.ndarray, n_i: int, n_j: int, same: bool) -> tuple[np.ndarray, np.ndarray]:
    """All pairs of children; of a tree with itself each pair once."""
    x, y = np.meshgrid(np.arange(FANOUT), np.arange(FANOUT), indexing="ij")
    a = (i[:, None] * FANOUT + x.ravel()).ravel()
    b = (j[:, None] * FANOUT + y.ravel()).ravel()
    ok = (a < n_i) & (b < n_j)
    if same:
        ok &= a <= b
    return a[ok], b[ok]


def link_sets(sets: Sets, left: np.ndarray, right: np.ndarray | None) -> np.ndarray:
    """Root of each set, after all links inside ``left``, or between ``left`` and ``right``."""
    links = Links(sets.n)
    everyone = np.arange(sets.n)
    tried = np.zeros(sets.n, dtype=bool)
    for _ in range(HUBS):  # groups of near copies are mostly linked with one of them
        roots = links.roots()
        alone = np.flatnonzero((np.bincount(roots, minlength=sets.n)[roots] == 1) & ~tried)
        if not len(alone) or sets.n < 3:
            break
        hub = int(alone[0])
        tried[hub] = True
        for x in everyone[sets.linked(hub, everyone)].tolist():
            links.join(hub, x)
    a = SignatureTree(sets, left)
    b = a if right is None else SignatureTree(sets, right)
    levels = max(len(a.levels), len(b.levels))
    for t in (a, b):
        while len(t.levels) < levels:
            t.levels.append(t.levels[-1])
    roots = links.roots()
    class_a, class_b = a.classes(roots), b.classes(roots)
    i = j = np.zeros(1, dtype=np.int64)
    for level in range(levels - 1, -1, -1):
        if level < levels - 1:
            i, j = children(i, j, len(a.levels[level][0]), len(b.levels[level][0]), a is b)
        linked = (class_a[level][i] == class_b[level][j]) & (class_a[level][i] >= 0)
        i, j = i[~linked], j[~linked]
        ok = possible(a.levels[level], i, b.levels[level], j, sets.percent)
        i, j = i[ok], j[ok]
    order = np.argsort(i, kind="stable")
    i, j = a.members[i[order]], b.members[j[order]]
    cuts = np.flatnonzero(np.diff(i)) + 1
    for x, others in zip(i[np.concatenate(([0], cuts))].tolist() if len(i) else [], np.split(j, cuts)):
        own = links.root(x)
        others = np.array([y for y in others.tolist() if links.root(y) != own], dtype=np.int64)
        if len(others):
            for y in others[sets.linked(x, others)].tolist():
                links.join(x, y)
    return links.roots()


def jaccard_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS,
                       percent: int = PERCENT) -> DataFrame:
    """(id, n_shingles, component_id) for every row.

    A text's set holds its distinct runs of ``words`` words (``[^\\x20\\x09-\\x0D]+``, A-Z lower-cased), or
    the whole sequence if it has fewer; without words it is empty and linked with nothing. Two texts
    are linked when 100 times their common shingles are ``percent`` times all their shingles or more.
    ``component_id`` is the least id reachable by links (null ids are passed over; a row that reaches
    no id has null). Repeated rows and ids are kept, each with its own component. Other columns are
    not read. Sets are compared by 64-bit hashes of their shingles.
    """
    spark = docs.sparkSession
    blocks, _, total = B.text_blocks(docs, id_col, text_col)
    n_buckets = B.bucket_count(total // 12, B.HASH_BYTES)

    def ask_least(block):
        s = Shingles(block, words)
        asked, _ = first_round(s, percent)
        h = np.unique(s.hash[asked])
        return h, B.as_bytes((B.short_hash(h, n_buckets), B.HASH_BYTES))

    def candidates(block, told):
        """The block's shingles, and its texts that share enough of their least ones."""
        s = Shingles(block, words)
        asked, need = first_round(s, percent)
        _, inv, n = distinct(s.hash[asked], s.doc[asked])
        code = B.answers_of(told, np.uint8)
        shared = ((code & 127) > 0) | (n > 1) if len(n) else np.zeros(0, dtype=bool)
        got = np.bincount(s.doc[asked][shared[inv]], minlength=block.n) if len(n) else np.zeros(block.n, dtype=np.int64)
        keep = (s.size > 0) & (got >= need)
        own = keep[s.doc]
        u, inv, n = distinct(s.hash[own], s.doc[own])
        return s, keep, own, u, inv, n

    first = B.answer(B.ask(blocks, ask_least, n_buckets), B.HASH_BYTES, block_counts)

    def ask_all(key, rows, told):
        s, keep, _, u, _, _ = candidates(B.Block(rows), told)
        # The sets' hashes go whole, to buckets of their own: the first block that has a set sends it.
        sets = np.unique(s.set_hash[keep])
        buckets, payloads = [], []
        for h, payload, base in ((u, B.as_bytes((B.short_hash(u, n_buckets), B.HASH_BYTES)), 0), (sets, B.as_bytes((sets, 8)), n_buckets)):
            bounds = B.cut(h, n_buckets)
            some = np.flatnonzero(np.diff(bounds))
            buckets += (base + some).tolist()
            payloads += [payload[bounds[b]: bounds[b + 1]].tobytes() for b in some]
        give_back()
        return pa.table({"bucket": pa.array(buckets, pa.int32()), "block": pa.array([key[0].as_py()] * len(buckets), pa.int32()),
                         "payload": pa.array(payloads, pa.binary())})

    second = B.answer(blocks.groupBy("block").cogroup(first.groupBy("block")).applyInArrow(ask_all, B.ASKED),
                      lambda bucket: B.HASH_BYTES if bucket < n_buckets else 8, block_counts)
    told = first.withColumn("round", F.lit(1)).unionByName(second.withColumn("round", F.lit(2)))
    schema = T.StructType([
        T.StructField("id", docs.schema[id_col].dataType), T.StructField("n_shingles", T.LongType()), T.StructField("set", T.LongType()),
        T.StructField("node", T.LongType()), T.StructField("prefix", T.ArrayType(T.LongType())), T.StructField("tokens", T.BinaryType())])

    def describe(key, rows, told):
        block = B.Block(rows)
        which = told.column("round").to_numpy()
        s, keep, own, u, inv, n = candidates(block, told.filter(pa.array(which == 1)))
        code = B.answers_of(told.filter(pa.array(which == 2)), np.uint8)
        out_set: list = [None] * block.n
        out_node: list = [None] * block.n
        out_prefix: list = [None] * block.n
        out_tokens: list = [None] * block.n
        if len(u):
            rank = (code[:len(u)] & 127).astype(np.int64)
            shared = (rank > 0) | (n > 1)
            h, doc, rank, shared = s.hash[own], s.doc[own], rank[inv], shared[inv]
            order = np.lexsort((h, rank, doc))  # rare first
            h, doc, shared = h[order], doc[order], shared[order]
            size = s.size
            off = np.concatenate(([0], np.cumsum(np.where(keep, size, 0))))
            n_shared = np.bincount(doc[shared], minlength=block.n)
            length = size - least_overlap(size, percent) + 1
            in_prefix = (np.arange(len(h)) - off[doc] < length[doc]) & shared
            first_block = (code[len(u):][np.unique(s.set_hash[keep], return_inverse=True)[1]] & 128) > 0
            seen = set()
            number = key[0].as_py() << 32
            for i, is_first in zip(np.flatnonzero(keep).tolist(), first_block.tolist()):
                if n_shared[i] < least_overlap(size[i: i + 1], percent)[0]:
                    continue
                name = int(s.set_hash[i].astype(np.int64))
                out_set[i] = name
                if is_first and name not in seen:
                    seen.add(name)
                    part = slice(off[i], off[i + 1])
                    out_node[i] = number | i
                    out_prefix[i] = h[part][in_prefix[part]].view(np.int64)
                    out_tokens[i] = h[part][shared[part]].tobytes()
        give_back()
        return pa.table({"id": block.ids, "n_shingles": pa.array(s.size, pa.int64()), "set": pa.array(out_set, pa.int64()),
                         "node": pa.array(out_node, pa.int64()), "prefix": pa.array(out_prefix, pa.list_(pa.int64())),
                         "tokens": pa.array(out_tokens, pa.binary())})

    path = shared_path(spark, "jaccard", unique=True)
    blocks.groupBy("block").cogroup(told.groupBy("block")).applyInArrow(describe, schema).write.parquet(path)
    rows = spark.read.schema(schema).parquet(path)

    # Candidate components: ties through shared prefix shingles.
    held = rows.where("node IS NOT NULL").select("node", F.explode("prefix").alias("token"))
    hubs = held.groupBy("token").agg(F.min("node").alias("hub"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    ties = held.join(hubs, "token").where("node <> hub").select(F.col("node").alias("a"), F.col("hub").alias("b")).distinct()
    groups = connected_components(ties)

    # Each component, or each pair of its parts, in one task.
    parts = groups.groupBy("label").agg(F.ceil(F.count(F.lit(1)) / F.lit(PART)).cast("int").alias("parts"))
    own = F.pmod(F.xxhash64("node"), F.col("parts")).cast("int")
    dealt = groups.join(parts, "label").withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    dealt = dealt.select("node", "label", "own", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"))
    sets = rows.where("node IS NOT NULL").select("node", "n_shingles", "tokens")

    def compare(key, table):
        table = table.sort_by("node")
        node = table.column("node").to_numpy()
        part = table.column("own").to_numpy()
        tokens = [np.frombuffer(x.as_py(), dtype=np.uint64) for x in table.column("tokens")]
        low, high = key[1].as_py(), key[2].as_py()
        left, right = np.flatnonzero(part == low), np.flatnonzero(part == high)
        if not len(left) or not len(right):
            return pa.table({"a": pa.array([], pa.int64()), "b": pa.array([], pa.int64())})
        roots = link_sets(Sets(tokens, table.column("n_shingles").to_numpy(), percent), left, None if low == high else right)
        linked = np.flatnonzero(roots != np.arange(len(roots)))
        give_back()
        return pa.table({"a": pa.array(node[linked], pa.int64()), "b": pa.array(node[roots[linked]], pa.int64())})

    links = dealt.join(sets, "node").groupBy("label", "low", "high").applyInArrow(compare, "a long, b long")
    joined = connected_components(links)

    # Least id of each component: of the sets' rows first, then over the component.
    nodes = rows.where("node IS NOT NULL").select("set", "node").join(joined, "node", "left").select(
        "set", F.coalesce("label", "node").alias("label"))
    least = rows.where("set IS NOT NULL").groupBy("set").agg(F.min("id").alias("least")).join(nodes, "set")
    least = least.join(least.groupBy("label").agg(F.min("least").alias("component_id")), "label").select("set", "component_id")
    out = rows.select("id", "n_shingles", "set").join(least, "set", "left")
    return out.select(F.col("id").alias(id_col), "n_shingles", F.coalesce("component_id", "id").alias("component_id"))
