"""Removal of byte strings that repeat anywhere, by suffix arrays built by two-stage sorting.

Every string of LENGTH bytes is assigned to the least k-gram hash inside it (its
anchor), so equal strings have equal anchors. The starts of one anchor in one
text are a run; with the bytes that their strings cover they are a *region*.
Regions whose anchor is met once in the corpus hold no repeated string. Equal
regions are counted and kept once. The regions left, grouped by anchor, go to
tasks, where their suffixes are sorted: directly only those that are smaller
than their successor, the others induced from them by a scan over the buckets;
common prefixes of neighbours in the array then show the repeated strings. An
anchor with very many different regions is dealt over several groups, whose
classes of equal strings are matched by hash afterwards. blocks.py has the rounds.
"""

from __future__ import annotations

from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tempora.llm import blocks as B
from tempora.llm.memory import give_back

LENGTH = 400
GRAM = 128            # bytes of the anchor's k-gram
CHUNK = 1 << 18       # starts that are looked at together
GROUP_REGIONS = 2_048  # different regions of one anchor that go to one group
TASK_BYTES = 1 << 19  # bytes of regions in a group, about
END = 0xFF            # after each region; no UTF-8 text holds it, and it is larger than any byte
POSITION_BITS = 24
BLOCK_BYTES = 1 << 20
MULTIPLE, SORT, SEND = 1, 2, 4


class Regions:
    """A block's regions: first start, number of starts, hash of the anchor and hash of the content."""

    def __init__(self, block: B.Block, length: int, gram: int):
        data, off = block.data, block.off
        first, count, anchor, content = [], [], [], []
        window = length - gram + 1
        for a in range(0, max(0, len(data) - length + 1), CHUNK):
            part = data[a: a + CHUNK + length - 1]
            spans = B.SpanHash(B.BYTE_VALUES[part])
            grams = B.mix(spans.every(gram))
            n = len(part) - length + 1
            low = B.U((1 << POSITION_BITS) - 1)
            key = (grams & ~low) | (low - np.arange(len(grams), dtype=np.uint64))  # the least hash, the last of equals
            at = (low - (sliding_min(key, window)[:n] & low)).astype(np.int64)
            start = np.arange(n)
            doc = np.searchsorted(off, start + a, side="right") - 1
            fits = start + a + length <= off[doc + 1]
            start, at = start[fits], at[fits]
            if not len(start):
                continue
            new = np.ones(len(start), dtype=bool)
            new[1:] = (at[1:] != at[:-1]) | (start[1:] != start[:-1] + 1)
            s = start[new]
            n = np.diff(np.concatenate((np.flatnonzero(new), [len(start)])))
            first.append(s + a)
            count.append(n)
            anchor.append(grams[at[new]])
            content.append(B.mix(spans.spans(s, s + n + length - 1) + n.astype(np.uint64)))
        join = lambda x, t: np.concatenate(x) if x else np.zeros(0, dtype=t)
        self.first, self.count = join(first, np.int64), join(count, np.int64)
        self.anchor, self.content = join(anchor, np.uint64), join(content, np.uint64)
        # Different regions in ascending order of anchor and content, and each region's place among them.
        order = np.lexsort((self.content, self.anchor))
        a, c = self.anchor[order], self.content[order]
        new = np.ones(len(a), dtype=bool)
        new[1:] = (a[1:] != a[:-1]) | (c[1:] != c[:-1])
        place = np.cumsum(new) - 1
        self.place = np.empty(len(order), dtype=np.int64)
        self.place[order] = place
        self.of = order[new]  # a region of each kind
        self.times = np.bincount(place, minlength=len(self.of))


def sliding_min(x: np.ndarray, window: int) -> np.ndarray:
    """Least of each ``window`` elements in a row."""
    n = len(x) - window + 1
    rows = -(-len(x) // window)
    grid = np.full(rows * window, np.iinfo(x.dtype).max, dtype=x.dtype)
    grid[: len(x)] = x
    grid = grid.reshape(rows, window)
    up = np.minimum.accumulate(grid, axis=1).ravel()
    down = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(down[:n], up[window - 1: window - 1 + n])


def ask_regions(length: int, gram: int, block: B.Block) -> tuple[np.ndarray, np.ndarray]:
    r = Regions(block, length, gram)
    return r.anchor[r.of], B.as_bytes((r.anchor[r.of], 8), (r.content[r.of], 8), (np.minimum(r.times, 2), 1))


def judge_regions(group_regions: int, entries: np.ndarray, block: np.ndarray) -> np.ndarray:
    """For each entry: whether its region is met twice or more, whether its anchor has other regions too, whether it
    is the one to send the region; in the high bits the logarithm of the number of groups for the anchor."""
    anchor, content, times = B.from_bytes(entries, 0, 8), B.from_bytes(entries, 8, 8), entries[:, 16].astype(np.int64)
    order = np.lexsort((block, content, anchor))
    a, c = anchor[order], content[order]
    new_a = np.ones(len(a), dtype=bool)
    new_a[1:] = a[1:] != a[:-1]
    new = new_a.copy()
    new[1:] |= c[1:] != c[:-1]
    kind, group = np.cumsum(new) - 1, np.cumsum(new_a) - 1
    multiple = np.bincount(kind, weights=times[order])[kind] > 1
    kinds = np.bincount(group, weights=new)[group]
    deals = np.ceil(np.log2(np.maximum(1, kinds / group_regions))).astype(np.uint8)
    sort = (kinds > 1) | multiple
    out = np.empty(len(entries), dtype=np.uint8)
    out[order] = multiple * MULTIPLE + sort * SORT + (sort & new) * SEND + (deals << 3)
    return out


# ---------------------------------------------------------------------------
# Suffix arrays.
# ---------------------------------------------------------------------------
class SuffixArray:
    """The suffixes at the valid starts of some regions, in order of their first ``length`` bytes.

    The end of a region counts as larger than any byte. ``order`` holds the positions, ``same``
    whether a suffix agrees with the one before in ``length`` bytes or more.
    """

    def __init__(self, texts: list[bytes], n_starts: np.ndarray, length: int):
        sizes = np.array([len(t) for t in texts], dtype=np.int64)
        step = sizes + 8
        self.base = np.concatenate(([0], np.cumsum(step)))[:-1]
        sep = bytes([END]) * 8
        self.data = np.frombuffer(sep.join([*texts, b""]), dtype=np.uint8)
        self.length = length
        self.region = np.repeat(np.arange(len(texts)), step)
        self.end = (self.base + sizes)[self.region]
        self.hash = B.SpanHash(B.BYTE_VALUES[self.data])
        n = len(self.data)
        position = np.arange(n)
        self.valid = position < (self.base + n_starts)[self.region]
        smaller = self._smaller_than_successor()
        inside = position < self.end
        # Past the valid starts of a region, up to its first directly sorted suffix: the chain's end.
        direct_at = np.flatnonzero(smaller & inside)
        limit = self.base + n_starts
        chain = direct_at[np.minimum(np.searchsorted(direct_at, limit), len(direct_at) - 1)] if len(direct_at) else limit
        used = self.valid | ((position <= chain[self.region]) & inside)
        direct = np.flatnonzero(used & smaller)
        self.order = self._induce(self._sort(direct), used & ~smaller)
        self.order = self.order[self.valid[self.order]]
        self.same = np.zeros(len(self.order), dtype=bool)
        if len(self.order) > 1:
            self.same[1:] = self._equal(self.order[1:], self.order[:-1], np.zeros(len(self.order) - 1, np.int64),
                                        np.full(len(self.order) - 1, length))

    def _smaller_than_successor(self) -> np.ndarray:
        """Whether a suffix is smaller than the next: by the first byte that differs from its successor."""
        n = len(self.data)
        change = np.flatnonzero(self.data[1:] != self.data[:-1])
        nxt = change[np.minimum(np.searchsorted(change, np.arange(n)), len(change) - 1)] if len(change) else np.full(n, n - 2)
        nxt = np.minimum(nxt, n - 2)
        return self.data[nxt + 1] > self.data[nxt]

    def _equal(self, p: np.ndarray, q: np.ndarray, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
        """Whether the suffixes agree from byte ``start`` up to ``stop`` of them, all within their regions."""
        return self.hash.spans(p + start, p + stop) == self.hash.spans(q + start, q + stop)

    def _common(self, p: np.ndarray, q: np.ndarray, known: np.ndarray) -> np.ndarray:
        """Length of the common prefix, ``known`` or more, at most ``length`` and within both regions."""
        low = known.copy()
        high = np.minimum(self.length, np.minimum(self.end[p] - p, self.end[q] - q))
        high = np.maximum(high, low)
        while True:
            open_ = np.flatnonzero(low < high)
            if not len(open_):
                return low
            mid = (low[open_] + high[open_] + 1) // 2
            eq = self._equal(p[open_], q[open_], low[open_], mid)
            low[open_[eq]] = mid[eq]
            high[open_[~eq]] = mid[~eq] - 1

    def _sort(self, at: np.ndarray) -> np.ndarray:
        """Direct sort: by eight bytes, then ties by the eight bytes after what a tie has in common."""
        if not len(at):
            return at
        eight = np.ndarray(shape=(len(self.data) - 7,), dtype=">u8", buffer=self.data, strides=(1,))
        key = eight[np.minimum(at, len(eight) - 1)].astype(np.uint64)
        order = np.argsort(key, kind="stable")
        at, key = at[order], key[order]
        slot = np.arange(len(at))  # where the open ties stand in the result
        tie = np.concatenate(([0], np.cumsum(key[1:] != key[:-1])))
        depth = np.full(len(at), 8)  # bytes known to agree
        while True:
            # Open ties have two suffixes or more, and none of them has ended by its depth.
            some = (np.bincount(tie)[tie] > 1) & (depth < self.length) & (depth <= self.end[at[slot]] - at[slot])
            if not some.any():
                return at
            slot, tie, depth = slot[some], tie[some], depth[some]
            heads = np.concatenate(([0], np.flatnonzero(tie[1:] != tie[:-1]) + 1))
            tie = np.repeat(np.arange(len(heads)), np.diff(np.concatenate((heads, [len(tie)]))))
            p = at[slot]
            least = np.minimum.reduceat(self._common(p, p[heads][tie], depth), heads)[tie]
            key = eight[np.minimum(p + least, len(eight) - 1)].astype(np.uint64)
            key[p + least >= self.end[p]] = np.iinfo(np.uint64).max
            order = np.lexsort((key, tie))
            key, tie, depth = key[order], tie[order], least[order] + 8
            at[slot] = p[order]
            tie = np.concatenate(([0], np.cumsum((key[1:] != key[:-1]) | (tie[1:] != tie[:-1]))))

    def _induce(self, direct: np.ndarray, induced: np.ndarray) -> np.ndarray:
        """All suffixes in order: a scan from the least bucket up puts the predecessors of what is in order.

        In a bucket (by first byte) the suffixes larger than their successor come first, in the
        order of their successors; all of these stand in earlier buckets or earlier in this one.
        """
        data = self.data
        first = data[direct]
        bounds = np.searchsorted(first, np.arange(257))  # direct suffixes are in order
        waiting: list[list[np.ndarray]] = [[] for _ in range(256)]
        out = []
        for c in range(256):
            part = np.concatenate(waiting[c]) if waiting[c] else np.zeros(0, dtype=np.int64)
            runs = [part]
            while len(part):  # runs of one byte: the predecessor is in this bucket too
                before = part - 1
                part = before[(before >= 0) & induced[before] & (data[before] == c)]
                runs.append(part)
            bucket = np.concatenate([*runs, direct[bounds[c]: bounds[c + 1]]])
            if not len(bucket):
                continue
            out.append(bucket)
            before = bucket - 1
            before = before[(before >= 0) & induced[before]]
            before = before[data[before] > c]
            if len(before):
                byte = data[before]
                order = np.argsort(byte, kind="stable")
                before, byte = before[order], byte[order]
                cuts = np.flatnonzero(byte[1:] != byte[:-1]) + 1
                for x, part in zip(byte[np.concatenate(([0], cuts))].tolist(), np.split(before, cuts)):
                    waiting[x].append(part)
        return np.concatenate(out) if out else np.zeros(0, dtype=np.int64)


def runs_of(flags: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(start, end) of each run of true values."""
    edge = np.diff(np.concatenate(([0], flags.astype(np.int8), [0])))
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)


FOUND = T.StructType([T.StructField("route", T.LongType()), T.StructField("kind", T.IntegerType()), T.StructField("block", T.IntegerType()),
                      T.StructField("place", T.IntegerType()), T.StructField("payload", T.BinaryType())])
FOUND_ARROW = pa.schema([("route", pa.int64()), ("kind", pa.int32()), ("block", pa.int32()), ("place", pa.int32()), ("payload", pa.binary())])
CLASS = np.dtype([("string", "<u8"), ("anchor", "<i8"), ("block", "<i4"), ("place", "<i4"), ("start", "<i4"), ("single", "<i4")])


def repeated_starts(table: pa.Table, length: int, routes: int) -> list[dict]:
    """Rows of FOUND for one group of regions (anchor, deals, block, place, multiple, starts, bytes).

    kind 0: the starts of a region that repeat, as bits. kind 1, for anchors that are dealt over
    several groups: the group's classes of equal strings whose hash has a route, each with one of
    its regions and starts, and whether nothing in this group repeats it yet.
    """
    texts = [x.as_py() for x in table.column("bytes")]
    n_starts = table.column("starts").to_numpy()
    multiple = table.column("multiple").to_numpy()
    anchor, deals = table.column("anchor").to_numpy(), table.column("deals").to_numpy()
    block, place = table.column("block").to_numpy(), table.column("place").to_numpy()
    sa = SuffixArray(texts, n_starts, length)
    classes = np.cumsum(~sa.same) - 1
    region = sa.region[sa.order]
    weight = np.bincount(classes, weights=np.where(multiple[region] > 0, 2, 1)) if len(classes) else np.zeros(0)
    hit = np.zeros(len(sa.data), dtype=bool)
    hit[sa.order[weight[classes] > 1]] = True
    out = []
    for i in np.flatnonzero(multiple == 0).tolist():
        flags = hit[sa.base[i]: sa.base[i] + n_starts[i]]
        if flags.any():
            out.append({"route": int(block[i]) % routes, "kind": 0, "block": int(block[i]), "place": int(place[i]),
                        "payload": np.packbits(flags).tobytes()})
    heads = np.flatnonzero(~sa.same)
    heads = heads[deals[region[heads]] > 0]
    if len(heads):
        at, r = sa.order[heads], region[heads]
        rows = np.empty(len(heads), dtype=CLASS)
        rows["string"] = B.mix(sa.hash.spans(at, at + length))
        rows["anchor"], rows["block"], rows["place"] = anchor[r], block[r], place[r]
        rows["start"], rows["single"] = at - sa.base[r], weight[classes[heads]] == 1
        route = (rows["string"] % B.U(routes)).astype(np.int64)
        rows, route = rows[(order := np.argsort(route, kind="stable"))], route[order]
        bounds = np.searchsorted(route, np.arange(routes + 1))
        for k in np.flatnonzero(np.diff(bounds)).tolist():
            out.append({"route": k, "kind": 1, "block": 0, "place": 0, "payload": rows[bounds[k]: bounds[k + 1]].tobytes()})
    return out


def match_classes(table: pa.Table) -> pa.Table:
    """kind 0 as it is; of kind 1 the places and starts whose string another group has too, as kind 2 by block."""
    plain = table.filter(pc.equal(table.column("kind"), 0))
    dealt = table.filter(pc.equal(table.column("kind"), 1))
    if not len(dealt):
        return plain
    rows = np.frombuffer(b"".join(x.as_py() for x in dealt.column("payload")), dtype=CLASS)
    order = np.lexsort((rows["anchor"], rows["string"]))
    rows = rows[order]
    new = np.ones(len(rows), dtype=bool)
    new[1:] = (rows["string"][1:] != rows["string"][:-1]) | (rows["anchor"][1:] != rows["anchor"][:-1])
    group = np.cumsum(new) - 1
    rows = rows[(np.bincount(group)[group] > 1) & (rows["single"] > 0)]
    rows = rows[np.argsort(rows["block"], kind="stable")]
    blocks, first = np.unique(rows["block"], return_index=True)
    found = [{"route": 0, "kind": 2, "block": int(b), "place": 0,
              "payload": np.stack((part["place"], part["start"]), axis=1).astype("<i4").tobytes()}
             for b, part in zip(blocks, np.split(rows, first[1:]))]
    return pa.concat_tables([plain, pa.Table.from_pylist(found, FOUND_ARROW)])


def suffix_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH,
                 group_regions: int = GROUP_REGIONS) -> DataFrame:
    """(id, n_bytes, n_removed, removed, kept): each text's UTF-8 bytes without any repeated string.

    A byte goes if a string of ``length`` bytes that covers it also starts anywhere else, in the same
    text included; strings are judged on the input and never cross texts. ``removed`` lists the
    maximal removed runs as (start, end) in bytes, ``kept`` is the rest (it may begin or end inside
    a character). Null and empty texts have no bytes; every row is kept, repeated rows and null ids
    too (equal rows repeat each other). Other columns are not read and may have any names.
    """
    gram = max(1, min(GRAM, length // 3))
    blocks, _, total = B.text_blocks(docs, id_col, text_col, BLOCK_BYTES)
    n_buckets = B.bucket_count(2 * total // (length - gram + 2), 17)  # about two anchors in as many places as a string has grams
    told = B.answer(B.ask(blocks, partial(ask_regions, length, gram), n_buckets), 17,
                    partial(judge_regions, group_regions))
    n_groups = max(1, total // (2 * TASK_BYTES))

    def send(key, rows, told):
        block = B.Block(rows)
        r = Regions(block, length, gram)
        code = B.answers_of(told, np.uint8)
        kinds = np.flatnonzero(code & SEND) if len(code) else np.zeros(0, np.int64)
        of = r.of[kinds]
        deals = code[kinds] >> 3
        salt = (r.content[of] & ((np.uint64(1) << deals.astype(np.uint64)) - np.uint64(1))).astype(np.int64)
        group = (r.anchor[of] % np.uint64(n_groups)).astype(np.int64)
        data = block.data.tobytes()
        return pa.table({
            "anchor": pa.array(r.anchor[of].view(np.int64)), "grp": pa.array(group), "salt": pa.array(salt),
            "deals": pa.array(deals, pa.int32()), "block": pa.array([key[0].as_py()] * len(of), pa.int32()),
            "place": pa.array(kinds, pa.int32()), "multiple": pa.array((code[kinds] & MULTIPLE).astype(np.int32)),
            "starts": pa.array(r.count[of], pa.int32()),
            "bytes": pa.array([data[a: a + n + length - 1] for a, n in zip(r.first[of].tolist(), r.count[of].tolist())], pa.binary())})

    regions = blocks.groupBy("block").cogroup(told.groupBy("block")).applyInArrow(
        send, "anchor long, grp long, salt long, deals int, block int, place int, multiple int, starts int, bytes binary")

    def sort(key, table):
        out = repeated_starts(table.sort_by([("block", "ascending"), ("place", "ascending")]), length, n_buckets)
        give_back()
        return pa.Table.from_pylist(out, FOUND_ARROW)

    sorted_ = regions.groupBy("grp", "salt").applyInArrow(sort, FOUND)
    found = sorted_.groupBy("route").applyInArrow(
        lambda key, table: match_classes(table), FOUND)
    both = told.select("block", "bucket", F.lit(-1).alias("kind"), F.lit(0).alias("place"), "payload").unionByName(
        found.select("block", F.lit(0).alias("bucket"), "kind", "place", "payload"))
    run = T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())])
    schema = T.StructType([T.StructField(id_col, docs.schema[id_col].dataType), T.StructField("n_bytes", T.LongType()),
                           T.StructField("n_removed", T.LongType()), T.StructField("removed", T.ArrayType(run)),
                           T.StructField("kept", T.BinaryType())])
    run_arrow = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))

    def remove(key, rows, both):
        block = B.Block(rows)
        r = Regions(block, length, gram)
        kind = both.column("kind").to_numpy()
        code = B.answers_of(both.filter(pa.array(kind == -1)), np.uint8)
        edge = np.zeros(len(block.data) + 1, dtype=np.int32)
        if len(code):
            whole = np.flatnonzero(((code & MULTIPLE) > 0)[r.place])  # every string of such a region repeats
            np.add.at(edge, r.first[whole], 1)
            np.add.at(edge, r.first[whole] + r.count[whole] + length - 1, -1)
        for k, place, payload in zip(kind.tolist(), both.column("place").to_pylist(), both.column("payload").to_pylist()):
            if k == -1:
                continue
            if k == 0:
                at = r.of[place]
                a, b = runs_of(np.unpackbits(np.frombuffer(payload, np.uint8), count=r.count[at]))
            else:
                at, a = np.frombuffer(payload, dtype="<i4").reshape(-1, 2).T.astype(np.int64)
                at, b = r.of[at], a + 1
            np.add.at(edge, r.first[at] + a, 1)
            np.add.at(edge, r.first[at] + b + length - 1, -1)
        gone = np.cumsum(edge[:-1], dtype=np.int32) > 0
        n_bytes = np.diff(block.off)
        before = np.concatenate(([0], np.cumsum(gone)))
        n_removed = before[block.off[1:]] - before[block.off[:-1]]
        kept = block.data[~gone].tobytes()
        at = block.off - before[block.off]
        give_back()
        lists, texts = [], []
        for i in range(block.n):
            a, b = runs_of(gone[block.off[i]: block.off[i + 1]]) if n_removed[i] else ((), ())
            lists.append([{"start": int(x), "end": int(y)} for x, y in zip(a, b)])
            texts.append(kept[at[i]: at[i + 1]])
        return pa.table({id_col: block.ids, "n_bytes": pa.array(n_bytes, pa.int64()), "n_removed": pa.array(n_removed, pa.int64()),
                         "removed": pa.array(lists, run_arrow), "kept": pa.array(texts, pa.binary())})

    return blocks.groupBy("block").cogroup(both.groupBy("block")).applyInArrow(remove, schema)
