"""Periodic runs of words: Lyndon arrays by suffix grouping, their roots extended into maximal runs.

A run is a stretch whose smallest period q fits into it several times and that no neighbour extends.
Every run has, under the order of the words or its inverse, the longest Lyndon word at one of its
positions as a root of length q. Both Lyndon arrays come from the first phase of a suffix sorter that groups suffixes
by their longest Lyndon prefix, highest group first: the length that a group stands for is the Lyndon array, so
that neither the sorting itself nor a second phase is needed. Each root is extended to both sides by
the longest common extension of its two ends (hashes of prefixes, searched by halving; every run
is then verified word by word).

A run of length >= max(min_length, repeats * q) is covered by windows of ``shared_window`` words
that occur twice within the text, and so lies in one stretch of such windows: words in no such
window aren't looked at again.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tempora.llm.blocks import WORD_BASE, SpanHash, mix
from tempora.llm.bpe import gathered
from tempora.llm.memory import give_back, small_batches

GROUP_BYTES = 2 << 20  # texts whose repeated windows are looked for together
U = np.uint64


def lyndon_array(ranks: list[int]) -> list[int]:
    """Length of the longest Lyndon word that starts at each position; ``ranks`` are 0, 1, ... without gaps.

    Suffixes stand in groups that are ordered like their Lyndon prefixes as found so far, at first
    single symbols. Groups are taken from the highest down. A suffix's predecessor is the nearest one before it
    that is in a lower group. If a suffix is the predecessor of k suffixes of the group, k copies of the group's
    prefix follow its own: it moves, with those of its group that have the same k, into a new
    group right above its old one, higher for greater k. Linear but for sorting within groups.
    """
    n = len(ranks)
    sizes = [0] * (max(ranks) + 1)
    for r in ranks:
        sizes[r] += 1
    first, total = [], 0  # a group is named by its first place in the order
    for s in sizes:
        first.append(total)
        total += s
    group = [first[r] for r in ranks]
    member = [0] * n   # the suffix at each place
    place = [0] * n
    fill = list(first)
    for i, r in enumerate(ranks):
        p = fill[r]
        fill[r] = p + 1
        member[p] = i
        place[i] = p
    size = [0] * n     # by group
    length = [1] * n   # by group: of its prefix
    for f, s in zip(first, sizes):
        if s:
            size[f] = s
    before = list(range(-1, n - 1))  # neighbours among the suffixes that aren't taken yet
    after = list(range(1, n + 1))
    out = [0] * n
    end = n
    while end:
        g = group[member[end - 1]]
        own = length[g]
        times: dict[int, int] = {}
        # Taken from left to right: a suffix's neighbour before it is then its predecessor.
        for i in sorted(member[g:end]) if end - g > 1 else (member[g],):
            out[i] = own
            p, q = before[i], after[i]
            if q < n:
                before[q] = p
            if p >= 0:
                after[p] = q
                times[p] = times.get(p, 0) + 1
        end = g
        moved: dict[tuple[int, int], list[int]] = {}
        for p, k in times.items():
            moved.setdefault((k, group[p]), []).append(p)
        for k, old in sorted(moved, reverse=True) if len(moved) > 1 else moved:
            suffixes = moved[k, old]
            last = old + size[old] - 1
            for i in suffixes:  # to the last places of the old group
                j, p = member[last], place[i]
                member[p], place[j] = j, p
                member[last], place[i] = i, last
                last -= 1
            new = last + 1
            longer = length[old] + k * own
            size[old] -= len(suffixes)
            size[new] = len(suffixes)
            length[new] = longer
            if new != old:
                for i in suffixes:
                    group[i] = new
    return out


def shared_window(min_length: int, repeats: int) -> int:
    """The least length - q of a run: so many words in a row stand at two places that are q apart."""
    return max(1, min(max(min_length, repeats * q) - q for q in range(1, min_length + 1)))


def _common(sums: SpanHash, i: np.ndarray, j: np.ndarray, most: np.ndarray, backward: bool) -> np.ndarray:
    """How many words before (or from) the places ``i`` and ``j`` agree, at most ``most``: by halving."""
    low, high = np.zeros(len(i), dtype=np.int64), most.astype(np.int64)
    while (low < high).any():
        mid = (low + high + 1) >> 1
        same = (sums.spans(i - mid, i) == sums.spans(j - mid, j)) if backward else (sums.spans(i, i + mid) == sums.spans(j, j + mid))
        low, high = np.where(same, mid, low), np.where(same, high, mid - 1)
    return low


def _exact(codes: np.ndarray, root: int, start: int, end: int, q: int) -> tuple[int, int]:
    """The stretch around ``root`` that keeps period ``q``, given what the hashes say."""
    same = codes[start: end - q] == codes[start + q: end]
    if same.all() and (start == 0 or codes[start - 1] != codes[start - 1 + q]) and (end == len(codes) or codes[end] != codes[end - q]):
        return start, end
    differ = np.flatnonzero(codes[:-q] != codes[q:])  # two different stretches had one hash
    at = np.searchsorted(differ, root)
    return (int(differ[at - 1]) + 1 if at else 0), (int(differ[at]) if at < len(differ) else len(codes) - q) + q


def runs_of(codes: np.ndarray, min_length: int, repeats: int) -> list[tuple[int, int, int]]:
    """(start, length, period) of every run of length >= max(min_length, repeats * period), by start, then period."""
    n = len(codes)
    if n < max(min_length, repeats):
        return []
    _, ranks = np.unique(codes, return_inverse=True)
    sums = SpanHash(mix(ranks.astype(U) + U(1)), WORD_BASE)
    found: dict[tuple[int, int], int] = {}
    at = np.arange(n)
    for order in (ranks, ranks.max() - ranks):
        q = np.array(lyndon_array(order.tolist()))
        i = at[(at + q < n) & (repeats * q <= n)]
        if repeats >= 3:  # the first root of a run is followed by itself
            i = i[i + 2 * q[i] <= n]
            i = i[sums.spans(i, i + q[i]) == sums.spans(i + q[i], i + 2 * q[i])]
        if not len(i):
            continue
        p = q[i]
        j = i + p
        start = i - _common(sums, i, j, i, True)
        end = j + _common(sums, i, j, n - j, False)
        some = np.flatnonzero(end - start >= np.maximum(min_length, repeats * p))
        for k in some.tolist():
            s, period = int(start[k]), int(p[k])
            if (s, period) not in found:
                s, e = _exact(codes, int(i[k]), s, int(end[k]), period)
                if e - s >= max(min_length, repeats * period):
                    found[s, period] = e - s
    return sorted((s, length, period) for (s, period), length in found.items())


def stretches(codes: np.ndarray, bounds: np.ndarray, window: int, least: int) -> Iterator[tuple[int, int, int]]:
    """(text, start, end) of the stretches, ``least`` words or more, of windows that occur twice in their text."""
    n = len(codes) - window + 1
    if n <= 0:
        return
    text = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    at = np.flatnonzero(text[:n] == text[window - 1:])
    if not len(at):
        return
    sums = SpanHash(mix(codes.astype(U) + U(1)), WORD_BASE)
    keys = mix(sums.spans(at, at + window) + text[at].astype(U) * U(0x9E3779B97F4A7C15))
    order = np.sort(keys)
    twice = np.unique(order[1:][order[1:] == order[:-1]])
    if not len(twice):
        return
    near = np.searchsorted(twice, keys)
    near[near == len(twice)] = 0
    at = at[twice[near] == keys]
    cuts = np.flatnonzero((at[1:] > at[:-1] + window) | (text[at[1:]] != text[at[:-1]])) + 1
    for part in np.split(at, cuts):
        start, end = int(part[0]), int(part[-1]) + window
        if end - start >= least:
            yield int(text[start]), start, end


def periodic_runs(docs: DataFrame, min_length: int = 24, repeats: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_words, runs, kept_text): the runs of each text, and the text without their repetitions.

    Words are ``[^\\x20\\x09-\\x0D]+``, numbered from 0. ``runs`` lists (start, length, period), by start, then period, of every
    maximal stretch with smallest period q and length >= max(min_length, repeats * q); ``repeats`` is 2 or more. A word
    is dropped if a run contains it after that run's first q words; ``kept_text`` has the rest, joined by
    one space. A null or empty text has no words, no runs and an empty kept text. Rows are kept one for one, null ids and
    repeated rows too; other columns may have any names and are left out. A text is handled in one
    task with some 100 bytes of memory for each of its words.
    """
    if repeats < 2 or min_length < 1:
        raise ValueError("repeats must be 2 or more, min_length 1 or more")
    spark = docs.sparkSession
    small_batches(spark)
    window = shared_window(max(min_length, repeats), repeats)
    least = max(min_length, repeats)
    d = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    run_type = T.StructType([T.StructField(c, T.LongType()) for c in ("start", "length", "period")])
    schema = T.StructType([T.StructField(id_col, d.schema["id"].dataType), T.StructField("n_words", T.LongType()),
                           T.StructField("runs", T.ArrayType(run_type)), T.StructField("kept_text", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import pyarrow.compute as pc

        for group in gathered(batches, GROUP_BYTES):
            ids = pa.concat_arrays([b.column(0) for b in group])
            lists = pc.ascii_split_whitespace(pa.concat_arrays([b.column(1) for b in group]).fill_null(""))
            words, bounds = lists.flatten(), lists.offsets.to_numpy().astype(np.int64)
            # A text that begins or ends with white space, or an empty one, gives empty words.
            full = pc.not_equal(words, "").to_numpy(zero_copy_only=False)
            bounds = np.concatenate(([0], np.cumsum(full)))[bounds - bounds[0]]
            words = words.filter(pa.array(full))
            codes = words.dictionary_encode().indices.to_numpy()
            keep = np.ones(len(codes), dtype=bool)
            runs: list[list[dict]] = [[] for _ in range(len(ids))]
            for text, start, end in stretches(codes, bounds, window, least):
                shift = start - int(bounds[text])
                for s, length, period in runs_of(codes[start:end], min_length, repeats):
                    runs[text].append({"start": s + shift, "length": length, "period": period})
                    keep[start + s + period: start + s + length] = False
            kept = np.concatenate(([0], np.cumsum(keep)))[bounds]
            text = pc.binary_join(pa.ListArray.from_arrays(pa.array(kept, pa.int32()), words.filter(pa.array(keep))), " ")
            yield pa.RecordBatch.from_arrays(
                [ids, pa.array(np.diff(bounds), pa.int64()), pa.array(runs, pa.list_(pa.struct([(c, pa.int64()) for c in run_type.names]))), text],
                names=schema.names)
        give_back()

    return d.mapInArrow(run, schema)
