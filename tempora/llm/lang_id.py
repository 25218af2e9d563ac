"""Language identification by cross-parsing against suffix automata.

For each language a suffix automaton is built over a bounded sample of its
labelled text. A text is parsed from left to right into the longest phrases
that occur in the sample; the language that needs the fewest phrases (times
the logarithm of the sample's length, as in the cross-parsing estimate of
cross-entropy) wins. The automata become one transition table, and a task
parses thousands of text segments side by side, a character a step. A long text's segments are
parsed at the same time from a guessed state; each is then begun again from the state in which the one before
has ended, until both parses agree, so that phrases are those of the whole text.
"""

from __future__ import annotations

import math
import sys
import uuid
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tempora.llm.memory import give_back, small_batches

SAMPLE_CHARS = 16_384  # characters of each language's sample
SAMPLE_DOCS = 64       # documents that it is drawn from
SAMPLE_DOC_CHARS = 8_192
MAX_LANGUAGES = 1_000  # different labels; more are refused
SEGMENT = 4_096        # classes that are parsed one after the other
SYNC = 256             # classes in which a segment's two parses have to meet, or the text is parsed in one go
DENSE = 252            # letter classes with a column of their own in the parser's table
UNKNOWN = "und"


def language_samples(docs: DataFrame, train: Column, id_col: str = "doc_id", text_col: str = "text",
                     lang_col: str = "lang", n_docs: int = SAMPLE_DOCS, n_chars: int = SAMPLE_CHARS) -> dict[str, str]:
    """{language: sample text} of at most ``n_chars`` characters from at most ``n_docs`` documents.

    The documents are, per language, the distinct texts with the least hash in each of ``n_docs``
    slots. Each gives its first letters in an equal share (see ``equal_shares``), at most
    SAMPLE_DOC_CHARS characters; a run of other characters counts as one. Rows with a null id,
    text or language teach nothing. More than MAX_LANGUAGES languages raise ValueError.
    """
    d = docs.where(train & F.col(id_col).isNotNull() & F.col(text_col).isNotNull() & F.col(lang_col).isNotNull())
    d = d.select(F.col(lang_col).alias("lang"), F.xxhash64(F.col(text_col)).alias("h"), F.col(text_col).alias("text"))
    slot = F.pmod(F.col("h"), F.lit(n_docs))
    most = MAX_LANGUAGES * n_docs
    picked = {(r.lang, r.h) for r in d.groupBy("lang", slot.alias("slot")).agg(F.min("h").alias("h")).limit(most + 1).collect()}
    if len(picked) > most or len({lang for lang, _ in picked}) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages in {lang_col!r}")
    if not picked:
        return {}
    rows = d.where(F.col("h").isin(sorted({h for _, h in picked}))).select("lang", "h", F.substring("text", 1, SAMPLE_DOC_CHARS).alias("text"))
    out: dict[str, list[str]] = {}
    for r in sorted(rows.distinct().collect()):
        if (r.lang, r.h) in picked:
            out.setdefault(r.lang, []).append(" ".join("".join(c if c.isalpha() else " " for c in r.text).split()))
    # A line feed stands before each text in the parser's sample.
    return {k: "\n".join(t[: max(0, n - 1)] for t, n in zip(v, equal_shares([len(t) + 1 for t in v], n_chars))) for k, v in sorted(out.items())}


def equal_shares(sizes: list[int], total: int) -> list[int]:
    """What each gets of ``total``: the same for all, what some can't use dealt to the rest."""
    out = [0] * len(sizes)
    order = sorted(range(len(sizes)), key=lambda k: (sizes[k], k))
    for n, k in enumerate(order):
        out[k] = min(sizes[k], total // (len(order) - n))
        total -= out[k]
    return out


def character_classes(samples: list[str]) -> tuple[np.ndarray, int]:
    """Class of each code point: 0 no letter, 1 a letter that no sample has, else one for each letter, case folded, frequent ones first."""
    count = Counter(c for s in samples for c in s.lower() if c.isalpha())
    known = sorted(count, key=lambda c: (-count[c], c))
    table = np.zeros(sys.maxunicode + 1, dtype=np.min_scalar_type(len(known) + 1))
    letters = np.fromiter((chr(c).isalpha() for c in range(sys.maxunicode + 1)), dtype=bool)
    table[letters] = 1
    for k, c in enumerate(known, 2):
        for x in {c, c.upper()}:
            if len(x) == 1:
                table[ord(x)] = k
    return table, len(known) + 2


def to_classes(texts: list[str], table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All texts' classes, each run of non-letters as a single 0, and each text's bounds; a text begins after a 0."""
    lengths = np.fromiter((len(t) + 1 for t in texts), dtype=np.int64, count=len(texts))
    points = np.frombuffer(("\n" + "\n".join(texts)).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    classes = table[points]
    kept = classes != 0
    kept[1:] |= classes[:-1] != 0
    kept[0] = True
    starts = np.concatenate(([0], np.cumsum(lengths)))  # the line feed before each text
    kept[starts[:-1]] = True
    before = np.concatenate(([0], np.cumsum(kept)))
    return classes[kept], before[starts]


def suffix_automaton(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """(state, class, next state) of each transition of the suffix automaton of ``codes``, and the number of states; 0 is the root."""
    rows: list[dict[int, int]] = [{}]
    link, length = [-1], [0]
    last = 0
    for c in codes.tolist():
        cur = len(rows)
        rows.append({})
        length.append(length[last] + 1)
        link.append(0)
        p = last
        while p != -1 and c not in rows[p]:
            rows[p][c] = cur
            p = link[p]
        if p != -1:
            q = rows[p][c]
            if length[p] + 1 == length[q]:
                link[cur] = q
            else:
                clone = len(rows)
                rows.append(dict(rows[q]))
                length.append(length[p] + 1)
                link.append(link[q])
                while p != -1 and rows[p].get(c) == q:
                    rows[p][c] = clone
                    p = link[p]
                link[q] = link[cur] = clone
        last = cur
    sizes = [len(row) for row in rows]
    classes = np.fromiter((c for row in rows for c in row), dtype=np.int64, count=sum(sizes))
    targets = np.fromiter((t for row in rows for t in row.values()), dtype=np.int64, count=sum(sizes))
    return np.repeat(np.arange(len(rows)), sizes), classes, targets, len(rows)


class CrossParser:
    """Phrases that each language's sample needs for a text.

    The transitions by the most frequent classes, up to DENSE, are a table; those by rarer classes,
    of which an alphabet of thousands of letters has many, are a sorted list of (state, class).
    """

    def __init__(self, samples: dict[str, str], n_chars: int = SAMPLE_CHARS):
        self.names = sorted(samples)
        self.table, n = character_classes([samples[k] for k in self.names])
        self.width = width = min(n, DENSE)
        tables, self.base, self.weight = [], [], []
        rare_keys, rare_steps, self.rare_misses = [], [], []
        at = 0
        for k in self.names:
            codes, _ = to_classes([samples[k]], self.table)
            codes = codes[:n_chars]
            source, by, target, n_states = suffix_automaton(codes)
            rare = by >= width
            go = np.full((n_states, width), -1, dtype=np.int64)
            go[source[~rare], by[~rare]] = target[~rare]
            # Where a phrase can't go on it ends, and the class begins the next one from the root,
            # or is a phrase by itself if the sample doesn't have it. The low bits count ended phrases.
            root = go[0]
            ended = (go < 0) + ((go < 0) & (root < 0)).astype(np.int64)
            ended[0] = (root < 0)
            state = np.where(go >= 0, go, np.maximum(root, 0))
            tables.append((((state * width) + at) << 2 | ended).ravel())
            rare_keys.append((source[rare] * width + at) * (n - width) + by[rare] - width)
            rare_steps.append((target[rare] * width + at) << 2)
            first = np.full(n - width, -1, dtype=np.int64)
            first[by[rare & (source == 0)] - width] = target[rare & (source == 0)]
            self.rare_misses.append((np.maximum(first, 0) * width + at) << 2 | (1 + (first < 0)))
            self.base.append(at)
            self.weight.append(math.log2(max(2, len(codes))))
            at += go.size
        cell = np.int32 if at < 1 << 29 else np.int64  # two bits of a cell count phrases
        self.go = np.concatenate(tables).astype(cell) if tables else np.zeros(0, cell)
        self.n_rare = n - width
        keys, steps = np.concatenate([*rare_keys, [-1]]).astype(np.int64), np.concatenate([*rare_steps, [0]]).astype(cell)
        order = np.argsort(keys)
        self.rare_keys, self.rare_steps = keys[order], steps[order]
        self.rare_misses = np.array(self.rare_misses, dtype=cell)
        self.base = np.array(self.base, dtype=cell)
        self.weight = np.array(self.weight)

    def rare_step(self, state: np.ndarray, codes: np.ndarray) -> np.ndarray:
        """As ``go``, for the rarer classes: steps of [language, text]."""
        key = state.astype(np.int64) * self.n_rare + (codes - self.width)
        at = np.searchsorted(self.rare_keys, key, side="right") - 1
        # At the root no phrase has begun that could end.
        miss = self.rare_misses[:, codes - self.width] - (state == self.base[:, None])
        return np.where(self.rare_keys[at] == key, self.rare_steps[at], miss)

    def phrases(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(phrases [language, text], classes of each text, letters of each text)."""
        codes, bounds = to_classes(texts, self.table)
        n_codes = np.diff(bounds)
        letters = np.add.reduceat(np.concatenate((codes != 0, [False])).astype(np.int64), bounds[:-1]) if len(texts) else n_codes
        # Segments of at most SEGMENT classes, parsed side by side, all as if a phrase began with each.
        pieces = np.maximum(1, -(-n_codes // SEGMENT))
        text = np.repeat(np.arange(len(texts)), pieces)
        first = np.cumsum(pieces) - pieces
        part = np.arange(len(text)) - np.repeat(first, pieces)
        start = bounds[:-1][text] + part * SEGMENT
        size = np.minimum(bounds[1:][text] - start, SEGMENT)
        found, state, _ = self._walk(codes, start, size, None, 0)
        later = np.flatnonzero(part > 0)
        apart = np.zeros(len(texts), dtype=bool)
        few = max(1, min(512, (1 << 21) // (SYNC * max(1, len(self.names)))))
        for at in range(0, len(later), few):  # again from the state in which the segment before has ended
            rows = later[at: at + few]
            short = np.minimum(size[rows], SYNC)
            _, _, guess = self._walk(codes, start[rows], short, None, SYNC)
            _, _, true = self._walk(codes, start[rows], short, state[:, rows - 1], SYNC)
            meet = (guess[0] == true[0]) & (np.arange(len(guess[0]))[:, None, None] < short)
            when = meet.argmax(0)[None]
            found[:, rows] += (np.take_along_axis(true[1], when, 0) - np.take_along_axis(guess[1], when, 0))[0]
            apart[text[rows[~meet.any(0).all(0)]]] = True
        total = np.add.reduceat(found, first, axis=1).astype(np.int64) if len(texts) else found.astype(np.int64)
        last = first + pieces - 1
        total += state[:, last] != self.base[:, None]
        odd = np.flatnonzero(apart)
        if len(odd):  # the parses haven't met: in one go
            found, state, _ = self._walk(codes, bounds[:-1][odd], n_codes[odd], None, 0)
            total[:, odd] = found + (state != self.base[:, None])
        return total, n_codes, letters

    def _walk(self, codes: np.ndarray, start: np.ndarray, size: np.ndarray, state: np.ndarray | None, record: int):
        """(phrases ended [language, row], last state, (states, phrases) after each of the first ``record`` classes) of stretches of
        ``codes``, from the roots or from ``state``."""
        n_lang = len(self.names)
        phrases, ends = np.zeros((n_lang, len(start)), dtype=np.int64), np.zeros((n_lang, len(start)), dtype=self.base.dtype)
        kept = [np.zeros((record, n_lang, len(start)), dtype=self.base.dtype) for _ in range(2)]
        order = np.argsort(-size, kind="stable")
        for at in range(0, len(order), 2048):
            rows = order[at: at + 2048]
            s, n = start[rows], size[rows]
            now = np.repeat(self.base[:, None], len(rows), axis=1) if state is None else state[:, rows].copy()
            found = np.zeros(now.shape, dtype=np.int32)
            for block in range(0, int(n[0]), SEGMENT):
                width = int(min(SEGMENT, n[0] - block))
                k_rows = int(np.searchsorted(-n, -block, side="left"))
                grid = np.zeros((width, k_rows), dtype=np.int32)
                for i in range(k_rows):
                    k = min(int(n[i]) - block, width)
                    grid[:k, i] = codes[s[i] + block: s[i] + block + k]
                active = np.searchsorted(-n, -(block + np.arange(width)), side="left")  # rows with more classes than t
                for t in range(width):
                    k = active[t]
                    if self.n_rare:
                        c = grid[t, :k]
                        step = self.go.take(now[:, :k] + np.where(c < self.width, c, 0))
                        rare = np.flatnonzero(c >= self.width)
                        step[:, rare] = self.rare_step(now[:, rare], c[rare])
                    else:
                        step = self.go.take(now[:, :k] + grid[t, :k])
                    found[:, :k] += step & 3
                    now[:, :k] = step >> 2
                    if block + t < record:
                        kept[0][block + t][:, rows], kept[1][block + t][:, rows] = now, found
            phrases[:, rows], ends[:, rows] = found, now
        return phrases, ends, kept

    def predict(self, texts: list[str]) -> tuple[list[str], np.ndarray, np.ndarray]:
        """(language, score from 0 to 1, entropy in bits a character) of each text."""
        if not texts or not self.names:
            return [UNKNOWN] * len(texts), np.zeros(len(texts)), np.full(len(texts), np.nan)
        total, n, letters = self.phrases(texts)
        cost = total * self.weight[:, None] / np.maximum(n, 1)
        best = cost.argmin(axis=0)  # a tie goes to the first name
        least = cost.min(axis=0)
        rest = np.partition(cost, 1, axis=0)[1] if len(self.names) > 1 else np.full(len(texts), np.inf)
        score = np.clip(1 - least / np.maximum(rest, 1e-12), 0, 1)
        some = letters > 0
        return ([self.names[b] if ok else UNKNOWN for b, ok in zip(best.tolist(), some.tolist())],
                np.where(some, score, 0.0), np.where(some, least, np.nan))


_WORKER: dict = {}


def identify_language(spark: SparkSession, docs: DataFrame, samples: dict[str, str], text_col: str = "text",
                      keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """(*keep, lang_pred, score, entropy) for every row.

    A null text or one without a letter is ``und`` with score 0, as is every text if there are no
    samples. Texts are parsed whole, whatever their length; ties go to the first name in order.
    The samples are bounded by their parameters and broadcast.
    """
    small_batches(spark)
    sent = spark.sparkContext.broadcast(samples)
    token = uuid.uuid4().hex
    d = docs.select(*[F.col(c) for c in keep], F.col(text_col).cast("string").alias("__text"))
    fields = [f for f in d.schema.fields if f.name != "__text"]
    schema = T.StructType([*fields, T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType()),
                           T.StructField("entropy", T.DoubleType())])

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        key = ("lang", token)
        if key not in _WORKER:
            _WORKER.clear()
            _WORKER[key] = CrossParser(sent.value)
        parser = _WORKER[key]
        for b in batches:
            last = b.num_columns - 1
            rows = max(1, int(b.num_rows * (4 << 20) / max(1, b.column(last).nbytes)))
            for at in range(0, b.num_rows, rows):
                x = b.slice(at, rows)
                name, score, entropy = parser.predict([t or "" for t in x.column(last).to_pylist()])
                yield pa.RecordBatch.from_arrays(
                    [*[x.column(i) for i in range(last)], pa.array(name, pa.string()), pa.array(score, pa.float64()),
                     pa.Array.from_pandas(pd.Series(entropy), type=pa.float64())],
                    names=[*[f.name for f in fields], "lang_pred", "score", "entropy"])
        give_back()

    return d.mapInArrow(run, schema)


def held_out(id_col: str = "doc_id") -> Column:
    """Whether crc32 of the id as text leaves 1 modulo 3 (false for a null id)."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 3 == 1, F.lit(False))
