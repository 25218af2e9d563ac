"""Token ids in ORC files: integer run-length encoding, row indexes and Bloom filters on the documents' ids.

``write_token_files`` deals the texts by ranges of their ids, so that file k holds lower ids than
file k + 1 and each file ascends, encodes them, and writes a row a document: its ids as a list of
32-bit integers (ORC's run-length encoding packs a stripe's integers together), the number of the
file and how many ids the file holds before it. A second, small table has a row a file with the ids
before the file. A document's place in the whole sequence is the sum of both, so no pass over
the ids is global. Readers take files by stripes, as many tasks as the split size gives, and skip
stripes and row groups whose minimum and maximum, or Bloom filter, rule an id out.
"""

from __future__ import annotations

import math
import os
import re
import uuid
import zlib
from collections.abc import Iterable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from tempora.llm.bpe import gathered, gathered_ids
from tempora.llm.memory import give_back, small_batches

PART_BYTES = 32 << 20      # text of a file, about
GROUP_BYTES = 8 << 20      # text whose distinct pieces are encoded together
SLICE = 4_096              # pieces that the tokenizer gets at once
KNOWN_WORDS = 400_000      # with their ids some 70 MB
LETTERS = [*range(0x41, 0x5B), *range(0x61, 0x7B), *range(0xC0, 0x180)]  # to be asked for: Latin letters
MARKS = ".,;:!?)"
STRIPE_BYTES = 8 << 20
INDEX_ROWS = 1_000         # rows of a row group, the unit that is skipped

class PieceEncoder:
    """Ids of pieces between white space, each distinct one encoded once by the tokenizer.

    A piece of plain letters and a closing mark or more goes as two: the letters, lower-cased if the tokenizer does that,
    and the marks. Plain letters are those that its normaliser changes one by one and its pre-tokeniser keeps
    together, as found by asking it; words of them go to its model directly, everything else through all its steps.
    Words are remembered, KNOWN_WORDS at most.
    """

    def __init__(self, json: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_str(json)
        self.model = self.whole.model.tokenize
        letters = self._letters()
        self.lower = all(letters.get(chr(c)) == letters.get(chr(c + 32)) for c in range(65, 91))
        self.marks = "".join(m for m in MARKS if letters and self._cuts(m))
        self.table = str.maketrans(letters)
        self.plain = f"^[{re.escape(''.join(letters))}]+$" if letters else None
        self.known: dict[str, int] = {}
        self.forget()

    def _normal(self, text: str) -> str:
        return self.whole.normalizer.normalize_str(text) if self.whole.normalizer else text

    def _pieces(self, text: str) -> list[str]:
        return [p for p, _ in self.whole.pre_tokenizer.pre_tokenize_str(text)] if self.whole.pre_tokenizer else [text]

    def _letters(self) -> dict[str, str]:
        """Letters, and what the tokenizer's model is given for each; none unless any two of them stay together and don't act on each other."""
        found = {}
        for c in map(chr, LETTERS):
            if c.isalpha() and len(made := self._pieces(self._normal(c))) == 1:
                found[c] = made[0]
        text = "".join(a + b for a in found for b in found)
        return found if self._pieces(self._normal(text)) == ["".join(found[c] for c in text)] else {}

    def _cuts(self, mark: str) -> bool:
        return self._normal("a" + mark) == "a" + mark and self._pieces("a" + mark) == ["a", mark]

    def forget(self) -> None:
        self.known = {}
        self.known_ids = np.zeros(0, dtype=np.int32)
        self.known_sizes = np.zeros(0, dtype=np.int64)

    def learn(self, words: list[str]) -> np.ndarray:
        """Numbers of words among those known; new ones go to the model."""
        if len(self.known) + len(words) > KNOWN_WORDS:
            self.forget()
        known = self.known
        new = list(dict.fromkeys(w for w in words if w not in known))  # different pieces may give one word
        ids, sizes = _flat([t.id for t in self.model(w)] for w in new)
        known.update(zip(new, range(len(known), len(known) + len(new))))
        self.known_ids = np.concatenate((self.known_ids, ids))
        self.known_sizes = np.concatenate((self.known_sizes, sizes))
        return np.fromiter(map(known.__getitem__, words), dtype=np.int64, count=len(words))

    def ids(self, pieces: list[str]) -> Iterator[list[int]]:
        """Through all steps of the tokenizer."""
        for at in range(0, len(pieces), SLICE):  # its results are many times larger than the ids
            yield from [e.ids for e in self.whole.encode_batch_fast(pieces[at: at + SLICE], add_special_tokens=False)]

    def table_of(self, distinct: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all pieces in a row, number of ids of each)."""
        if self.plain is None or not len(distinct):
            return _flat(self.ids(_strings(distinct)))
        heads = pc.ascii_rtrim(distinct, self.marks) if self.marks else distinct
        plain = pc.match_substring_regex(heads, self.plain)
        heads = heads.filter(plain)
        tails = pc.replace_substring_regex(distinct.filter(plain), f"^.*[^{re.escape(self.marks)}]" if self.marks else "^.*", "").dictionary_encode()
        other = _strings(distinct.filter(pc.invert(plain)))
        heads = (pc.ascii_lower(heads) if self.lower else heads).dictionary_encode()
        marks = [x.as_py() for x in tails.dictionary]
        words = self.learn(_strings(heads.dictionary, self.table))
        # Units: all known words, the marks or none, the other pieces, nothing; a piece is two of them.
        more, more_sizes = _flat(chain(self.ids(marks), self.ids(other)))
        table = np.concatenate((self.known_ids, more))
        sizes = np.concatenate((self.known_sizes, more_sizes, [0]))
        n = len(self.known)
        at = plain.to_numpy(zero_copy_only=False)
        units = np.full((len(distinct), 2), len(sizes) - 1, dtype=np.int64)
        units[at, 0] = words[heads.indices.to_numpy()]
        units[at, 1] = n + tails.indices.to_numpy()
        units[~at, 0] = n + len(marks) + np.arange(len(other))
        return gathered_ids(table, sizes, units.ravel()), sizes[units].sum(1)


def _strings(pieces: pa.Array, table: dict | None = None) -> list[str]:
    """Python strings of pieces without white space, through one joined text; ``table`` replaces their characters."""
    if not len(pieces):
        return []
    text = pc.binary_join(pa.LargeListArray.from_arrays(pa.array([0, len(pieces)], pa.int64()), pieces), " ")[0].as_py()
    return (text.translate(table) if table else text).split(" ")


def _flat(lists: Iterable[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    sizes: list[int] = []

    def each() -> Iterator[int]:
        for x in lists:
            sizes.append(len(x))
            yield from x

    table = np.fromiter(each(), dtype=np.int32)
    return table, np.array(sizes, dtype=np.int64)


def encode_texts(encoder: PieceEncoder, texts: pa.Array, end_id: int | None) -> tuple[np.ndarray, np.ndarray]:
    """(ids of all texts in a row, bounds of each text's ids)."""
    lists = pc.ascii_split_whitespace(texts.fill_null(""))
    bounds = lists.offsets.to_numpy().astype(np.int64)
    coded = lists.flatten().dictionary_encode()
    del lists
    table, sizes = encoder.table_of(coded.dictionary)
    codes = coded.indices.to_numpy()
    flat = gathered_ids(table, sizes, codes)
    marks = np.concatenate(([0], np.cumsum(sizes[codes])))[bounds - bounds[0]]
    if end_id is None:
        return flat, marks
    docs = len(texts)
    out = np.empty(len(flat) + docs, dtype=np.int32)
    last = marks[1:] + np.arange(docs)
    is_end = np.zeros(len(out), dtype=bool)
    is_end[last] = True
    out[last] = end_id
    out[~is_end] = flat
    return out, np.concatenate(([0], last + 1))


_WORKER: dict[str, PieceEncoder] = {}


def _encoder(key: str, json: str) -> PieceEncoder:
    """This worker's; built once."""
    if key not in _WORKER:
        _WORKER.clear()
        _WORKER[key] = PieceEncoder(json)
    return _WORKER[key]


def write_token_files(spark: SparkSession, docs: DataFrame, path: str, tokenizer_path: str, end_id: int | None = None,
                      id_col: str = "doc_id", text_col: str = "text", part_bytes: int = PART_BYTES,
                      stripe_bytes: int = STRIPE_BYTES, index_rows: int = INDEX_ROWS) -> None:
    """Encode ``docs`` and write ``path``/ids (ORC: doc, part, before, ids) and ``path``/parts (Parquet).

    Rows ascend by id, null ids first; rows with one id by a hash of the text, then as they come.
    A hot id, or one row repeated, is dealt over several files. Text goes through the tokenizer in the pieces
    between white space, which must not be part of a token (see ``drops_white_space``); no special
    tokens are added, but their strings in a text count as the tokenizer file says; ``end_id`` is
    appended to every document. A null text is empty. An empty table writes no rows. Other columns may have any
    names and are left out. The tokenizer's file is read on the driver and broadcast (a fixed size).
    """
    small_batches(spark)
    with open(tokenizer_path, encoding="utf-8") as f:
        source = f.read()
    drops_white_space(source)
    tables = spark.sparkContext.broadcast(source)
    token = uuid.uuid4().hex
    d = docs.select(F.col(id_col).alias("doc"), F.col(text_col).cast("string").alias("text"))
    total, rows = d.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0)), F.count(F.lit(1))).first()
    files = max(1, math.ceil((total + 64 * rows) / part_bytes))
    order = ["doc", "hash", "place"]
    d = d.withColumns({"hash": F.xxhash64("text"), "place": F.monotonically_increasing_id()})
    d = d.repartitionByRange(files, *order).sortWithinPartitions(*order)
    d = d.select("doc", F.spark_partition_id().alias("part"), "text")
    schema = T.StructType([d.schema["doc"], T.StructField("part", T.IntegerType()), T.StructField("before", T.LongType()),
                           T.StructField("ids", T.ArrayType(T.IntegerType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(token, tables.value)
        before = 0  # ids of this file so far
        for group in gathered(batches, GROUP_BYTES):
            sizes = [b.num_rows for b in group]
            ids, bounds = encode_texts(encoder, pa.concat_arrays([b.column(2) for b in group]), end_id)
            at = 0
            for b, n in zip(group, sizes):
                marks = bounds[at: at + n + 1]
                lists = pa.ListArray.from_arrays(pa.array(marks - marks[0], pa.int32()), pa.array(ids[marks[0]: marks[-1]], pa.int32()))
                yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(before + marks[:-1], pa.int64()), lists],
                                                 names=schema.names)
                at += n
            before += len(ids)
        encoder.forget()  # the worker may go on to other work
        give_back()

    (d.mapInArrow(run, schema).write.option("orc.bloom.filter.columns", "doc").option("orc.bloom.filter.fpp", "0.01")
     .option("orc.create.index", "true").option("orc.row.index.stride", str(index_rows))
     .option("orc.stripe.size", str(stripe_bytes)).orc(f"{path}/ids"))
    _write_parts(spark, path)


def _write_parts(spark: SparkSession, path: str) -> None:
    """A row a file: number of documents and ids, and the ids in all files before it."""
    parts = spark.read.orc(f"{path}/ids").groupBy("part").agg(
        F.count(F.lit(1)).alias("documents"), F.sum(F.size("ids").cast("long")).alias("n_ids"))
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # a row for 32 MB of text
    parts.withColumn("start", F.coalesce(F.sum("n_ids").over(earlier), F.lit(0).cast("long"))).write.parquet(f"{path}/parts")


def drops_white_space(tokenizer_json: str) -> None:
    """Raise ValueError unless the tokenizer cuts at white space and drops it, so that pieces can be encoded alone."""
    from tokenizers import Tokenizer

    t = Tokenizer.from_str(tokenizer_json)

    def ids(text: str) -> list[int]:
        return t.encode(text, add_special_tokens=False).ids

    for a, b in (("ab", "cd"), ("a'", "s"), ("1", "2"), (".", ","), ("e", "́x"), ("Σ", "Σ")):
        for gap in (" ", "\n", "\t \r\x0b\x0c"):
            if ids(f"{gap}{a}{gap}{b}{gap}") != ids(a) + ids(b):
                raise ValueError("this tokenizer keeps white space or looks across it; its texts can't be encoded in pieces")


def read_token_files(spark: SparkSession, path: str, only: list | None = None) -> DataFrame:
    """(doc, start, ids) of the files under ``path``; ``only``: of these ids, whose row groups alone are read.

    ``start`` counts the ids of all documents before a document in the order of the files.
    """
    ids = spark.read.orc(f"{path}/ids")
    if only is not None:
        ids = ids.where(F.col("doc").isin(list(only)))
    starts = spark.read.parquet(f"{path}/parts").select("part", F.col("start").alias("part_start"))
    return ids.join(starts, "part").select("doc", (F.col("part_start") + F.col("before")).alias("start"), "ids")


def id_digests(tokens: DataFrame) -> DataFrame:
    """(doc, start, n_tokens, ids_crc32): the CRC-32 is of the ids as little-endian unsigned 32-bit integers."""
    small_batches(tokens.sparkSession)
    schema = T.StructType([tokens.schema["doc"], T.StructField("start", T.LongType()),
                           T.StructField("n_tokens", T.LongType()), T.StructField("ids_crc32", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            lists = b.column(2)
            bounds = lists.offsets.to_numpy().astype(np.int64)
            data = memoryview(lists.values.to_numpy(zero_copy_only=False).astype("<u4")).cast("B")
            crc = [zlib.crc32(data[4 * s: 4 * e]) for s, e in zip(bounds[:-1].tolist(), bounds[1:].tolist())]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(np.diff(bounds), pa.int64()), pa.array(crc, pa.int64())],
                                             names=schema.names)

    return tokens.select("doc", "start", "ids").mapInArrow(run, schema)
