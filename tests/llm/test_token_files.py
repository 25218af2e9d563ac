"""Token ids in ORC files: equal to the tokenizer on whole texts; order, places, pruning, stripes, edge cases."""

import struct
import zlib

import public_tokenizers as P
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tests.conftest import SMOKE_DIR

PATH = P.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(PATH)


def digests(tokenizer, texts, end_id=2):
    """(start, n_tokens, crc32) of each text in order."""
    start, out = 0, []
    for t in texts:
        ids = tokenizer.encode(t or "", add_special_tokens=False).ids + [end_id]
        out.append((start, len(ids), zlib.crc32(struct.pack(f"<{len(ids)}I", *ids))))
        start += len(ids)
    return out


def files_of(spark, path):
    jvm = spark.sparkContext._jvm
    folder = jvm.org.apache.hadoop.fs.Path(path)
    fs = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return [s.getPath() for s in fs.listStatus(folder) if s.getPath().getName().endswith(".orc")]


def orc_reader(spark, path):
    orc = spark.sparkContext._jvm.org.apache.orc.OrcFile
    return orc.createReader(path, orc.readerOptions(spark.sparkContext._jsc.hadoopConfiguration()))


def test_query_equals_the_library_on_whole_texts(spark, tokenizer):
    from tempora.llm.queries import QUERIES

    got = QUERIES["op12_token_files"](spark, SMOKE_DIR)
    assert got.columns == ["doc_id", "start", "n_tokens", "ids_crc32"]
    docs = spark.read.parquet(f"{SMOKE_DIR}/documents.parquet").select("doc_id", "text").orderBy("doc_id").collect()
    assert sorted((r.start, r.n_tokens, r.ids_crc32) for r in got.collect()) == digests(tokenizer, [r.text for r in docs])


def test_white_space_marks_special_strings_nulls_ties_and_long_texts(spark, tokenizer, scratch):
    from tempora.llm.token_files import id_digests, read_token_files, write_token_files

    texts = {0: "", 1: None, 2: " \t\r\n\x0b\x0c ", 3: "It's  ΟΔΟΣ ΣΣ\n é é ́x İstanbul", 4: "a<|endoftext|>b <|startoftext|>",
             5: "x y z　w\u0085v\x1cu", 6: "don't DON'T 'll 123 4,5", 7: "ab " * 200_000, 8: "😀👍🏽 中文 кот", 9: "q" * 5_000}
    rows = [(i, t, 9, "p", i) for i, t in texts.items()] + [(6, texts[6], 9, "p", 0)] * 2 + [(None, "none", 9, "p", 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, part int, ids string, before long").repartition(3)
    write_token_files(spark, docs, scratch + "/t", PATH, 2, part_bytes=40_000)
    got = sorted(map(tuple, id_digests(read_token_files(spark, scratch + "/t")).collect()), key=lambda r: r[1])
    ids = [None, 0, 1, 2, 3, 4, 5, 6, 6, 6, 7, 8, 9]
    want = digests(tokenizer, ["none"] + [texts[i] for i in ids[1:]])
    assert got == [(i, *w) for i, w in zip(ids, want)]
    assert len(files_of(spark, scratch + "/t/ids")) > 1


def test_without_end_id_and_of_an_empty_table(spark, tokenizer, scratch):
    from tempora.llm.token_files import id_digests, read_token_files, write_token_files

    docs = spark.createDataFrame([(1, "b c"), (0, None)], "doc_id long, text string")
    write_token_files(spark, docs, scratch + "/a", PATH)
    assert [(r.doc, r.start, list(r.ids)) for r in read_token_files(spark, scratch + "/a").orderBy("doc").collect()] == [
        (0, 0, []), (1, 0, tokenizer.encode("b c", add_special_tokens=False).ids)]
    write_token_files(spark, docs.limit(0), scratch + "/b", PATH, 2)
    assert id_digests(read_token_files(spark, scratch + "/b")).collect() == []


def test_stripes_are_read_apart_and_row_groups_skipped(spark, scratch):
    from tempora.llm.token_files import read_token_files, write_token_files

    docs = spark.range(40_000).select((F.col("id") * 2).alias("doc_id"), F.concat_ws(" ", F.lit("token"), F.xxhash64("id")).alias("text"))
    write_token_files(spark, docs, scratch + "/t", PATH, 2, stripe_bytes=256 << 10, index_rows=1_000)
    (path,) = files_of(spark, scratch + "/t/ids")
    reader = orc_reader(spark, path)
    assert reader.getNumberOfRows() == 40_000 and reader.getStripes().size() > 1 and reader.getRowIndexStride() == 1_000
    kinds = {s.getKind().toString() for s in reader.rows().readStripeFooter(reader.getStripes().get(0)).getStreamsList()}
    assert {"ROW_INDEX", "BLOOM_FILTER_UTF8"} <= kinds
    encodings = reader.rows().readStripeFooter(reader.getStripes().get(0)).getColumnsList()
    assert {e.getKind().toString() for e in encodings} >= {"DIRECT_V2"}  # integer run-length encoding
    # Stripes go to tasks of their own, and none is lost or read twice.
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(reader.getContentLength() // 4))
    try:
        tokens = spark.read.orc(scratch + "/t/ids")
        assert tokens.rdd.getNumPartitions() > 1
        assert tokens.agg(F.count("*"), F.count_distinct("doc")).first() == (40_000, 40_000)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    for only, rows in (([2 * 20_001], 1), ([2 * 20_001 + 1], 0)):  # within the file's range, one there, one not
        found = read_token_files(spark, scratch + "/t", only)
        assert "PushedFilters: [In(doc" in found._jdf.queryExecution().toString() or "PushedFilters: [IsNotNull(doc), EqualTo(doc" in found._jdf.queryExecution().toString()
        scan = spark.read.orc(scratch + "/t/ids").where(F.col("doc") == only[0])
        assert scan.count() == rows == found.count()
        assert rows_read(scan) <= 1_000 * rows  # the Bloom filter leaves one row group, or none


def rows_read(scan):
    """Rows that came out of the file reader when ``scan`` ran."""
    execution = scan._jdf.queryExecution()
    execution.executedPlan().executeCollect()
    leaf = execution.executedPlan().collectLeaves().apply(0)
    return leaf.metrics().apply("numOutputRows").value()


def test_a_tokenizer_that_keeps_white_space_is_refused(spark, scratch):
    from tempora.llm.token_files import write_token_files

    with pytest.raises(ValueError, match="white space"):
        write_token_files(spark, spark.createDataFrame([(1, "a b")], "doc_id long, text string"), scratch + "/t", P.path("byte_bpe_50k.json"))


def test_pieces_equal_whole_texts_for_any_characters(tokenizer):
    """Letters, marks, capitals, combining marks and special strings in any mixture."""
    import random

    import pyarrow as pa

    from tempora.llm.token_files import PieceEncoder, encode_texts

    with open(PATH, encoding="utf-8") as f:
        encoder = PieceEncoder(f.read())
    assert encoder.lower and len(encoder.marks) == 7 and "é" in encoder.plain and "Ş" in encoder.plain and "İ" not in encoder.plain
    rng = random.Random(1)
    parts = ["a", "B", "the", "é", "É", "ß", "İ", "ı", "ŉ", "ǆ", "Σ", "σ", "\u0301", "\u0338", "'s", "'", "'LL", ".", ",", "!?", ")", "(", "<|endoftext|>",
             "<|", "|>", "1", "23", "٣", "中", "ﬁ", "\u200b", "\u00ad", "😀", "_", "-", "K", "Å", " ", " ", "\n", "\u00a0", "\u0085", "\x1c"]
    texts = ["".join(rng.choices(parts, k=rng.randint(0, 25))) for _ in range(4000)] + [None]
    ids, bounds = encode_texts(encoder, pa.array(texts, pa.string()), 2)
    for t, s, e in zip(texts, bounds[:-1], bounds[1:]):
        assert ids[s:e].tolist() == tokenizer.encode(t or "", add_special_tokens=False).ids + [2], t
