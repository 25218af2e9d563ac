"""A training-data pipeline over ``documents``: language, near copies, repeated passages, benchmark leaks, tokens.

STAGES lists (name, function); each function takes (spark, docs, sf_dir) and
returns a DataFrame that is written as Parquet and read again as the next
one's docs. All but the last return the columns of documents. Rows that repeat an
id and its text count once, from the second stage on. Decisions are made and applied
by row (id and text), so ids may be null or reused. Further columns of documents may have any names.
"""

from __future__ import annotations

import uuid
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tempora.session import shared_path

#: Bytes of the repeated strings that are cut. A passage of 50 words or more has at least 99 bytes, in prose
#: about 250 to 400; repeats of ordinary phrases stay below 200.
PASSAGE_BYTES = 200


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a language: those that the identifier rejects (no text, or no letter in it) go."""
    from tempora.llm.lang_id import UNKNOWN, held_out, identify_language, language_samples

    samples = language_samples(docs, ~held_out())
    # Under names of their own, the columns can't clash with the operator's.
    own = {c: f"__{k}_{c}" for k, c in enumerate(docs.columns)}
    out = identify_language(spark, docs.withColumnsRenamed(own), samples, text_col=own["text"], keep=tuple(own.values()))
    return out.where(F.col("lang_pred") != UNKNOWN).select(*[F.col(f"`{new}`").alias(c) for c, new in own.items()])


def _own_names(stage):
    """Columns whose names begin with two underscores, as the stages' own do, pass under other names and come back."""
    @wraps(stage)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        aside = {c: f"{uuid.uuid4().hex}{c}" for c in docs.columns if c.startswith("__")}
        return stage(spark, docs.withColumnsRenamed(aside), sf_dir).withColumnsRenamed({new: c for c, new in aside.items()})

    return run


def _keyed(docs: DataFrame) -> DataFrame:
    """With ``__row``, never null: the id and two 64-bit hashes of the text, in the order of ids, null ids last."""
    return docs.withColumn("__row", F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("id"), F.xxhash64("text").alias("h1"),
                                             F.xxhash64(F.lit(1), F.col("text")).alias("h2")))


def _repeats_once(docs: DataFrame) -> DataFrame:
    """One of the rows that have the same id, or none, and the same text; only texts of repeated rows move."""
    keyed = _keyed(docs)
    repeated = keyed.groupBy("__row").agg(F.count(F.lit(1)).alias("__rows")).where("__rows > 1").select("__row")
    if repeated.isEmpty():
        return docs
    again = keyed.join(repeated, "__row", "left_semi").dropDuplicates(["__row"])
    return keyed.join(repeated, "__row", "left_anti").unionByName(again).select(*docs.columns)


@_own_names
def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, the one with the least id (a null one only if there is no other), of each group that the Jaccard join links."""
    from tempora.llm.jaccard_join import jaccard_components

    docs = _repeats_once(docs)
    keyed = _keyed(docs)
    copies = jaccard_components(keyed, id_col="__row").where("component_id <> __row").select("__row").distinct()
    return keyed.join(copies, "__row", "left_anti").select(*docs.columns)


@_own_names
def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the strings of PASSAGE_BYTES that occur twice or more; a text of which nothing is left goes."""
    from tempora.llm.suffix_array import suffix_dedup

    kept = F.col("kept").cast("string")
    # A cut may fall inside a character: its stray bytes go with it.
    plain = F.when(F.is_valid_utf8(kept), kept).otherwise(F.regexp_replace(F.make_valid_utf8(kept), "\uFFFD", ""))
    keyed = _keyed(docs)
    # Rows with the same key have the same text, and are cut alike.
    cut = suffix_dedup(keyed, id_col="__row", length=PASSAGE_BYTES).where("n_removed > 0").select(
        "__row", plain.alias("__text"), F.lit(True).alias("__cut")).dropDuplicates(["__row"])
    out = keyed.join(cut, "__row", "left")
    text = F.when(F.col("__cut"), F.col("__text")).otherwise(F.col("text"))
    out = out.withColumns({"text": text, "n_chars": F.when(F.col("__cut"), F.char_length("__text").cast("long")).otherwise(F.col("n_chars"))})
    return out.where("__cut IS NULL OR trim(text) <> ''").select(*docs.columns)


@_own_names
def benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    from tempora.llm.decontam import benchmark_leaks as leaks

    keyed = _keyed(docs)
    found = leaks(keyed, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), id_col="__row").select("__row").distinct()
    return keyed.join(found, "__row", "left_anti").select(*docs.columns)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document's ids as byte-level BPE, with their number and the digests of the round trip."""
    from tempora.llm.queries import bpe_digests

    return bpe_digests(spark, docs, keep=("lang", "source"))


STAGES = [
    ("language_id", language),
    ("jaccard_join", near_copies),
    ("suffix_array_dedup", repeated_passages),
    ("benchmark_decontamination", benchmark_leaks),
    ("bpe", tokens),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what lies between them is written to the shared folder."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            path = shared_path(spark, "pipeline", name, unique=True)
            docs.write.parquet(path)
            docs = spark.read.parquet(path)
    return docs
