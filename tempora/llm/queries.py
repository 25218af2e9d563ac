"""The registered queries of this subpackage: each applies its operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def wrap(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql.strip()
        return fn
    return wrap


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# ---------------------------------------------------------------------------
# 7: byte-level BPE.
# ---------------------------------------------------------------------------
def bpe_digests(spark: SparkSession, docs: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Every text encoded, its ids decoded, and the digests of both."""
    import public_tokenizers as P

    from tempora.llm.bpe import bpe_encode

    out = bpe_encode(spark, docs, P.path("byte_bpe_50k.tiktoken"), P.PATTERN, keep=keep, decode=True)
    return out.withColumns({"ids_sha256": F.sha2("ids", 256), "decoded_sha256": F.sha2("decoded", 256)}).drop("ids", "decoded")


@register("op7_bpe")
def op7_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's text as byte-level BPE ids and back, as digests."""
    return bpe_digests(spark, _table(spark, sf_dir, "documents"))


# ---------------------------------------------------------------------------
# 9: language ID.
# ---------------------------------------------------------------------------
@register("op9_language_id")
def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The predicted language of every document, learned from the labelled documents that aren't held out."""
    from tempora.llm.lang_id import held_out, identify_language, language_samples

    docs = _table(spark, sf_dir, "documents")
    samples = language_samples(docs, ~held_out())
    out = identify_language(spark, docs, samples)
    return out.select("doc_id", held_out().alias("held_out"), "lang_pred", "score", "entropy")


# ---------------------------------------------------------------------------
# 6: substring dedup.
# ---------------------------------------------------------------------------
@register("op6_substring_dedup")
def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the words of 35-word windows that occur twice or more."""
    from tempora.llm.substring_dedup import substring_dedup

    out = substring_dedup(_table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


# ---------------------------------------------------------------------------
# 1: URL filters.
# ---------------------------------------------------------------------------
@register("op1_url_filter")
def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Host, path, rule and verdict of every page's url; trees learned from the ruled urls judge the rest."""
    from tempora.llm.url_filter import judge_urls

    return judge_urls(_table(spark, sf_dir, "pages"))


# ---------------------------------------------------------------------------
# 3: sharding.
# ---------------------------------------------------------------------------
@register("op3_sharding")
def op3_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document in one of 40 shards of nearly equal bytes, equal texts together."""
    from tempora.llm.sharding import shard

    out = shard(spark, _table(spark, sf_dir, "documents"), 40)
    return out.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                      F.lit(None).cast("int").alias("grown_shard"))


# ---------------------------------------------------------------------------
# 5: benchmark decontamination.
# ---------------------------------------------------------------------------
def _decontamination_sql() -> str:
    from tempora.llm.decontam import oracle

    return oracle()


@register("op5_decontamination", _decontamination_sql())
def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs of a document and a benchmark item of which it holds three quarters of the shingles or more."""
    from tempora.llm.decontam import benchmark_leaks

    return benchmark_leaks(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


# ---------------------------------------------------------------------------
# 10: exact top-k search.
# ---------------------------------------------------------------------------
@register("op10_topk", """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(64 * CAST(x AS DOUBLE))) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id, CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 20 = 0),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 20
""")
def op10_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 highest inner products of every vector whose id is divisible by 20, over all vectors."""
    from tempora.llm.topk import top_k

    return top_k(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


# ---------------------------------------------------------------------------
# 2: suffix-array dedup.
# ---------------------------------------------------------------------------
@register("op2_suffix_array_dedup")
def op2_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the bytes of 400-byte strings that occur twice or more."""
    from tempora.llm.suffix_array import suffix_dedup

    out = suffix_dedup(_table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_bytes", "n_removed", F.size("removed").cast("long").alias("n_spans"),
                      F.sha2("kept", 256).alias("kept_sha256"))


# ---------------------------------------------------------------------------
# 8: n-gram Jaccard join.
# ---------------------------------------------------------------------------
@register("op8_jaccard_join")
def op8_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its number of shingles and the least document it is linked with, directly or not."""
    from tempora.llm.jaccard_join import jaccard_components

    return jaccard_components(_table(spark, sf_dir, "documents"))


# ---------------------------------------------------------------------------
# 4: LM scoring.
# ---------------------------------------------------------------------------
@register("op4_lm_score")
def op4_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cross-entropy difference of every document: target, the documents labelled as of quality; background, all."""
    from tempora.llm.lm_score import score_texts

    good = _table(spark, sf_dir, "labels").where("quality = 1 AND coalesce(toxic, 0) = 0").select("doc_id")
    return score_texts(_table(spark, sf_dir, "documents"), good)


# ---------------------------------------------------------------------------
# 12: token ids in files.
# ---------------------------------------------------------------------------
END_ID = 2


@register("op12_token_files")
def op12_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's ids written to ORC files in the order of doc_id, read back, and their places and checksums."""
    import public_tokenizers as P

    from tempora.llm.token_files import id_digests, read_token_files, write_token_files
    from tempora.session import shared_path

    path = shared_path(spark, "token_files", unique=True)
    write_token_files(spark, _table(spark, sf_dir, "documents"), path, P.path("word_bpe_49k.json"), END_ID)
    return id_digests(read_token_files(spark, path)).withColumnRenamed("doc", "doc_id")


# ---------------------------------------------------------------------------
# 11: periodic runs.
# ---------------------------------------------------------------------------
def _with_periodic_tails(docs: DataFrame) -> DataFrame:
    """(doc_id, text): the words of a tenth of the texts, by the checksum of the id, repeat from some word on.

    With h = crc32 of the decimal id and g = floor(h / 10): if h % 10 = 0, each of the n words from a = g % n on becomes
    word a + (i - a) % p, where p = 1 + floor((n - a) / (3 + g % 8)). A null id leaves its text as it is.
    """
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    g = F.floor(h / 10).cast("long")
    words = F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda w: w != "")

    def tail(s):
        n = F.size(s["words"]).cast("long")
        a = F.pmod(s["g"], n)
        turns = 3 + F.pmod(s["g"], F.lit(8))
        p = 1 + F.floor((n - a) / turns).cast("long")
        again = F.flatten(F.array_repeat(F.slice(s["words"], (a + 1).cast("int"), p.cast("int")), (turns + 1).cast("int")))
        out = F.concat(F.slice(s["words"], F.lit(1), a.cast("int")), F.slice(again, F.lit(1), (n - a).cast("int")))
        return F.when(n > 0, F.array_join(out, " ")).otherwise(F.lit(""))

    changed = F.transform(F.array(F.struct(words.alias("words"), g.alias("g"))), tail)[0]
    return docs.select("doc_id", F.when(F.pmod(h, F.lit(10)) == 0, changed).otherwise(F.col("text")).alias("text"))


@register("op11_periodic_runs")
def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's periodic runs of words, the strongest of them, and the text without their repetitions, as digests."""
    from tempora.llm.periodic_runs import periodic_runs

    out = periodic_runs(_with_periodic_tails(_table(spark, sf_dir, "documents")))

    def stronger(best, r):
        more, same = r["length"] * best["period"], best["length"] * r["period"]
        # Runs come by start, then period: at a tie the earlier one stays.
        return F.when(best.isNull() | (more > same), r).otherwise(best)

    best = F.aggregate("runs", F.lit(None).cast("struct<start:bigint,length:bigint,period:bigint>"), stronger)
    lines = F.transform("runs", lambda r: F.concat(r["start"].cast("string"), F.lit(","), r["length"].cast("string"), F.lit(","),
                                                   r["period"].cast("string"), F.lit("\n")))
    out = out.select("doc_id", F.size("runs").cast("long").alias("n_runs"), best.alias("best"),
                     F.sha2(F.array_join(lines, "").cast("binary"), 256).alias("runs_sha256"),
                     F.sha2(F.col("kept_text").cast("binary"), 256).alias("collapsed_sha256"))
    return out.select("doc_id", "n_runs", "best.start", "best.length", "best.period",
                      F.floor(1000 * F.col("best.length") / F.col("best.period")).cast("long").alias("exponent_milli"),
                      "runs_sha256", "collapsed_sha256")


# ---------------------------------------------------------------------------
# 13: embedding whitening.
# ---------------------------------------------------------------------------
@register("op13_whitening")
def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every vector's whitened components, up to 32, with the share of variance that each explains."""
    from tempora.llm.whitening import whiten

    out = whiten(spark, _table(spark, sf_dir, "embeddings"))
    out = out.select("vec_id", "n", "deviation", "identity_error",
                     F.posexplode(F.arrays_zip("whitened", "explained")).alias("at", "c"))
    return out.select("vec_id", (F.col("at") + 1).cast("int").alias("component"), "n", "deviation", "c.whitened", "c.explained", "identity_error")
