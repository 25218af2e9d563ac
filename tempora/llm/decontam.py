"""Benchmark decontamination by size-partitioned MinHash containment search, in DataFrame functions only.

Test items are partitioned by size (powers of two of their number of shingles).
In each partition an item's sketch is its shingles with the smallest hashes, as
many as the partition's largest item may miss at the threshold and one more: a
document that contains the item at the threshold holds at least one of them.
Documents, however long, are probed with every shingle; the pairs found are
verified by comparing shingles as text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tempora.session import shared_path

WORDS = 5
THRESHOLD_PERCENT = 75
BROADCAST_ROWS = 200_000  # item shingles up to which they are broadcast (some 40 bytes each)
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def words_of(text: Column) -> Column:
    """Words ``[^\\x20\\x09-\\x0D]+`` with A-Z lower-cased; null and empty texts have none."""
    plain = F.translate(F.coalesce(text, F.lit("")), UPPER + "\t\n\x0b\x0c\r", LOWER + "     ")
    return F.filter(F.split(plain, " "), lambda w: w != "")


def shingle_hashes(words: Column, n: int = WORDS) -> Column:
    """Hash of each run of ``n`` words, in order; all words as one run if there are fewer."""
    full = F.transform(F.sequence(F.lit(0), F.size(words) - n), lambda i: F.xxhash64(*[F.get(words, i + k) for k in range(n)]))
    short = F.array(F.xxhash64(F.array_join(words, " ")))
    return F.when(F.size(words) >= n, full).when(F.size(words) > 0, short).otherwise(F.array().cast("array<bigint>"))


def shingle_texts(words: Column, n: int = WORDS) -> Column:
    """The runs themselves, words joined by a space."""
    full = F.transform(F.sequence(F.lit(0), F.size(words) - n), lambda i: F.concat_ws(" ", *[F.get(words, i + k) for k in range(n)]))
    return F.when(F.size(words) >= n, full).when(F.size(words) > 0, F.array(F.array_join(words, " "))).otherwise(
        F.array().cast("array<string>"))


def item_sketches(items: DataFrame, percent: int = THRESHOLD_PERCENT) -> DataFrame:
    """(item_key, n_shingles, h) for the sketch of each item of (item_key, n_shingles, hashes)."""
    size_class = F.floor(F.log2(F.col("n_shingles")))
    # Shingles that an item of n may miss: n - ceil(n * percent / 100) = floor(n * (100 - percent) / 100);
    # of a class of sizes it is the most for the largest size.
    largest = F.least(F.pow(F.lit(2), size_class + 1) - 1, F.lit(float(1 << 52)))
    k = (F.floor(largest * (100 - percent) / 100) + 1).cast("int")
    return items.where("n_shingles > 0").withColumn("h", F.explode(F.slice(F.array_sort("hashes"), 1, k))).drop("hashes")


def benchmark_leaks(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    item_col: str = "item_id", item_text_col: str = "text", percent: int = THRESHOLD_PERCENT,
                    broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """(id, item, n_item_shingles, n_found): pairs whose document holds ``percent`` % of the item's shingles or more.

    Shingles are distinct runs of five words, A-Z lower-cased; a text with fewer words is one shingle
    by itself (it is then found only in a document that is the same words); null and empty texts
    have none and are never paired. Repeated rows of a document or an item give their pair once; a
    null id can't be named and takes no part. Without items or documents: no rows. Other columns are
    not read. The items' shingles are broadcast up to ``broadcast_rows`` and joined by shuffle beyond.
    """
    i = items.select(F.col(item_col).alias("item_key"), words_of(F.col(item_text_col)).alias("w")).where("item_key IS NOT NULL")
    i = i.withColumn("texts", F.array_distinct(shingle_texts(F.col("w")))).withColumn("hashes", F.array_distinct(shingle_hashes(F.col("w"))))
    i = i.select("item_key", "hashes", "texts", F.size("texts").cast("long").alias("n_shingles")).where("n_shingles > 0")
    n = i.agg(F.coalesce(F.sum("n_shingles"), F.lit(0))).first()[0]
    sized = F.broadcast if n <= broadcast_rows else (lambda x: x)

    d = docs.select(F.col(id_col).alias("doc_key"), F.col(text_col).cast("string").alias("doc_text")).where("doc_key IS NOT NULL")
    # The words stand in a column of their own: inside the lambdas of the shingles they would be cut anew for each.
    probes = d.select("doc_key", words_of(F.col("doc_text")).alias("w")).select("doc_key", F.explode(shingle_hashes(F.col("w"))).alias("h"))
    sketches = item_sketches(i.drop("texts")).select("h", "item_key")
    hits = probes.join(sized(sketches), "h").select("doc_key", "item_key").distinct()
    path = shared_path(docs.sparkSession, "decontamination", unique=True)
    hits.write.parquet(path)  # read three times below
    hits = docs.sparkSession.read.schema(hits.schema).parquet(path)

    # Verification: the shingles of the documents that were hit, as text, against the items' shingles.
    # A document is read again only if it is among the hits; texts are compared, not hashes.
    hit_docs = d.join(hits.select("doc_key").distinct(), "doc_key", "left_semi")
    held = hit_docs.select("doc_key", words_of(F.col("doc_text")).alias("w")).select("doc_key", F.explode(shingle_texts(F.col("w"))).alias("s"))
    wanted = i.select("item_key", "n_shingles", F.explode("texts").alias("s"))
    found = held.join(sized(wanted), "s").join(hits, ["doc_key", "item_key"], "left_semi")
    found = found.groupBy("doc_key", "item_key").agg(F.max("n_shingles").alias("n_item_shingles"), F.countDistinct("s").alias("n_found"))
    return found.where(F.col("n_found") * 100 >= F.col("n_item_shingles") * percent).select(
        F.col("doc_key").alias(id_col), F.col("item_key").alias(item_col), "n_item_shingles", "n_found")


def oracle(documents: str = "documents", benchmark: str = "benchmark") -> str:
    """DuckDB SQL for the same rows, by exact containment."""
    def shingles(table: str, key: str) -> str:
        return f"""
  SELECT DISTINCT k, unnest(CASE WHEN len(w) >= 5 THEN list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))
                                 WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS s
  FROM (SELECT {key} AS k, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\\x20\\x09-\\x0D]+') AS w
        FROM {table} WHERE {key} IS NOT NULL)"""

    return f"""
WITH d AS ({shingles(documents, 'doc_id')}),
b AS ({shingles(benchmark, 'item_id')}),
n AS (SELECT k, count(*) AS n FROM b GROUP BY k)
SELECT d.k AS doc_id, b.k AS item_id, any_value(n.n) AS n_item_shingles, count(*) AS n_found
FROM d JOIN b ON d.s = b.s JOIN n ON n.k = b.k GROUP BY d.k, b.k HAVING count(*) * 100 >= any_value(n.n) * 75"""
