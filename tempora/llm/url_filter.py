"""URL filtering: rules by host and path, and boosted trees on lexical features for the rest.

The trees are trained on labelled URLs (here: those that a rule decides), of
which a bounded sample is taken; features, suffix statistics and verdicts are
column expressions over all rows.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tempora.session import shared_path

SAMPLE_ROWS = 10_000   # labelled URLs of each class that the trees see, about
SAMPLE_TASKS = 2       # tasks over that sample
SUFFIX_SLOTS = 4_096   # suffix statistics are kept by hash slot, so that their table is bounded
FEATURES = ["url_length", "host_length", "path_length", "host_labels", "path_depth", "digit_ratio", "entropy",
            "n_parameters", "n_hyphens", "has_fragment", "is_https", "suffix_length", "suffix_rate", "suffix_count"]
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class Rule:
    """A verdict for a host with all its subdomains, on paths with the given beginning."""

    verdict: str
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path


def parse_rule(verdict: str, text: str) -> Rule:
    host, slash, path = text.partition("/")
    return Rule(verdict, host, slash + path)


RULES = [parse_rule("block", "net/"), parse_rule("allow", "example.net/en/"), parse_rule("block", "example.com/de/"),
         parse_rule("allow", "org/fr/")]


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; empty without ``://``."""
    return F.translate(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")), UPPER, LOWER)


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end; empty without ``://``."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_of(host: Column, path: Column, rules: list[Rule]) -> Column:
    """Text of the longest rule that fits, or null."""
    out = F.lit(None).cast("string")
    for r in sorted(rules, key=lambda r: (len(r.text), r.text)):  # the longest is tested first
        fits = ((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path)
        out = F.when(fits, F.lit(r.text)).otherwise(out)
    return out


def lexical_features(df: DataFrame, url: str, host: str, path: str) -> DataFrame:
    """The columns of FEATURES but for the suffix's rate and count, and the suffix's slot. Null urls: as empty."""
    u = F.coalesce(F.col(url), F.lit(""))
    n = F.greatest(F.char_length(u), F.lit(1))
    query = F.regexp_extract(u, r"(?s)^[^?#]*\?([^#]*)", 1)
    share = F.transform(F.array_distinct(F.split(u, "")),
                        lambda c: (F.char_length(u) - F.char_length(F.replace(u, c, F.lit("")))) / n)
    suffix = F.substring_index(F.col(host), ".", -1)
    return df.withColumns({
        "url_length": F.char_length(u).cast("double"),
        "host_length": F.char_length(host).cast("double"),
        "path_length": F.char_length(path).cast("double"),
        "host_labels": F.size(F.split(F.col(host), r"\.")).cast("double"),
        "path_depth": F.size(F.filter(F.split(F.col(path), "/"), lambda x: x != "")).cast("double"),
        "digit_ratio": F.char_length(F.regexp_replace(u, "[^0-9]", "")) / n,
        "entropy": F.aggregate(share, F.lit(0.0), lambda a, p: a - F.when(p > 0, p * F.log2(p)).otherwise(0.0)),
        "n_parameters": F.when(query == "", 0.0).otherwise(F.size(F.split(query, "&")).cast("double")),
        "n_hyphens": (F.char_length(u) - F.char_length(F.replace(u, F.lit("-"), F.lit("")))).cast("double"),
        "has_fragment": F.contains(u, F.lit("#")).cast("double"),
        "is_https": u.startswith("https://").cast("double"),
        "suffix_length": F.char_length(suffix).cast("double"),
        "suffix_slot": F.pmod(F.xxhash64(suffix), F.lit(SUFFIX_SLOTS)).cast("int"),
    })


def suffix_statistics(labelled: DataFrame, label: str) -> DataFrame:
    """(suffix_slot, suffix_rate, suffix_count) over all labelled rows: at most SUFFIX_SLOTS rows, smoothed."""
    return labelled.groupBy("suffix_slot").agg(
        ((F.sum(label) + 1) / (F.count(F.lit(1)) + 2)).alias("suffix_rate"),
        F.log2(F.count(F.lit(1)) + F.lit(1.0)).alias("suffix_count"))


def judge_urls(pages: DataFrame, rules: list[Rule] = RULES, id_col: str = "page_id", url_col: str = "url",
               sample_rows: int = SAMPLE_ROWS, rounds: int = 10, depth: int = 4, seed: int = 7) -> DataFrame:
    """(id, host, path, rule, verdict, block_probability) for every row.

    A rule decides the urls that it fits; these are also the labelled urls that the trees learn
    from, at most about ``sample_rows`` of each class, chosen by the url's hash. The trees decide
    the rest, block at a probability of one half or more; with labels of one class only, or none,
    the rest gets that class (allow if none). Null urls and urls without ``://`` have an empty host
    and path and are judged by the trees like others. Repeated rows are kept; other columns are not read.
    """
    base = pages.select(F.col(id_col), F.col(url_col).alias("__url"))
    base = base.withColumns({"host": host_of(F.col("__url")), "path": path_of(F.col("__url"))})
    base = base.withColumn("rule", rule_of(F.col("host"), F.col("path"), rules))
    verdict = F.create_map(*[F.lit(x) for r in rules for x in (r.text, r.verdict)])[F.col("rule")]
    base = base.withColumn("ruled", verdict)
    rows = lexical_features(base, "__url", "host", "path")
    labelled = rows.where("ruled IS NOT NULL").withColumn("label", (F.col("ruled") == "block").cast("double"))
    counts = {r.label: r.n for r in labelled.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    spark, path = pages.sparkSession, shared_path(pages.sparkSession, "url_filter", unique=True)
    statistics = suffix_statistics(labelled, "label")
    statistics.write.parquet(f"{path}/suffixes")  # read by the sample and by the verdicts
    statistics = F.broadcast(spark.read.schema(statistics.schema).parquet(f"{path}/suffixes"))  # bounded by SUFFIX_SLOTS
    rows = rows.join(statistics, "suffix_slot", "left").fillna({"suffix_rate": 0.5, "suffix_count": 0.0})
    if len(counts) < 2:
        block = F.lit(1.0 if 1.0 in counts else 0.0)
    else:
        share = F.create_map(*[F.lit(x) for k, n in sorted(counts.items()) for x in (k, min(1.0, sample_rows / n))])
        sample = labelled.join(statistics, "suffix_slot", "left").where(
            F.pmod(F.xxhash64(F.lit(seed), "__url", id_col), F.lit(1_000_000)) < F.lit(1_000_000) * share[F.col("label")])
        assembler = VectorAssembler(inputCols=FEATURES, outputCol="features")
        trees = GBTClassifier(maxIter=rounds, maxDepth=depth, maxBins=32, seed=seed)
        # The sample is written once, by all tasks of a scan: the trees read it again and again, and never the pages.
        sample.select("label", *FEATURES).write.parquet(f"{path}/sample")
        sample = spark.read.parquet(f"{path}/sample").coalesce(SAMPLE_TASKS)
        model = trees.fit(assembler.transform(sample).select("features", "label"))
        rows = model.transform(assembler.transform(rows))
        block = vector_to_array(F.col("probability"))[1]
    rows = rows.withColumn("block_probability", block)
    decided = F.coalesce(F.col("ruled"), F.when(F.col("block_probability") >= 0.5, F.lit("block")).otherwise(F.lit("allow")))
    return rows.select(id_col, "host", "path", "rule", decided.alias("verdict"), "block_probability")
