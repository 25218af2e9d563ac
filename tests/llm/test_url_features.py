"""Every lexical feature and the suffix statistics of URLs against plain Python, and the verdicts of urls that no rule decides."""

import math
from collections import Counter

from pyspark.sql import functions as F

from tests.conftest import SMOKE_DIR

ODD = [None, "", "http://", "://", "no scheme", "https://a.b.c/x/y//z?q=1&r=2&s#f", "http://H-O.s1t/9?", "http://x.y/?a", "http://é.ü/ñ?=&=", "a?b?c&d#e?f",
       "http://x/#?a=1", "HTTPS://x.y/--1", "http://a..b/./", "http://q\n.w/e?r=\n&t"]


def parts(url):
    """(host, path) as the contract of the operator has them."""
    at = (url or "").find("://")
    if at < 0:
        return "", ""
    rest = url[at + 3:]
    host = rest[: min((rest.find(c) for c in "/?#" if c in rest), default=len(rest))]
    path = rest[len(host):]
    path = path[: min((path.find(c) for c in "?#" if c in path), default=len(path))]
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in host), path


def features(url):
    u, (host, path) = url or "", parts(url)
    n = max(1, len(u))
    before, _, query = u.partition("#")[0].partition("?")
    count = Counter(u)
    return {"url_length": len(u), "host_length": len(host), "path_length": len(path), "host_labels": len(host.split(".")),
            "path_depth": sum(1 for x in path.split("/") if x), "digit_ratio": sum(c in "0123456789" for c in u) / n,
            "entropy": -sum(k / n * math.log2(k / n) for k in count.values()), "n_parameters": len(query.split("&")) if query else 0,
            "n_hyphens": u.count("-"), "has_fragment": float("#" in u), "is_https": float(u.startswith("https://")),
            "suffix_length": len(host.rsplit(".", 1)[-1])}


def test_every_feature_is_that_of_plain_python(spark):
    from tempora.llm.url_filter import FEATURES, host_of, lexical_features, path_of

    urls = ODD + [r.url for r in spark.read.parquet(f"{SMOKE_DIR}/pages.parquet").select("url").collect()]
    df = spark.createDataFrame(list(enumerate(urls)), "n int, url string").withColumns({"h": host_of(F.col("url")), "p": path_of(F.col("url"))})
    got = {r.n: r for r in lexical_features(df, "url", "h", "p").collect()}
    for n, url in enumerate(urls):
        want = features(url)
        assert (got[n].h, got[n].p) == parts(url)
        assert set(want) == set(FEATURES) - {"suffix_rate", "suffix_count"}
        for name, value in want.items():
            assert math.isclose(got[n][name], value, rel_tol=1e-12, abs_tol=1e-12), (url, name)


def test_suffix_statistics_are_smoothed_counts(spark):
    from tempora.llm.url_filter import suffix_statistics

    rows = [(1, 1.0), (1, 1.0), (1, 0.0), (7, 0.0)]
    got = {r.suffix_slot: (r.suffix_rate, r.suffix_count) for r in suffix_statistics(spark.createDataFrame(rows, "suffix_slot int, label double"), "label").collect()}
    assert got == {1: (3 / 5, 2.0), 7: (1 / 3, 1.0)}


def test_urls_that_no_rule_decides_follow_the_labelled_ones(spark):
    """Blocked urls are long and full of digits, allowed ones short: held-out urls of both kinds are judged alike."""
    from tempora.llm.url_filter import judge_urls, parse_rule

    rules = [parse_rule("block", "bad.test/"), parse_rule("allow", "good.test/")]

    def url(k, kind, host):
        return f"http://{host}/{'a' * (k % 5)}" if kind == "good" else f"http://{host}/{k * 7919 % 10**6}/{k}?x={k}&y={k * 31}&z=1"

    rows = [(k, url(k, kind, f"{kind}.test")) for k, kind in enumerate(["good", "bad"] * 300)]
    rows += [(10_000 + k, url(k, kind, "else.test")) for k, kind in enumerate(["good", "bad"] * 100)]
    got = {r.page_id: r for r in judge_urls(spark.createDataFrame(rows, "page_id int, url string"), rules).collect()}
    held = [(got[10_000 + k], kind) for k, kind in enumerate(["good", "bad"] * 100)]
    assert all(r.rule is None for r, _ in held)
    assert sum((r.verdict == "block") == (kind == "bad") for r, kind in held) >= 195
    one = judge_urls(spark.createDataFrame(rows[:1] + rows[-2:], "page_id int, url string"), rules).collect()  # labels of one class only
    assert {r.verdict for r in one} == {"allow"}
