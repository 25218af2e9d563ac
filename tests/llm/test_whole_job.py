"""Inputs on which an operator of tempora.llm could do less than its whole job: long paths, colliding hashes."""

import random
from functools import partial

from pyspark.sql import functions as F

from tests.conftest import SMOKE_DIR


def test_connected_components_of_a_long_path(spark):
    from tempora.llm.components import connected_components

    nodes = random.Random(5).sample(range(10**9), 3000)
    edges = [(a, b) if k % 2 else (b, a) for k, (a, b) in enumerate(zip(nodes, nodes[1:]))] + [(-1, -3), (-2, -3)]
    got = dict(map(tuple, connected_components(spark.createDataFrame(edges, "a long, b long")).collect()))
    assert got == {**dict.fromkeys(nodes, min(nodes)), -1: -3, -2: -3, -3: -3}
    none = connected_components(spark.createDataFrame([(7, 7)], "a long, b long"))
    assert none.columns == ["node", "label"] and none.count() == 0


def test_jaccard_sets_whose_short_hash_is_anothers(spark, monkeypatch):
    from tempora.llm import jaccard_join

    # The set of each first word has the same first 44 bits as the shingle of the second.
    monkeypatch.setattr(jaccard_join.B, "text_blocks", partial(jaccard_join.B.text_blocks, block_bytes=64))
    rows = []
    for k, (x, y) in enumerate([("xjfelne", "yikfipb"), ("xhiojma", "ydpgddf"), ("xkjjadf", "yiplbjc")]):
        rows += [(100 * k + n, x) for n in range(2)] + [(100 * k + n, y) for n in range(2, 40)]
    out = jaccard_join.jaccard_components(spark.createDataFrame(rows, "doc_id long, text string"))
    want = [(i, 1, i // 100 * 100 + (0 if t[0] == "x" else 2)) for i, t in rows]
    assert sorted(map(tuple, out.collect())) == sorted(want)


def test_language_sample_of_long_and_repeated_texts(spark):
    from tempora.llm import lang_id as L

    def word(k):
        return "".join(chr(97 + int(d)) for d in f"{k:04d}")

    rows = [(k, f"{word(k)} " * 1800, "en") for k in range(300)] + [(k, f"{word(999)} " * 1800, "en") for k in range(1000, 2500)]
    rows += [(5000 + k, f"{word(k)} 12", "xx") for k in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    samples = L.language_samples(docs, F.lit(True))
    assert sorted(samples) == ["en", "xx"] and len(samples["xx"].split()) > 50
    parts = [set(t.split()) for t in samples["en"].split("\n")]
    share = [len(t) + 1 for t in samples["en"].split("\n")]
    assert sum(share) == L.SAMPLE_CHARS and max(share) - min(share) <= 1
    assert len(parts) > 50 and len({min(p, key=lambda w: (-len(w), w)) for p in parts}) == len(parts)
    assert L.equal_shares([1000, 5, 100], 300) == [195, 5, 100] and L.equal_shares([3, 4], 100) == [3, 4]


def test_language_of_thousands_of_letters():
    from tempora.llm import lang_id as L

    rng = random.Random(4)
    letters = {"a": [chr(0x4E00 + k) for k in range(900)], "b": [chr(0x4E00 + 600 + k) for k in range(900)], "c": list("abcdefgh")}
    words = {k: ["".join(rng.choices(v, k=3)) for _ in range(500)] for k, v in letters.items()}
    samples = {k: "".join(rng.choices(v, k=1500)) for k, v in words.items()}
    table, n = L.character_classes(list(samples.values()))
    assert len({int(table[ord(c)]) for s in samples.values() for c in s}) == len(set("".join(samples.values()))) == n - 2
    texts = ["".join(rng.choices(v, k=60)) for v in words.values() for _ in range(5)]
    texts += [samples["a"][100:160] + samples["b"][50:90], "\u0430\u0431\u0432" * 30, samples["c"][:40] + samples["a"][:40] + "\u0430"]
    parser = L.CrossParser(samples)
    assert parser.n_rare > 1000
    total, _, _ = parser.phrases(texts)
    for k, name in enumerate(parser.names):
        known = "".join(map(chr, L.to_classes([samples[name]], parser.table)[0]))
        for t, n in zip(texts, total[k].tolist()):
            codes = "".join(map(chr, L.to_classes([t], parser.table)[0]))
            at = want = 0
            while at < len(codes):
                size = 1
                while at + size < len(codes) and codes[at: at + size + 1] in known:
                    size += 1
                at, want = at + size, want + 1
            assert n == want
    assert parser.predict(texts)[0][:15] == ["a"] * 5 + ["b"] * 5 + ["c"] * 5


def test_pipeline_decides_by_row(spark):
    import corpus_pipeline as P

    base = spark.read.parquet(f"{SMOKE_DIR}/documents.parquet").schema

    def after(stage, rows):
        docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in rows], base)
        return sorted(((r.doc_id, r.text) for r in stage(spark, docs, SMOKE_DIR).collect()), key=str)

    def words(name, n=60):
        return " ".join(f"{name}{k}" for k in range(n))

    a, b, c, d = (words(x) for x in ("one", "two", "three", "four"))
    rows = [(1, a), (None, a + " more"), (None, b), (None, b), (None, b + " more"), (2, c), (3, c + " more"), (3, d)]
    left = after(P.near_copies, rows)
    assert len(left) == 4 and {(1, a), (2, c), (3, d)} < set(left) and (None, b) in [(i, t.removesuffix(" more")) for i, t in left]
    passage = words("passage", 80)
    rows = [(None, "first " + passage), (None, "second " + passage), (7, a), (7, a[:190] + d), (8, passage), (8, words("postage", 80))]
    assert len(rows[4][1]) == len(rows[5][1])
    left = after(P.repeated_passages, rows)
    assert left == sorted([(None, "first"), (None, "second"), *rows[2:4], rows[5]], key=str)
    # Passages of 50 words of under 400 bytes, once in the one place and once in the other.
    short = " ".join(f"p{k}sage"[:6] for k in range(10, 60))
    assert 260 < len(short) < 390
    rows = [(1, words("head") + "/" + short + "!" + words("tail")), (2, words("other") + "?" + short)]
    assert after(P.repeated_passages, rows) == [(1, words("head") + "/!" + words("tail")), (2, words("other") + "?")]
    item = spark.read.parquet(f"{SMOKE_DIR}/benchmark.parquet").orderBy("item_id").first().text
    rows = [(None, "start " + item + " end"), (9, item), (9, a), (None, b)]
    assert after(P.benchmark_leaks, rows) == sorted([(9, a), (None, b)], key=str)


def test_pipeline_keeps_columns_that_have_its_own_names(spark):
    import corpus_pipeline as P

    extra = {"score": F.lit(1.5), "lang_pred": F.lit("mine"), "entropy": F.col("doc_id"), "__row": F.lit("r"), "__text": F.lit(7),
             "__cut": F.lit(False), "__rows": F.lit(9), "component_id": F.col("doc_id")}
    docs = spark.read.parquet(f"{SMOKE_DIR}/documents.parquet").limit(60).withColumns(extra)
    kept = docs
    for _, stage in P.STAGES[:-1]:
        kept = stage(spark, kept, SMOKE_DIR)
        assert kept.columns == docs.columns
    got = kept.collect()
    assert got and all((r["score"], r["lang_pred"], r["__row"], r["__text"], r["__cut"], r["__rows"]) == (1.5, "mine", "r", 7, False, 9)
                       and r["entropy"] == r["component_id"] == r["doc_id"] for r in got)
