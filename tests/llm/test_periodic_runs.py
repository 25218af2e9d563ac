"""Periodic runs against brute force: Lyndon arrays, runs of short alphabets, whole texts, the registered query."""

import hashlib
import random
import re
import zlib
from fractions import Fraction

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tests.conftest import SMOKE_DIR

WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def brute_lyndon(s):
    """Longest prefix of each suffix that is less than all its proper suffixes."""
    def lyndon(w):
        return all(w < w[k:] for k in range(1, len(w)))
    return [max(k for k in range(1, len(s) - i + 1) if lyndon(s[i: i + k])) for i in range(len(s))]


def brute_runs(w, min_length, repeats):
    """Maximal stretches that keep period q, for each q; q is the smallest period unless a smaller run has the same stretch."""
    n, out = len(w), {}
    for q in range(1, n // repeats + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and w[j] == w[j + q]:
                j += 1
            if j > i and j + q - i >= max(min_length, repeats * q) and not any(w_s <= i and j + q <= w_e for w_s, w_e in smaller(out, q)):
                out[i, q] = j + q - i
            i = max(j, i) + 1
    return sorted((s, length, q) for (s, q), length in out.items())


def smaller(found, q):
    return [(s, s + length) for (s, p), length in found.items() if q % p == 0 and p < q]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(0, 3), min_size=1, max_size=24))
def test_lyndon_array_is_that_of_brute_force(s):
    from tempora.llm.periodic_runs import lyndon_array

    ranks = np.unique(s, return_inverse=True)[1].tolist()
    assert lyndon_array(ranks) == brute_lyndon(ranks)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 2), min_size=0, max_size=60), st.integers(1, 6), st.integers(2, 3))
def test_runs_are_those_of_brute_force(s, min_length, repeats):
    from tempora.llm.periodic_runs import runs_of

    assert runs_of(np.array(s, dtype=np.int64), min_length, repeats) == brute_runs(s, min_length, repeats)


@pytest.mark.parametrize("seed", range(6))
def test_stretches_hold_every_run(seed):
    """Joined from parts with and without runs: what the stretches give equals the whole text's runs."""
    from tempora.llm.periodic_runs import runs_of, shared_window, stretches

    rng = random.Random(seed)
    texts = []
    for _ in range(8):
        w = []
        for _ in range(rng.randint(0, 6)):
            part = [rng.randint(0, 30) for _ in range(rng.randint(1, 20))]
            w += (part * 9)[: rng.randint(1, 8 * len(part))] if rng.random() < 0.6 else [rng.randint(0, 10**6) for _ in range(30)]
        texts.append(w)
    codes = np.array([x for w in texts for x in w], dtype=np.int64)
    bounds = np.concatenate(([0], np.cumsum([len(w) for w in texts])))
    got = [[] for _ in texts]
    for t, start, end in stretches(codes, bounds, shared_window(24, 3), 24):
        got[t] += [(s + start - int(bounds[t]), length, q) for s, length, q in runs_of(codes[start:end], 24, 3)]
    assert [sorted(g) for g in got] == [brute_runs(w, 24, 3) for w in texts]
    assert any(got)


def test_an_equal_hash_of_different_stretches_is_mended():
    from tempora.llm.periodic_runs import _exact

    codes = np.array([9, 1, 2, 1, 2, 1, 2, 7, 8])
    assert _exact(codes, 1, 0, 9, 2) == (1, 7) == _exact(codes, 1, 1, 7, 2)


def test_a_long_run_of_one_word_and_of_a_long_period():
    from tempora.llm.periodic_runs import runs_of

    assert runs_of(np.zeros(50_000, dtype=np.int64), 24, 3) == [(0, 50_000, 1)]
    rng = np.random.default_rng(1)
    period = rng.integers(0, 10**6, 20_000)
    codes = np.concatenate((rng.integers(10**7, 10**8, 100), np.tile(period, 4)[:70_001]))
    assert runs_of(codes, 24, 3) == [(100, 70_001, 20_000)]


def expected(doc_id, text):
    """The registered query's row by brute force, from the words of the text."""
    w = WORD.findall((text or "").encode())
    n = len(w)
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    g = h // 10
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    runs = brute_runs(w, 24, 3) if n <= 800 else None
    if runs is None:
        return None
    drop = [False] * n
    for s, length, q in runs:
        drop[s + q: s + length] = [True] * (length - q)
    best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2])) if runs else (None, None, None)
    kept = b" ".join(x for x, d in zip(w, drop) if not d)
    return (doc_id, len(runs), *best, 1000 * best[1] // best[2] if runs else None,
            hashlib.sha256("".join(f"{s},{length},{q}\n" for s, length, q in runs).encode()).hexdigest(), hashlib.sha256(kept).hexdigest())


COLUMNS = ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]


def test_query_equals_brute_force(spark):
    from tempora.llm.queries import QUERIES

    out = QUERIES["op11_periodic_runs"](spark, SMOKE_DIR)
    assert out.columns == COLUMNS
    got = {r.doc_id: tuple(r) for r in out.collect()}
    docs = spark.read.parquet(f"{SMOKE_DIR}/documents.parquet").select("doc_id", "text").collect()
    assert len(got) == len(docs)
    want = [x for x in (expected(r.doc_id, r.text) for r in docs) if x is not None]
    assert len(want) > 150 and [got[x[0]] for x in want] == want
    assert sum(x[1] > 0 for x in want) > 10


def test_nulls_empties_ties_repeats_and_clashing_names(spark):
    from tempora.llm.periodic_runs import periodic_runs
    from tempora.llm.queries import _with_periodic_tails

    two = "a " * 30 + "x y z " + "b " * 30
    nested = ("k " * 12 + "m ") * 5
    rows = [(1, None), (2, ""), (3, " \t\n "), (4, "a " * 23), (5, "\x0ba\x0c" + "a  " * 24), (6, two), (7, nested), (7, nested), (None, two),
            (None, None), (8, "é é " * 40), (9, "p " * 200_000), (10, "A a " * 12), (11, "one two three " * 7 + "one")]
    docs = spark.createDataFrame([(i, t, "c", [1]) for i, t in rows], "doc_id long, text string, id string, runs array<int>")
    got = sorted(((r.doc_id, r.n_words, [tuple(x) for x in r.runs], r.kept_text) for r in periodic_runs(docs).collect()), key=str)
    want = []
    for i, t in rows:
        w = [x.decode() for x in WORD.findall((t or "").encode())]
        runs = brute_runs(w, 24, 3) if len(w) < 1000 else [(0, 200_000, 1)]
        drop = {k for s, length, q in runs for k in range(s + q, s + length)}
        want.append((i, len(w), runs, " ".join(x for k, x in enumerate(w) if k not in drop)))
    assert got == sorted(want, key=str)
    assert periodic_runs(docs.limit(0)).collect() == []
    # The changed tails: of ids with h % 10 = 0, whatever their texts are.
    ids = [i for i in range(200) if zlib.crc32(str(i).encode()) % 10 == 0]
    texts = [None, "", " ", "w", "a b", " ".join(map(str, range(100)))]
    more = spark.createDataFrame([(i, t) for i in ids for t in texts], "doc_id long, text string")
    changed = periodic_runs(_with_periodic_tails(more)).collect()
    want = [expected(i, t) for i in ids for t in texts]
    assert sorted((r.doc_id, len(r.runs), hashlib.sha256(r.kept_text.encode()).hexdigest()) for r in changed) == sorted((x[0], x[1], x[7]) for x in want)
